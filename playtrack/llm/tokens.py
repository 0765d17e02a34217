"""Exact token ids of whole texts, with every distinct piece encoded once per task.

A text is cut where the tokenizer's own pre-tokenizer always cuts, so the ids
of the pieces in a row are the ids of the text:

* ``space_keeping`` (byte-level BPE): before every run of white space; texts
  with other white space than spaces, tabs and line ends are encoded whole.
* ``space_dropping`` (white space never reaches a token): at every space and
  line feed.  Where the tokenizer cuts words as ``_WORD_CUTS`` says, a text of
  Latin letters, ASCII digits and marks is cut into those words, in lower case,
  and new words go to its model without being cut again.

Ids are kept as little-endian unsigned 32-bit bytes.  The cache has two
generations of half of ``CACHE`` pieces: when the young one is full the old one
goes, and pieces met again move to the young one.  So its memory is bounded
and frequent pieces stay.  It lasts as long as a task (``encoding``): a worker
that waits, or does another operator's work, holds the vocabulary alone.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np

CACHE = 1_000_000
LONGEST = 64            # longer pieces are not kept
_CUT = re.compile(r"[ \n\r\t]*[^ \n\r\t]+|[ \n\r\t]+")
_OTHER_SPACE = re.compile("[\x0b\x0c\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
# the tokenizer's own steps before its model: their words are those of _WORD, in lower case, if a text is _LATIN
_WORD_CUTS = ({"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]})
# composed letters whose small form is in Unicode's first versions; not U+0130, which becomes two
_LETTERS = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
_LATIN = re.compile(rf"[\t\n\r -~{_LETTERS}]*")
_WORD = re.compile(rf"[a-z{_LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^ \t\n\ra-z0-9{_LETTERS}]+")
_WORD_END = "</w>"
_LOADED: dict[str, PieceTokenizer] = {}


def vocabulary_path(vocabulary: str) -> str:
    """A file path as it is, or the name of a file of the installed public tokenizers."""
    if os.path.isabs(vocabulary):
        return vocabulary
    import public_tokenizers

    return public_tokenizers.path(vocabulary)


class PieceTokenizer:
    def __init__(self, vocabulary: str, keeps_space: bool):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(vocabulary_path(vocabulary))
        self.tokenizer.encode_special_tokens = True      # their strings in a text are ordinary text
        self.keeps_space = keeps_space
        vocab = self.tokenizer.get_vocab()
        self.sizes = np.zeros(max(vocab.values()) + 1, np.int64)
        self.sizes[list(vocab.values())] = [len(token) for token in vocab]
        self.words = self._model_alone(Tokenizer, vocab)
        self.cache: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        self.marks = {x: self._learn([x])[x] for x in ".,"}

    def _model_alone(self, Tokenizer, vocab: dict[str, int]):
        """The tokenizer without its cuts, for words that are cut already, or None if it cuts in another way."""
        from tokenizers import pre_tokenizers

        rules, end = json.loads(self.tokenizer.to_str()), _WORD_END
        if (self.keeps_space or (rules["normalizer"], rules["pre_tokenizer"]) != _WORD_CUTS or rules["model"].get("end_of_word_suffix") != end
                or not all(t["special"] for t in rules["added_tokens"])                  # others are found before words are cut
                or not all(c in vocab and c + end in vocab for c in pre_tokenizers.ByteLevel.alphabet())):
            return None
        self.ends = np.zeros(len(self.sizes), bool)          # a word's last token, and no other, has the end mark
        self.ends[[i for token, i in vocab.items() if token.endswith(end)]] = True
        alone = Tokenizer.from_str(json.dumps(rules | {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
            {"type": "WhitespaceSplit"}, rules["pre_tokenizer"]["pretokenizers"][1]]}}))
        alone.encode_special_tokens = True
        return alone

    def _learn_words(self, new: list[str]) -> dict[str, bytes]:
        """Ids of distinct words of ``_WORD``, many in one call."""
        out = {}
        for at in range(0, len(new), 1000):
            words = new[at:at + 1000]
            ids = np.asarray(self.words.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
            data, start = ids.tobytes(), 0
            for word, end in zip(words, ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist(), strict=True):
                out[word] = data[start:end]
                start = end
        return out

    def forget(self) -> None:
        """Let go of the pieces met so far."""
        self.cache, self.older = {"": b""}, {}

    @staticmethod
    def _bytes(ids) -> bytes:
        return np.asarray(ids, dtype="<u4").tobytes()

    def _pieces(self, text: str) -> list[str] | None:
        if not self.keeps_space:
            return text.replace("\n", " ").split(" ")
        return None if _OTHER_SPACE.search(text) else _CUT.findall(text)

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """Ids of distinct pieces, many in one call."""
        if self.keeps_space:
            # one text of pieces that start with white space, and have more than that, is cut at each of them
            joint = [x for x in new if x[0] in " \n\r\t" and not x.isspace()]
            alone = set(new).difference(joint)
        else:
            joint, alone = new, set()
        out = {x: self._bytes(self.tokenizer.encode([x], is_pretokenized=True, add_special_tokens=False).ids) for x in alone}
        for at in range(0, len(joint), 200):
            words = joint[at:at + 200]
            if self.keeps_space:
                # a byte-level token stands for as many bytes as it has characters
                ids = np.asarray(self.tokenizer.encode_batch_fast(["".join(words)], add_special_tokens=False)[0].ids, "<u4")
                stops = np.cumsum(np.fromiter((len(w.encode()) for w in words), np.int64, len(words)))
                ends = np.searchsorted(np.cumsum(self.sizes[ids]), stops) + 1
            else:
                got = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
                ids = np.asarray(got.ids, "<u4")
                begins = np.fromiter((a for a, _ in got.offsets), np.int64, len(ids))
                ends = np.searchsorted(begins, np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1))
            data, start = ids.tobytes(), 0
            for word, end in zip(words, (ends * 4).tolist(), strict=True):
                out[word] = data[start:end]
                start = end
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text (null: none) as bytes."""
        out = []
        for at in range(0, len(texts), 200):
            latin = [self.words is not None and _LATIN.fullmatch(t or "") is not None for t in texts[at:at + 200]]
            pieces = [_WORD.findall(t.lower()) if t and cut else self._pieces(t or "") for t, cut in zip(texts[at:at + 200], latin, strict=True)]
            if len(self.cache) > CACHE // 2:
                self.cache, self.older = {"": b""}, self.cache
            cache, older = self.cache, self.older
            new = set().union(*(p for p in pieces if p is not None)).difference(cache)
            again = {x: older[x] for x in new if x in older}
            cache.update(again)
            new.difference_update(again)
            words = new if all(latin) else new.intersection(x for p, cut in zip(pieces, latin, strict=True) if cut for x in p)
            new = new.difference(words)
            # an ASCII letter or digit and a closing mark never share a token: such a piece is its stem and the mark
            closed = {x for x in new if x[-1] in self.marks and x[-2:-1].isalnum() and x[-2].isascii()}
            stems = {x[:-1] for x in closed}
            known = {x: cache[x] if x in cache else older[x] for x in stems if x in cache or x in older}
            more = self._learn(list((new - closed).union(stems.difference(known))))
            more |= known
            more |= {x: more[x[:-1]] + self.marks[x[-1]] for x in closed}
            more |= self._learn_words(list(words))
            cache.update((k, v) for k, v in more.items() if len(k) <= LONGEST)
            long = {k: v for k, v in more.items() if len(k) > LONGEST}
            for p, text in zip(pieces, texts[at:at + 200], strict=True):
                if p is None:
                    out.append(self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids))
                elif long:
                    out.append(b"".join([cache[x] if x in cache else long[x] for x in p]))
                else:
                    out.append(b"".join(map(cache.__getitem__, p)))
        return out


def piece_tokenizer(vocabulary: str, keeps_space: bool) -> PieceTokenizer:
    """The worker's tokenizer of this vocabulary, loaded once per Python process."""
    if vocabulary not in _LOADED:
        _LOADED[vocabulary] = PieceTokenizer(vocabulary, keeps_space)
    return _LOADED[vocabulary]


@contextmanager
def encoding(vocabulary: str, keeps_space: bool) -> Iterator[PieceTokenizer]:
    """``piece_tokenizer`` for one task: its pieces go when the task ends, however it ends."""
    tokenizer = piece_tokenizer(vocabulary, keeps_space)
    try:
        yield tokenizer
    finally:
        tokenizer.forget()
