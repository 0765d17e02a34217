"""Byte-level BPE: encoding with the tokenizers library over Arrow batches, and decoding.

The library's byte-level model works on characters: each of the 256 bytes
stands for one printable character (``BYTE_CHARS``).  A file of ranks (base64
bytes and their rank) becomes such a model: the vocabulary in these characters,
and for every token the two parts that its own bytes are merged from, in rank
order.  Every match of ``pattern`` is merged by itself.

Encoding cuts a text before each run of white space (``_CUT``), where no match
of the pattern can go across, and encodes every distinct piece once per worker
while it is cached: new pieces are joined, encoded in one call and told apart by
the bytes of their tokens.  Texts with other white space than ``_CUT`` knows are
encoded whole.

Offsets: bytes follow from the tokens' lengths, characters from the bytes that
begin one.  A token that holds a part of a character has the offsets of the
whole character, so neighbours overlap there.

Decoding puts the tokens' bytes together and only then reads them as UTF-8, so
characters split over tokens come back whole; ``SliceDecoder`` does that for ids
that arrive in slices, holding back the bytes of an unfinished character.

Scale: one pass over the rows, no shuffle; a task holds a slice of ``_ROWS``
texts, and a cache of ``CACHE`` pieces at most.

Defined cases: a null or empty text has no ids; strings that look like special
tokens are ordinary text; repeated rows are encoded alike; a null list of ids
decodes to nothing; an id that the vocabulary lacks decodes to U+FFFD; bytes
that are no UTF-8 become U+FFFD in text; an empty table gives no rows; other
columns are not read by ``encode`` and kept by ``decode``, which replaces a
column of its output's name.
"""

from __future__ import annotations

import base64
import codecs
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tokens import vocabulary_path

RANKS = "byte_bpe_50k.tiktoken"
CACHE = 600_000
LONGEST = 64            # longer pieces are not kept
_ROWS = 200
_JOINED = 200           # new pieces in one call
# the printable bytes stand for themselves, the others for characters from 256 on
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_CHARS = {b: chr(b) for b in _PRINTABLE} | {
    b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in _PRINTABLE)}
_CUT = re.compile(r"[ \n\r\t]*[^ \n\r\t]+|[ \n\r\t]+")
# the rest of the white space, which may stand beside that of _CUT in one match
_OTHER_SPACE = re.compile("[\x0b\x0c\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_LOADED: dict[tuple[str, str], ByteBpe] = {}
_NO_CHARACTER = "\ufffd".encode()


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def merge_parts(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The last two parts that ``token`` is merged from by merges of lower rank."""
    parts, top = [token[i:i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        rank, i = min((ranks.get(parts[i] + parts[i + 1], top), i) for i in range(len(parts) - 1))
        if rank >= top:
            raise ValueError(f"token {top} cannot be merged from tokens of lower rank")
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


class ByteBpe:
    def __init__(self, path: str, pattern: str):
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        ranks = read_ranks(path)

        def chars(data: bytes) -> str:
            return "".join(map(BYTE_CHARS.__getitem__, data))
        merges = [merge_parts(token, ranks) for token in sorted(ranks, key=ranks.__getitem__) if len(token) > 1]
        self.tokenizer = Tokenizer(models.BPE(vocab={chars(t): r for t, r in ranks.items()},
                                              merges=[(chars(a), chars(b)) for a, b in merges]))
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        # decoding reverses the byte table: from the model's characters back to bytes
        byte_of = {c: b for b, c in BYTE_CHARS.items()}
        self.bytes_of = [_NO_CHARACTER] * (max(ranks.values()) + 1)
        for token, rank in self.tokenizer.get_vocab().items():
            self.bytes_of[rank] = bytes(map(byte_of.__getitem__, token))
        self.sizes = np.array([len(x) for x in self.bytes_of], np.int64)
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<i4").tobytes()

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        # pieces that begin with white space are cut apart in a joined text too
        out = {x: self.whole(x) for x in new if x[0] not in " \n\r\t" or x.isspace()}
        rest = [x for x in new if x not in out]
        for at in range(0, len(rest), _JOINED):
            some = rest[at:at + _JOINED]
            ids = np.asarray(self.tokenizer.encode("".join(some), add_special_tokens=False).ids, "<i4")
            ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum([len(x.encode()) for x in some])) + 1
            data, start = ids.tobytes(), 0
            for piece, end in zip(some, (ends * 4).tolist(), strict=True):
                out[piece] = data[start:end]
                start = end
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text as little-endian 32-bit integers."""
        pieces = [None if _OTHER_SPACE.search(t or "") else _CUT.findall(t or "") for t in texts]
        if len(self.cache) > CACHE // 2:
            self.cache, self.older = {}, self.cache
        cache, older = self.cache, self.older
        new = set().union(*(p for p in pieces if p)).difference(cache)
        again = {x: older[x] for x in new if x in older}
        cache.update(again)
        new.difference_update(again)
        # an ASCII letter or digit and a closing mark are never in one match: the piece is its stem and the mark
        closed = [x for x in new if x[-1] in ".," and x[-2:-1].isalnum() and x[-2].isascii()]
        stems = {x[:-1] for x in closed}
        known = {x: cache[x] if x in cache else older[x] for x in stems if x in cache or x in older}
        known |= self._learn(list(new.difference(closed).union(stems).difference(known)))
        marks = {x: self.whole(x) for x in ".,"} if closed else {}
        known |= {x: known[x[:-1]] + marks[x[-1]] for x in closed}
        cache.update((k, v) for k, v in known.items() if len(k) <= LONGEST)
        known = {k: v for k, v in known.items() if len(k) > LONGEST}
        return [self.whole(text) if p is None else
                b"".join([cache[x] if x in cache else known[x] for x in p] if known else map(cache.__getitem__, p))
                for p, text in zip(pieces, texts, strict=True)]

    def offsets(self, data: bytes, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character of every token and the one after its last, counted in characters of the text."""
        ends = np.cumsum(self.sizes[ids])
        # number of the character that each byte belongs to
        char = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80) - 1
        return char[ends - self.sizes[ids]], char[ends - 1] + 1

    def decode(self, ids: np.ndarray) -> bytes:
        top = len(self.bytes_of)
        if len(ids) and (ids.min() < 0 or ids.max() >= top):
            return b"".join(self.bytes_of[i] if 0 <= i < top else _NO_CHARACTER for i in ids.tolist())
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))


def byte_bpe(vocabulary: str = RANKS, pattern: str | None = None) -> ByteBpe:
    """The worker's model of this file of ranks, loaded once per Python process."""
    key = vocabulary_path(vocabulary), pattern or default_pattern()
    if key not in _LOADED:
        _LOADED[key] = ByteBpe(*key)
    return _LOADED[key]


class SliceDecoder:
    """Text of ids that arrive in slices, which may cut characters."""

    def __init__(self, model: ByteBpe):
        self.model, self.utf8 = model, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: np.ndarray, last: bool = False) -> str:
        return self.utf8.decode(self.model.decode(ids), last)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, "<i4"), *parts]), pa.int32()))


def encode(docs: DataFrame, offsets: bool = False, vocabulary: str = RANKS, pattern: str | None = None) -> DataFrame:
    """``(doc_id, ids)`` of every row, with ``offsets`` also ``starts`` and ``ends`` of the tokens in characters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = byte_bpe(vocabulary, pattern)
        for batch in batches:
            for low in range(0, batch.num_rows, _ROWS):
                part = batch.slice(low, _ROWS)
                texts = part["text"].to_pylist()
                ids = [np.frombuffer(x, "<i4") for x in model.encode(texts)]
                columns = {"doc_id": part["doc_id"], "ids": _lists(ids)}
                if offsets:
                    both = [model.offsets((t or "").encode(), x) for t, x in zip(texts, ids, strict=True)]
                    columns |= {name: _lists([x.astype("<i4") for x in side])
                                for name, side in zip(("starts", "ends"), zip(*both, strict=True), strict=True)}
                yield pa.RecordBatch.from_pydict(columns)
    schema = "doc_id long, ids array<int>" + (", starts array<int>, ends array<int>" if offsets else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, ids: str = "ids", out: str = "data", text: bool = False,
           vocabulary: str = RANKS, pattern: str | None = None) -> DataFrame:
    """``encoded`` with the bytes of its ids in column ``out``; as a string where ``text`` is set."""
    rows = encoded.drop(out)
    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.StringType() if text else T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = byte_bpe(vocabulary, pattern)
        for batch in batches:
            for low in range(0, batch.num_rows, _ROWS):
                part = batch.slice(low, _ROWS)
                column = part[ids]
                found = []
                for i in range(part.num_rows):
                    own = column[i].values
                    own = np.zeros(0, "<i4") if own is None else own.fill_null(-1).to_numpy(zero_copy_only=False)
                    found.append(SliceDecoder(model).feed(own, True) if text else model.decode(own))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string() if text else pa.binary())],
                                                 names=[*part.schema.names, out])
    return rows.mapInArrow(run, schema)
