"""Texts cut into words before the tokenizer: ids as the library's, and every word is learned once."""

import random

import numpy as np
import pytest

from playtrack.llm import tokens

pytest.importorskip("public_tokenizers")

PARTS = ["'s", "'T", "'re", "'", "İ", "İ", "J̌", "Å", "Å", "ß", "é", "É", "ſ", "ŉ", "Ÿ",
         "×", "ª", "²", "0", "97", "a", "B", "ll", "LL", ".", ",", "!", "<|endoftext|>", "</w>", "\t", "\r", "\n", " ", "\x0b", "\x1c",
         "\x00", "\x7f", "\x85", "\xa0", "中", "Σ", "K", "“", "_", "-"]


def _ids(got):
    return [np.frombuffer(x, "<u4").tolist() for x in got]


def test_ids_of_odd_texts_are_the_librarys():
    tokenizer, rng = tokens.PieceTokenizer("word_bpe_49k.json", False), random.Random(3)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    plain = [chr(c) for c in range(0x180)]
    texts += [a + b for a in plain for b in ("", "a", "'", "s", "7", "É")] + ["'" + a for a in plain] + ["x" * 500 + " y", "", None]
    want = [tokenizer.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert _ids(tokenizer.encode(texts)) == want
    # texts of words alone, and pieces that are known already
    assert _ids(tokenizer.encode(texts[::-1])) == want[::-1]


def test_a_word_is_learned_once_whatever_marks_stand_beside_it():
    tokenizer = tokens.PieceTokenizer("word_bpe_49k.json", False)
    tokenizer.encode(["Haus, haus! (HAUS) l'Été\nété's haus-haus"])
    assert set(tokenizer.cache) == {"", "haus", ",", "!", "(", ")", "l", "'", "été", "'s", "-"}


def test_another_tokenizers_texts_are_not_cut_into_words():
    assert tokens.PieceTokenizer("byte_bpe_50k.json", True).words is None
    assert tokens.PieceTokenizer("byte_bpe_50k.json", False).words is None
