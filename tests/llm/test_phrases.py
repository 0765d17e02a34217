"""Phrase mining: the summary's guarantee, brute force, DuckDB and odd rows."""

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from playtrack.llm import phrases


def brute(docs, longest=3, least=10, inside=50, first=2000):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in docs:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i:i + m])] += 1
    out = []
    cand = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    for (lang, w), a in cand.items():
        score, k = min((1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        if any(o == lang and len(v) > len(w) and 100 * b >= inside * a
               and any(v[i:i + len(w)] == w for i in range(len(v))) for (o, v), b in cand.items()):
            continue
        out.append((lang, -score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    rank, rows = Counter(), []
    for lang, score, a, phrase, left, right in sorted(out):
        rank[lang] += 1
        if rank[lang] <= first:
            rows.append((lang, rank[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return rows


def mined(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


TEXTS = ["New York City is big. New York City, new york state!", "the the the the", "a b\tc a b c; a b c\x0ba b\x0cc\rz",
         "É é ÉA éa É é ÉA", "x.y,z x y z x y", "  ", "\0 \0 \0", "of the of the of the of the of the of the of"]


def test_mining_equals_brute_force(make_docs):
    docs = [(i, TEXTS[i % len(TEXTS)], (None, "en", "und", "")[i % 4], "s", 1) for i in range(64)]
    assert mined(phrases.mine(make_docs(docs))) == brute(docs)
    assert mined(phrases.mine(make_docs(docs), least=3, inside=80, first=4)) == brute(docs, 3, 3, 80, 4)
    assert mined(phrases.mine(make_docs(docs), longest=4, least=5)) == brute(docs, 4, 5)
    assert mined(phrases.mine(make_docs(docs), longest=2)) == brute(docs, 2)


def test_a_text_longer_than_a_block_counts_once(make_docs, monkeypatch):
    text = " ".join(["in the end", "a b c d.", "of the end"] * 40)
    docs = [(i, text, "en", "s", 1) for i in range(3)]
    for tokens in (1, 7, 50):
        counted = phrases.phrase_counts(make_docs(docs), block_tokens=tokens)
        assert mined(phrases.collocations(counted)) == brute(docs)


def test_equal_hashes_are_told_apart(make_docs, monkeypatch):
    block = phrases.word_blocks(make_docs([(1, "a b c a b d e. b a c a", "en", "s", 1)])).collect()[0].asDict()
    monkeypatch.setattr(phrases, "_mix", lambda a, b: np.full(len(a), 7, np.uint64))
    got = Counter()
    for r in phrases._counted(block, np.array([7], np.uint64), 2).to_pylist():
        got[r["lang"], r["phrase"]] += r["a"]
    assert got == {("en", None): 11, **{("en", x): n for x, n in (
        ("a b", 2), ("b c", 1), ("c a", 2), ("b d", 1), ("d e", 1), ("b a", 1), ("a c", 1))}}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 9)), max_size=30), max_size=12), st.integers(1, 12))
def test_every_frequent_key_survives_merging(parts, least):
    total = Counter()
    for part in parts:
        for key, n in part:
            total[key] += n
    summary = phrases.MisraGries(sum(total.values()) // least + 1)
    for part in parts:
        if part:
            summary.merge(*(np.array(x, t) for x, t in zip(zip(*part, strict=True), (np.uint64, np.int64), strict=True)))
    kept = dict(zip(summary.keys.tolist(), summary.counts.tolist(), strict=True))
    assert len(kept) <= summary.capacity
    assert all(k in kept for k, n in total.items() if n >= least)
    assert {k for k, n in total.items() if n >= least} <= set(summary.at_least(least).tolist()) <= set(kept)
    assert all(total[k] - least < n <= total[k] for k, n in kept.items())


def test_a_small_summary_stays_small_and_bounded():
    rng = np.random.default_rng(1)
    summary, true = phrases.MisraGries(50), Counter()
    for _ in range(40):
        keys = np.minimum(rng.zipf(1.3, 500), 10_000).astype(np.uint64)
        true.update(keys.tolist())
        summary.merge(keys, np.ones(len(keys), np.int64))
    assert len(summary.keys) <= 50
    short = sum(true.values()) / 51
    assert 0 < summary.short <= short
    assert all(true[k] - short <= n <= true[k] for k, n in zip(summary.keys.tolist(), summary.counts.tolist(), strict=True))
    assert all(k in summary.keys for k, n in true.items() if n > short)


@pytest.mark.parametrize("least", [1, 2])
def test_odd_rows(odd_docs, no_docs, least):
    out = phrases.mine(odd_docs, least=least)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in odd_docs.collect()]
    got = mined(phrases.mine(odd_docs, least=20, first=None))
    assert got == brute([(a, b, c) for a, b, c in rows], least=20, first=10**9)
    assert out.count() > 0 and phrases.mine(no_docs).count() == 0
