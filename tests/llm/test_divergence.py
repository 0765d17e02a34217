"""Perfect hashes, exact shares, and the audit against brute force."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from playtrack.llm import divergence, perfect_hash


def brute(rows, least=10, ranks=10):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        terms = re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
        groups.add((lang, source))
    out = []

    def top(lang, source, part, found, most=None):
        found.sort(key=lambda x: (-x[1], x[0].encode()))
        out.extend((lang, source, part, item, value, i) for i, (item, value) in enumerate(found[:most], 1))
    for lang in {x for x, _ in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        v, sources = len(kept), [s for x, s in groups if x == lang]
        total = {s: sum(counts[lang, s][t] for t in kept) for s in sources}

        def p(n, of):
            return 1 + 10 ** 9 * (n + 2) // (of + 2 * v)  # noqa: B023
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            top(lang, s, "pair", [(o, sum(f(p(counts[lang, s][t], total[s]), p(counts[lang, o][t], total[o])) for t in kept))
                                  for o in sources if o != s])
            found = []
            for t in kept:
                a, q = p(counts[lang, s][t], total[s]), p(sum(counts[lang, o][t] for o in sources), sum(total.values()))
                if counts[lang, s][t] and a > q:
                    found.append((t, f(a, q)))
            top(lang, s, "term", found, ranks)
    return sorted(out)


def audited(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def some_docs():
    rng, rows = np.random.default_rng(3), []
    for i in range(160):
        words = [f"W{chr(97 + w % 26)}é{chr(97 + w // 26)}" for w in rng.zipf(1.4, rng.integers(0, 60)) if w < 500]
        rows.append((i, "1 ".join(words) + " Ünï_x-Y'z", ("en", "fr", None, "")[i % 4], (f"s{i % 7}", None, "")[i % 9 // 4], None))
    return [*rows, (1000, "lonely words", "xx", "a", None), (1001, None, "xx", "b", None), (1002, "", "xx", None, None)]


@pytest.mark.parametrize("least", [3, 10])
def test_audit_equals_brute_force(make_docs, monkeypatch, least):
    docs = some_docs()
    want = brute([r[1:4] for r in docs], least)
    assert audited(divergence.audit(make_docs(docs), least)) == want
    # beyond the broadcast limit
    assert audited(divergence.audit(make_docs(docs), least, limit=0)) == want


def test_many_shards_and_blocks_of_sources(make_docs, monkeypatch):
    docs = some_docs()
    monkeypatch.setattr(divergence, "SHARD_TERMS", 7)
    assert audited(divergence.audit(make_docs(docs), 3, ranks=4)) == brute([r[1:4] for r in docs], 3, 4)


def test_a_task_that_sends_its_slots_early(monkeypatch):
    words = [chr(97 + i // 26) + chr(97 + i % 26) for i in range(300)]
    table = perfect_hash.ShardedHash([perfect_hash.build([w.encode() for w in words])])
    monkeypatch.setattr(divergence, "DENSE_SLOTS", 500)
    slots = divergence._Slots({"en": table})
    batches = []
    for _ in range(3):
        batches += slots.add(["en", "en", "xx"], ["a", "b", "c"], [" ".join(words).encode(), b"aa ab no aa", b"aa"])
    batches += slots.sent()
    assert len(batches) > 3
    total = Counter()
    for batch in batches:
        for r in batch.to_pylist():
            for at, n in zip(np.frombuffer(r["slots"], "<i4").tolist(), np.frombuffer(r["counts"], "<i8").tolist(), strict=True):
                total[r["source"], table.keys[at].decode()] += n
    assert total == Counter({**{("a", w): 3 for w in words}, ("b", "aa"): 6, ("b", "ab"): 3})


def test_blocks_of_sources_give_every_pair(monkeypatch):
    import pandas as pd

    rng = np.random.default_rng(5)
    sources = [f"s{i}" for i in range(7)]
    counts = [rng.integers(0, 9, 11) for _ in sources]
    found = pd.DataFrame({"source": sources, "slots": [np.arange(11, dtype="<i4").tobytes()] * 7,
                          "counts": [c.astype("<i8").tobytes() for c in counts]})
    base = {"sources": sources, "totals": [int(c.sum()) for c in counts], "terms": [f"t{i}" for i in range(11)], "n_terms": 11}
    whole = sorted(divergence._shard_part(base, found, 3))
    for size in (1, 2, 3):
        monkeypatch.setattr(divergence, "_GROUPS", size)
        assert sorted(divergence._shard_part(base, found, 3)) == whole
    assert sum(r[1] == "pair" for r in whole) == 42


@settings(max_examples=60, deadline=None)
@given(st.sets(st.binary(max_size=6), max_size=400), st.integers(1, 5))
def test_perfect_hashes_are_minimal_and_verify_keys(keys, shards):
    keys = sorted(keys)
    of = perfect_hash.shard_of(perfect_hash.hashes(keys), shards).tolist()
    table = perfect_hash.ShardedHash([perfect_hash.build([k for k, s in zip(keys, of, strict=True) if s == i]) for i in range(shards)])
    assert sorted(table.slots(keys).tolist()) == list(range(len(keys)))
    assert [table.keys[i] for i in table.slots(keys).tolist()] == keys
    assert set(table.slots([k + b"no" * 9 for k in keys]).tolist()) <= {-1}


def test_perfect_hash_of_a_full_shard_and_of_equal_hashes(monkeypatch):
    keys = [str(i).encode() for i in range(20_000)]
    table = perfect_hash.ShardedHash([perfect_hash.build(keys)])
    assert sorted(table.slots(keys).tolist()) == list(range(len(keys)))
    plain = perfect_hash.hashes
    # under the first seed all keys share their hash: the next one is taken
    monkeypatch.setattr(perfect_hash, "hashes", lambda k, seed=perfect_hash.FIRST_SEED: (
        np.full(len(k), 9, np.uint64) if seed == perfect_hash.FIRST_SEED else plain(k, seed)))
    built = perfect_hash.build(keys[:50])
    assert built[0] == perfect_hash.FIRST_SEED + 1
    assert perfect_hash.ShardedHash([built]).slots([*keys[:50], b"x"]).tolist()[-1] == -1
    assert sorted(perfect_hash.ShardedHash([built]).slots(keys[:50]).tolist()) == list(range(50))


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10 ** 14), st.integers(0, 10 ** 14), st.integers(1, 10 ** 9))
def test_shares_are_exact(count, more, terms):
    got = divergence.shares(np.array([count]), np.array([count + more]), terms)
    assert got.tolist() == [1 + 10 ** 9 * (count + 2) // (count + more + 2 * terms)]


def test_odd_rows(odd_docs, no_docs):
    rows = [(r["text"], r["lang"], r["source"]) for r in odd_docs.collect()]
    assert audited(divergence.audit(odd_docs, least=2)) == brute(rows, 2)
    assert divergence.audit(no_docs).count() == 0
