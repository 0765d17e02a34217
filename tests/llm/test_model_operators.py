"""Packing, token files, LM scores, top-k, quality and the pipeline against brute force and on odd rows."""

import math
import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from playtrack.llm import lm_scoring, packing, quality, token_files, tokens, topk

SF = "/root/testdata/sf0.001"
have_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def library_ids(vocabulary, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.vocabulary_path(vocabulary))
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


# ---- token ids ----------------------------------------------------------------------------------

@pytest.mark.parametrize(("vocabulary", "keeps"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_piece_ids_are_the_library_ids(vocabulary, keeps, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 300)               # so that generations change
    rng = random.Random(11)
    letters = "  \n\tab'sS1é,.　Σ!?İ́Å‍x\0½२\x1c"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += [None, "", "<|endoftext|> a", "don't we'll", "x" * 500, "a  b   c", " lead", "trail ", "10,000.5 and 3.14,"]
    tokenizer = tokens.PieceTokenizer(vocabulary, keeps)
    got = [np.frombuffer(x, "<u4").tolist() for x in tokenizer.encode(texts)]
    assert got == library_ids(vocabulary, texts)


# ---- packing ------------------------------------------------------------------------------------

def check_packed(rows, ids, length):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for doc, own in by_doc.items():
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            part = np.array(ids[doc][at:at + r["length"]], "<u4")
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids[doc]), zlib.crc32(part.tobytes()))
            at += r["length"]
        assert at == len(ids[doc])
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= length


@have_data
def test_packing_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids = dict(zip(texts, ([*x, 1] for x in library_ids("byte_bpe_50k.json", list(texts.values()))), strict=True))
    rows = packing.pack(docs).collect()
    check_packed(rows, ids, 2048)
    total = sum(map(len, ids.values()))
    assert len({r["sequence_id"] for r in rows}) <= 1.03 * total / 2048 + 1


@pytest.mark.parametrize("words", [1, 2, 5, 9, 30])
def test_short_pieces_leave_little_padding(make_docs, words):
    docs = make_docs([(i, " ".join(["a"] * words)) for i in range(4_000)] + [(10_000 + i, None) for i in range(7)])
    rows = packing.pack(docs).collect()
    ids, sequences = sum(r["length"] for r in rows), {r["sequence_id"] for r in rows}
    assert len(rows) == 4_007 and len(sequences) <= ids / 2048 / 0.965 + 1
    ends = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 200), st.integers(1, 60), max_size=20))
def test_items_number_every_piece_once(histogram):
    seen = {}
    for length, low, high, per, units, first in packing.items(histogram):
        assert (high - low) % per == 0 and (units - 1) * 8 < length * per <= units * 8 and (per == 1 or length * per == units * 8)
        seen.setdefault(units, []).extend(range(first, first + (high - low) // per))
    assert all(sorted(v) == list(range(len(v))) for v in seen.values())
    assert sum((high - low) for _, low, high, *_ in packing.items(histogram)) == sum(histogram.values())


def test_packing_odd_rows_and_sequences(odd_docs, no_docs):
    packed = packing.pack(odd_docs, length=256, keep_ids=True)
    rows = packed.collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 1) == 1                # null text: the end id
    assert len([r for r in rows if r["doc_id"] == 3]) == 2                        # repeated rows are both packed
    for r in packing.sequences(packed, 256, pad=0).collect():
        assert len(r["ids"]) == (r["used"] if r["used"].bit_count() == 1 else 256)
    assert packing.pack(no_docs).count() == 0


def test_column_generation_is_near_the_bound():
    rng = np.random.default_rng(5)
    sizes = np.arange(1, 65)
    demand = rng.integers(0, 400, 64)
    sizes, demand = sizes[demand > 0], demand[demand > 0]
    planned = packing.plan(sizes, demand, 64)
    assert (sum(c * p for p, c in planned) == demand).all() and all((p @ sizes) <= 64 for p, _ in planned)
    patterns, amounts = packing.solve_patterns(sizes, demand.astype(float), 64)
    assert np.allclose(amounts @ patterns, demand)
    prices = np.linalg.solve(patterns.astype(float), np.ones(len(sizes)))
    value, _ = packing.knapsack(sizes, prices, 64)
    bound = max(float(sizes @ demand) / 64, float(prices @ demand) / value)      # no packing uses fewer
    assert amounts.sum() <= bound * 1.001 + 0.5
    assert sum(c for _, c in planned) <= amounts.sum() * 1.01 + 3


def test_knapsack_equals_brute_force():
    sizes, prices = np.array([3, 4, 5]), np.array([0.31, 0.43, 0.5])
    best = max(a * .31 + b * .43 + c * .5 for a in range(6) for b in range(5) for c in range(4) if 3 * a + 4 * b + 5 * c <= 16)
    value, pattern = packing.knapsack(sizes, prices, 16)
    assert abs(value - best) < 1e-9 and abs(pattern @ prices - best) < 1e-9 and pattern @ sizes <= 16


# ---- token files --------------------------------------------------------------------------------

def test_token_files_round_trip(spark, odd_docs, no_docs, tmp_path):
    texts = sorted(((r["doc_id"], r["text"]) for r in odd_docs.collect()), key=lambda x: (x[0] is not None, x[0] or 0))
    manifest = token_files.write(odd_docs, str(tmp_path / "ids"))
    got = sorted(token_files.read(spark, str(tmp_path / "ids"), keep_ids=True).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [d for d, _ in texts]
    assert manifest["ids"] == sum(r["n_tokens"] for r in got) and manifest["dtype"] == "<u2"
    at = 0
    want = Counter((d, (*x, 2)) for (d, _), x in zip(texts, library_ids("word_bpe_49k.json", [t for _, t in texts]), strict=True))
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == want
    for r in got:
        assert (r["start"], r["n_tokens"]) == (at, len(r["ids"]))
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r["n_tokens"]
    # what a lost attempt leaves behind is not read
    (tmp_path / "ids" / "part-00000-lost.bin").write_bytes(b"123")
    assert token_files.read(spark, str(tmp_path / "ids")).count() == len(texts)
    token_files.write(no_docs, str(tmp_path / "none"))
    assert token_files.read(spark, str(tmp_path / "none")).count() == 0


# ---- LM scores ----------------------------------------------------------------------------------

def brute_scores(texts, order, min_count):
    words = [(t or "").encode().lower().split() for t in texts]
    c = Counter(tuple(w[i - n:i]) for w in words for n in range(1, order + 1) for i in range(n, len(w) + 1))
    total = sum(map(len, words))
    out = []
    for w in words:
        s = 0.0
        for i in range(len(w)):
            n, factor = min(order, i + 1), 1.0
            while n > 1 and c[tuple(w[i + 1 - n:i + 1])] < min_count:
                n, factor = n - 1, factor * 0.4
            gram = tuple(w[i + 1 - n:i + 1])
            s += math.log(factor * c[gram] / (c[gram[:-1]] if n > 1 else total))
        out.append((len(w), s))
    return out


@pytest.mark.parametrize(("order", "block"), [(2, 1 << 20), (3, 1 << 20), (3, 17), (1, 5)])
def test_lm_scores_equal_brute_force(make_docs, order, block):
    rng = random.Random(order * 100 + block)
    texts = [" ".join(rng.choice("a b c d E f g".split()) for _ in range(rng.randint(0, 40))) for _ in range(25)] + [None]
    want = brute_scores(texts, order, 2)
    got = {r["doc_id"]: r for r in lm_scoring.score(make_docs(list(enumerate(texts))), order, block_tokens=block).collect()}
    assert len(got) == len(texts)
    for i, (n, s) in enumerate(want):
        assert got[i]["n_words"] == n and abs(got[i]["log_score"] - s) < 1e-6
        assert (got[i]["mean_log_score"] is None) == (n == 0)


@have_data
def test_a_registered_query_scores_with_trigrams(spark):
    from playtrack.llm import queries

    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = dict(zip((d for d, _ in docs), brute_scores([t for _, t in docs], 3, 2), strict=True))
    got = {r["doc_id"]: r for r in queries.QUERIES["op2_lm_scoring_order3"](spark, SF).collect()}
    assert set(got) == set(want)
    assert all(got[d]["n_words"] == n and abs(got[d]["log_score"] - s) < 1e-3 for d, (n, s) in want.items())


def test_lm_odd_rows(odd_docs, no_docs):
    rows = lm_scoring.score(odd_docs).collect()
    assert len(rows) == 10 and {r["n_words"] for r in rows if r["doc_id"] in (1, 2, 7)} == {0}
    assert len({r["log_score"] for r in rows if r["doc_id"] in (5, 6)}) == 1
    assert lm_scoring.score(no_docs).count() == 0


# ---- top-k --------------------------------------------------------------------------------------

def test_top_k_equals_brute_force_in_blocks(spark):
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(220, 6)), 1)
    x[50:60] = x[49]                                                # ties
    rows = [(i, v.tolist(), "x") for i, v in enumerate(x)]
    rows += [(300, None, "x"), (350, [1.0, None, 1.0, 1.0, 1.0, 1.0], "x"), (400, [float("nan")] * 6, "x"),
             (450, [float("inf")] * 6, "x"), (500, [1.0, 2.0], "x"), (501, [0.5, -2.0], "x"), (550, [], "x"), (551, [], "x"), (None, [9.0] * 6, "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string").repartition(4)
    from pyspark.sql import functions as F

    got = topk.top_k(topk.whole_vectors(table), F.pmod("vec_id", F.lit(50)) == 0, k=5, block=40)
    v = {i: np.floor(256 * np.array(e, np.float32).astype(float)) for i, e, _ in rows
         if e is not None and all(a is not None and math.isfinite(a) for a in e)}
    want = []
    for q in sorted(k for k in v if k is not None and k % 50 == 0):
        scored = sorted(((-int(v[q] @ v[c]), c is None, c or 0, c) for c in v if c != q and len(v[c]) == len(v[q])))[:5]
        want += [(q, r + 1, s[3], -s[0]) for r, s in enumerate(scored)]
    rows = sorted((tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()), key=lambda r: r[:2])
    assert rows == want
    assert topk.top_k(topk.whole_vectors(table.limit(0)), F.lit(True)).count() == 0


def test_threshold_walk_stops_early_and_stays_exact():
    rng = np.random.default_rng(8)
    x = np.floor(rng.exponential(200, (5000, 2)))
    lists, rank = topk.SortedLists(x), np.arange(5000)
    for q in rng.normal(size=(20, 2)).round(3) * 100:
        q = np.floor(q)
        places, scores = lists.top(q, -1, 5, rank)
        want = np.lexsort((rank, -(x @ q)))[:5]
        assert places.tolist() == want.tolist()
        floor = (x @ q)[want[2]]                                        # a floor leaves out what is less, not what ties
        assert lists.top(q, -1, 5, rank, floor)[0].tolist() == [p for p in want if (x @ q)[p] >= floor]
    assert lists.scored < 40 * len(x) / 4                               # 40 walks met less than a quarter
    big = np.array([[2 ** 40, 3], [2 ** 40, 4], [-5, 1]], dtype=object)
    assert topk.SortedLists(big).top(big[0], 0, 2, np.arange(3))[1].tolist() == [2 ** 80 + 12, -5 * 2 ** 40 + 3]


# ---- quality ------------------------------------------------------------------------------------

def test_factorisation_identity():
    model = quality.FactorisationMachine()
    index, x = quality.features("some words here, some more words", None)
    v = model.factors[index]
    pairs = sum(float(v[i] @ v[j]) * x[i] * x[j] for i in range(len(x)) for j in range(i))
    assert abs(model.raw(index, x) - (model.bias + model.linear[index] @ x + pairs)) < 1e-9


@have_data
def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert auc > 0.95 and all(r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_quality_sample_has_one_text_an_id(make_docs, spark):
    docs = make_docs([(1, f"text {i % 3}") for i in range(300)] + [(2, "other"), (3, None)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 4)], "doc_id long, quality int")
    rows = quality.training_sample(docs, labels).collect()
    held_out = {i for i in range(1, 4) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sorted(r["doc_id"] for r in rows) == sorted({1, 2, 3} - held_out)
    assert 1 not in held_out and all(r["label"] == r["doc_id"] % 2 for r in rows)


def test_quality_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 0), (4, None, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.classify(odd_docs, labels).collect()
    assert len(rows) == 10 and all(0 <= r["score"] <= 1 for r in rows)
    rows = quality.classify(odd_docs, labels.limit(0)).collect()
    assert {round(r["score"], 9) for r in rows} == {0.5}
    assert quality.classify(no_docs, labels).count() == 0


# ---- the pipeline -------------------------------------------------------------------------------

@have_data
def test_pipeline_equals_a_plain_version(spark):
    import corpus_pipeline
    from playtrack.llm.common import read_table

    from .test_text_operators import brute_components, brute_contamination, brute_fingerprint

    docs = {r["doc_id"]: r for r in read_table(spark, SF, "documents").collect()}
    after = {r["doc_id"]: r["text"] for r in corpus_pipeline.language_stage(spark, read_table(spark, SF, "documents"), SF).collect()}
    assert len(after) >= 0.99 * len(docs)
    seen, texts = {}, {}
    for d in sorted(after):                                          # line dedup
        lines = after[d].split("\n")
        filled = [i for i, x in enumerate(lines) if x.strip(" ")]
        gone = set()
        for j in range(len(filled) - 2):
            window = tuple(lines[filled[j + k]].strip(" ") for k in range(3))
            if seen.setdefault(window, (d, j)) != (d, j):
                gone |= {filled[j + k] for k in range(3)}
        texts[d] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    ids = sorted(texts)
    parts = brute_components([brute_fingerprint(texts[d]) for d in ids], 2)
    stay = [d for i, d in enumerate(ids) if parts[i] == i]           # ids ascend: the least of a part comes first
    items = [(r["item_id"], r["text"]) for r in read_table(spark, SF, "benchmark").collect()]
    clean = [r[0] for r in brute_contamination([(d, texts[d]) for d in stay], items) if not r[4]]
    token_ids = dict(zip(clean, ([*x, 1] for x in library_ids("byte_bpe_50k.json", [texts[d] for d in clean])), strict=True))
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(clean)
    check_packed(rows, token_ids, 2048)


def test_stages_are_whole_and_ordered():
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "simhash", "decontamination", "packing"]
