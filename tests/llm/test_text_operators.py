"""Line dedup, decontamination, language id, SimHash and chunk dedup against brute force and on odd rows."""

import itertools
import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from playtrack.llm import decontaminate, language_id, line_dedup, simhash, substring_dedup


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


# ---- line dedup ---------------------------------------------------------------------------------

def test_line_windows_first_stays_later_goes(make_docs):
    docs = make_docs([(1, "x\na\nb\nc\ny"), (2, "p\n\n a \nb\n\nc\nq"), (3, "a\nb\nz")])
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in line_dedup.dedup_report(docs).collect()}
    assert got == {1: ("x\na\nb\nc\ny", 5, 0), 2: ("p\n\n\nq", 5, 3), 3: ("a\nb\nz", 3, 0)}


def test_overlapping_later_windows_merge(make_docs):
    docs = make_docs([(1, "a\nb\nc\nd\ne"), (2, "0\na\nb\nc\nd\n9")])
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_report(docs).collect()}
    assert got == {1: "a\nb\nc\nd\ne", 2: "0\n9"}


def test_line_dedup_odd_rows(odd_docs, no_docs):
    out = line_dedup.dedup_lines(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    texts = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert (1, "") in texts and (2, "") in texts
    assert (3, "a b\nc d\ne f\ng h") in texts and (4, "other") in texts
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect())
    assert line_dedup.dedup_lines(no_docs).count() == 0


# ---- decontamination ----------------------------------------------------------------------------

def brute_contamination(docs, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
                                 "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    grams = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            grams.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n, i in itertools.product({len(g) for g in grams}, range(len(w))):
            if tuple(w[i:i + n]) in grams and i + n <= len(w):
                hit |= set(range(i, i + n))
                found |= grams[tuple(w[i:i + n])]
        out.append((doc, len(w), len(hit), len(found), len(hit) > 0))
    return sorted(out)


def test_decontamination_equals_brute_force(spark, make_docs):
    item = "One two three four five six seven eight nine ten eleven É twelve"
    items = [(1, item), (2, "short item"), (3, None), (4, "..."), (5, item)]
    docs = [(1, "zero " + item.upper().replace("É", "É") + " end"), (2, "one, two; three four five six seven eight nine ten"),
            (3, "one two three four five six seven eight nine"), (4, "a SHORT - item! short item"), (5, None), (6, ""),
            (7, "short" + " " + "item"), (8, "two three four five six seven eight nine ten eleven É TWELVE é")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.report(decontaminate.contamination(make_docs(docs), bench))
    assert rows_of(got, "doc_id", "n_words", "n_hit", "n_items", "contaminated") == sorted(brute_contamination(docs, items), key=str)


def test_decontamination_without_broadcast_is_the_same(spark, make_docs, monkeypatch):
    items = spark.createDataFrame([(1, "a b c"), (2, " ".join("abcdefghijkl"))], "item_id long, text string")
    # with its words beside each window, the long document would shuffle gigabytes
    long = " ".join(f"w{i}" for i in range(20_000)) + " a b c"
    docs = make_docs([(i, f"x a b c {i} " + " ".join("abcdefghijkl")) for i in range(20)] + [(20, long), (21, ""), (22, None)])
    whole = rows_of(decontaminate.report(decontaminate.contamination(docs, items)), "doc_id", "n_words", "n_hit", "n_items")
    monkeypatch.setattr(decontaminate, "sized_broadcast", lambda df, width: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows_of(decontaminate.report(decontaminate.contamination(docs, items)),
                       "doc_id", "n_words", "n_hit", "n_items") == whole
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_decontamination_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "c d e f"), (None, "other")], "item_id long, text string")
    left = decontaminate.remove_documents(odd_docs, items)
    assert left.columns == odd_docs.columns
    assert {r["doc_id"] for r in left.collect()} == {1, 2, None, 5, 6, 7}      # both rows of id 4 hold "other"
    cut = {r["text"] for r in decontaminate.remove_spans(odd_docs, items).collect()}
    assert "a b g h" in cut and "some text without an id here" in cut
    assert decontaminate.contamination(no_docs, items).count() == 0
    assert not any(r["contaminated"] for r in decontaminate.contamination(odd_docs, items.limit(0)).collect())


def test_decontamination_reports_every_row(spark, odd_docs, monkeypatch):
    items = spark.createDataFrame([(1, "c d e f"), (None, "other")], "item_id long, text string")
    want = sorted(str(r["doc_id"]) for r in odd_docs.collect())
    for own in (items, items.limit(0)):
        got = decontaminate.report(decontaminate.contamination(odd_docs, own)).collect()
        assert sorted(str(r["doc_id"]) for r in got) == want
    monkeypatch.setattr(decontaminate, "sized_broadcast", lambda df, width: df)
    got = decontaminate.report(decontaminate.contamination(odd_docs, items)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == want
    assert [r["contaminated"] for r in got if r["doc_id"] == 3] == [True, True]


def test_decontamination_aggregates_rows_without_their_words(spark, make_docs, monkeypatch):
    # a copy of the words in every hit row took hits x words, and a task kept the words of all its documents
    items = spark.createDataFrame([(1, "a b c"), (2, "d e")], "item_id long, text string")
    for own in (decontaminate.sized_broadcast, lambda df, width: df):
        monkeypatch.setattr(decontaminate, "sized_broadcast", own)
        node, inputs = decontaminate.contamination(make_docs([(1, "x a b c")]), items)._jdf.queryExecution().sparkPlan(), []
        while node.children().size():
            if node.nodeName() == "ObjectHashAggregate":
                inputs.append(node.child().schema().simpleString())
            node = node.children().apply(0)
        assert len(inputs) == 2 and not any("array<string>" in x for x in inputs), inputs


def test_decontamination_stays_native(spark, make_docs):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    df = decontaminate.report(decontaminate.contamination(make_docs([(1, "a b c")]), items))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---- language id --------------------------------------------------------------------------------

ENGLISH = "the cat and the dog were with the bird on that thing over there "
FRENCH = "le chat et les chiens sont avec un oiseau dans une maison près de là "


def test_language_fusion(make_docs):
    docs = [(i, ENGLISH * 300, "en", "h0", 1) for i in range(20)] + [(i + 20, FRENCH * 300, "fr", "h1", 1) for i in range(20)]
    docs += [(50, FRENCH * 5, "en", "h0", 1), (51, "", "en", "h0", 1), (52, None, "fr", "h1", 1),
             (53, "日本語の文章です。" * 20, None, "h0", 1)]
    table = make_docs(docs)
    rows = language_id.document_evidence(table)
    both = ("en", "fr")
    found = language_id.identify(rows, language_id.train(rows, both), language_id.host_priors(rows, both))
    out = {r["_row"]["doc_id"]: r["id"] for r in found.collect()}
    assert all(out[i]["lang"] == "en" and out[i]["accepted"] for i in range(20))
    assert all(out[i]["lang"] == "fr" for i in range(20, 40))
    assert out[50]["lang"] == "fr"                              # the text outweighs a wrong declaration
    assert out[51]["lang"] == out[52]["lang"] == "und" and not out[51]["accepted"]
    assert out[53]["lang"] == "und"


ITALIAN = "il gatto e gli uccelli sono nella casa che si trova vicino alla strada della città "


@pytest.mark.parametrize("rows_of_it", [1, 19, 20, 30])
def test_a_fifth_declared_language_is_modelled_however_few_its_rows(make_docs, rows_of_it):
    docs = [(i, ENGLISH * 30, "en", "h0", 1) for i in range(30)] + [(i + 30, FRENCH * 30, "fr", "h2", 1) for i in range(30)]
    docs += [(100 + i, ITALIAN * 30, "it", "h1", 1) for i in range(rows_of_it)]
    table = make_docs(docs)
    assert language_id.modelled(language_id.document_evidence(table)) == (*language_id.LANGUAGES, "it")
    assert {r["doc_id"] for r in language_id.accepted_documents(table).collect()} == {d[0] for d in docs}
    rows = language_id.document_evidence(table)
    known = language_id.modelled(rows)
    out = language_id.identify(rows, language_id.train(rows, known), language_id.host_priors(rows, known)).collect()
    assert all(r["id"]["lang"] == r["_row"]["lang"] for r in out)


def brute_languages(rows, train_rows, languages):
    """``rows``: (key, text, declared, host, suffix).  The posterior by its formula, one trigram after the other."""
    def grams(text):
        data = text.lower().encode("utf-8", "replace")
        return [(int.from_bytes(data[i:i + 3], "big") * 2654435761 % 2 ** 32) >> 16 for i in range(len(data) - 2)]
    counts = {x: Counter() for x in languages}
    for _, text, said, _, _ in train_rows:
        if said in counts and text is not None:
            counts[said].update(grams(text))
    of = {x: sum(r[2] == x for r in rows) for x in languages}
    k, out = len(languages), {}
    top = {x: (n + 20 / k) / (sum(of.values()) + 20) for x, n in of.items()}

    def shrunk(same, parent):
        n = {x: sum(r[2] == x for r in rows if same(r)) for x in languages}
        return {x: (n[x] + 20 * parent[x]) / (sum(n.values()) + 20) for x in languages}
    for key, text, said, host, suffix in rows:
        if not (text or "").strip():
            out[key] = ("und", 1.0)
            continue
        g = grams(text)
        prior = shrunk(lambda r: (r[3], r[4]) == (host, suffix), shrunk(lambda r: r[4] == suffix, top))  # noqa: B023
        damp = 1 + len(g) / 200
        log = {"und": -len(g) * math.log(65536) / damp + math.log(0.01) + (math.log(1 / k) if said in counts else 0)}
        for x in languages:
            total = sum(counts[x].values()) + 0.5 * 65536
            log[x] = sum(math.log((counts[x][b] + 0.5) / total) for b in g) / damp + math.log(prior[x] * 0.99)
            if said in counts:
                log[x] += math.log(0.8 if said == x else 0.2 / (k - 1))
        high = max(log.values())
        best = max(languages + ("und",), key=lambda x: log[x])  # noqa: B023
        out[key] = (best, math.exp(log[best] - high) / sum(math.exp(v - high) for v in log.values()))
    return out


def same_languages(found, want):
    assert set(found) == set(want)
    for key, (lang, posterior) in want.items():
        assert found[key][0] == lang and abs(found[key][1] - posterior) < 1e-6


@pytest.mark.parametrize("limit", [1 << 26, 0])
def test_posterior_equals_a_plain_version_for_documents_and_pages(spark, make_docs, limit):
    rng = random.Random(2)
    pool = {"en": ENGLISH.split(), "fr": FRENCH.split(), "it": ITALIAN.split(), "x-y": ["zz", "qq", "été"]}
    docs = []
    for i in range(60):
        lang = rng.choice(list(pool))
        text = " ".join(rng.choice(pool[rng.choice([lang, lang, "en"])]) for _ in range(rng.randint(0, 40)))
        docs.append((i, text, rng.choice([lang, lang, None, "und", ""]), rng.choice(["h0", "h1", None]), 1))
    docs += [(100, None, "en", "h0", 1), (101, " \n", "fr", None, 1), (102, "ab", "en", "h1", 1)]
    markup = [("<html lang='fr'><body><p>{}</p></body></html>", "http://a.fr/x"), ("<HTML LANG=it><script>en en</script>{}", "https://u@b.it:80/"),
              ("{}", "nothing"), ("<html><!-- x -->{}", "http://C.com?q"), ("<html lang=\"en-US\"><p>{}", None)]
    pages = [(i, markup[i % 5][1], markup[i % 5][0].format(docs[i][1])) for i in range(40)] + [(99, None, None)]
    rows = language_id.document_evidence(make_docs(docs))
    known = language_id.modelled(rows)
    assert known == ("en", "fr", "de", "es", "it", "x-y")
    model = language_id.train(rows, known)

    def found(evidence, key):
        out = language_id.identify(evidence, model, language_id.host_priors(evidence, known), limit=limit)
        return {r["_row"][key]: (r["id"]["lang"], r["id"]["posterior"]) for r in out.collect()}
    plain = [(d[0], d[1], d[2], d[3], "") for d in docs]
    same_languages(found(rows, "doc_id"), brute_languages(plain, plain, known))
    of_pages = language_id.page_evidence(spark.createDataFrame(pages, "page_id long, url string, html string"))
    said = {0: ("fr", "a.fr", "fr"), 1: ("it", "b.it", "it"), 2: ("", "", ""), 3: ("", "c.com", "com"), 4: ("en", None, None)}
    evidence = {r["_row"]["page_id"]: (r["text"], r["declared"], r["host"], r["suffix"]) for r in of_pages.collect()}
    assert all(evidence[i][1:] == said[i % 5] and (docs[i][1] or "").split() == evidence[i][0].split() for i in range(40))
    same_languages(found(of_pages, "page_id"), brute_languages([(k, *v) for k, v in evidence.items()], plain, known))


def test_a_long_text_with_many_languages_stays_small():
    rng = np.random.default_rng(0)
    langs = 200
    lang = np.tile(np.arange(langs, dtype=np.int32), language_id.BUCKETS)
    entries = language_id.Entries(np.full(langs, -9.0), np.arange(language_id.BUCKETS + 1) * langs, lang, rng.random(len(lang)))
    text = "".join(map(chr, rng.integers(97, 500, 600_000)))
    tracemalloc.start()
    like, n = entries.likelihoods(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 1_000_000 and len(like) == langs and peak < 60e6
    bucket, times = language_id.bucket_counts(text)
    want = -9.0 * n + entries.weight.reshape(-1, langs)[bucket].T @ times
    assert np.allclose(like, want)


def test_host_prior_is_smoothed_by_suffix(spark):
    rows = spark.createDataFrame(
        [("a.fr", "fr", "fr")] * 30 + [("b.fr", "fr", "en")] + [("c.com", "com", "en")] * 50 + [(None, None, None)],
        "host string, suffix string, declared string")
    table, top = language_id.host_priors(rows, ("en", "fr"))
    prior = {r["_host"]: r["prior"] for r in table.collect()}
    assert abs(sum(top) - 1) < 1e-9 and all(abs(sum(p) - 1) < 1e-9 for p in prior.values())
    assert prior["a.fr"][1] > prior["b.fr"][1] > prior["c.com"][1]
    suffix_fr = (30 + 20 * top[1]) / (31 + 20)
    assert abs(prior["b.fr"][1] - (0 + 20 * suffix_fr) / (1 + 20)) < 1e-9


def test_language_odd_rows(odd_docs, no_docs):
    kept = language_id.accepted_documents(odd_docs)
    assert kept.columns == odd_docs.columns
    assert {r["doc_id"] for r in kept.collect()} <= {None, 3, 4, 5, 6}
    assert language_id.accepted_documents(no_docs).count() == 0


# ---- SimHash ------------------------------------------------------------------------------------

def brute_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(len(words) - k + 1, 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, max_bits):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= max_bits:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(fps))]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=" \t\n aAbBÉé.", max_size=60))
def test_fingerprint_of_any_text(text):
    assert simhash.fingerprint(text.encode(), 3) % (1 << 64) == brute_fingerprint(text)


def test_links_find_every_near_pair_also_in_crowded_values(spark, monkeypatch):
    import random

    rng = random.Random(3)
    centre = rng.getrandbits(64)
    near = {centre ^ sum(1 << b for b in rng.sample(range(20), rng.randint(0, 3))) for _ in range(300)}
    far = {rng.getrandbits(64) for _ in range(200)}
    chain = [rng.getrandbits(64)]
    for _ in range(30):
        chain.append(chain[-1] ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    fps = sorted(near | far | set(chain) | {0})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    for max_bits, crowd in ((2, 64), (2, 4), (1, 4), (3, 8)):
        monkeypatch.setattr(simhash, "GROUP", crowd)
        table = spark.createDataFrame([(f,) for f in signed], "fp long")
        roots = {r["fp"]: r["root"] for r in simhash.components(simhash.links(table, max_bits)).collect()}
        got, want = {}, {}
        for f, part in zip(signed, brute_components(fps, max_bits), strict=True):
            got.setdefault(roots.get(f, f), set()).add(f)
            want.setdefault(part, set()).add(f)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_thresholds_satisfy_the_pigeonhole():
    cost, chosen = simhash.allocate([[0, 5, 50, 500], [0, 1, 2, 3], [0, 100, 100, 100]], 2)
    assert sum(t + 1 for t in chosen) == 3 and (cost, chosen) == (3, [-1, 2, -1])


def test_near_duplicates_odd_rows(odd_docs, no_docs):
    got = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(odd_docs).collect()}
    assert {(1, 1), (2, 1), (7, 1), (5, 5), (6, 5), (3, 3)} <= got
    stay = simhash.one_per_group(odd_docs)
    assert stay.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in stay.collect()) == sorted(map(str, [1, None, 3, 4, 4, 5]))
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.one_per_group(no_docs).count() == 0


# ---- chunk dedup --------------------------------------------------------------------------------

def passage(seed, n):
    import random

    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 9))) for _ in range(n))


@settings(max_examples=40, deadline=None)
@given(st.binary(max_size=3000))
def test_cuts_cover_the_text_and_depend_on_content(data):
    ends = substring_dedup.cuts(data)
    assert (ends[-1] if ends else 0) == len(data) and ends == sorted(set(ends))
    assert all(b - a <= substring_dedup.MOST for a, b in zip([0, *ends], ends, strict=False))


def test_gear_hash_is_the_rolling_one():
    data = passage(1, 400).encode()
    h, hits = 0, []
    for i, b in enumerate(data):
        h = (2 * h + int(substring_dedup.GEAR[b])) % (1 << 16)
        if h >> (16 - substring_dedup.BITS) == 0:
            hits.append(i + 1)
    # the first bytes of a text have not filled the window
    assert [x for x in substring_dedup._hits(__import__("numpy").frombuffer(data, "u1")).tolist() if x > 16] == [x for x in hits if x > 16]


def test_repeated_passages_go_and_clean_texts_stay(make_docs):
    shared = passage(0, 60)
    docs = [(1, passage(1, 80) + " " + shared + " " + passage(2, 50)), (2, passage(3, 33) + ". X " + shared + " " + passage(4, 70)),
            (3, passage(5, 200)), (4, passage(6, 10) + shared), (5, passage(5, 200))]
    got = {r["doc_id"]: r for r in substring_dedup.dedup(make_docs(docs)).collect()}
    assert [got[i]["n_removed"] for i in (1, 3)] == [0, 0] and got[1]["text"] == docs[0][1]
    for i in (2, 4):
        assert got[i]["n_removed"] > 0.5 * len(shared) and passage(4 if i == 2 else 6, 10)[:40] in got[i]["text"]
    assert got[5]["text"] == "" and got[5]["n_removed"] == got[5]["n_bytes"]


def test_passages_of_51_words_go_at_any_shift(make_docs):
    import random

    rng = random.Random(51)
    words = [passage(100 + i, 1) for i in range(300)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = [say(51) for _ in range(300)] + [passage(1000 + i, 51) for i in range(300)]
    docs, want = [], {}
    for i, text in enumerate(shared):
        docs.append((i, passage(3000 + i, rng.randint(20, 60)) + " " + text + " " + passage(5000 + i, 30)))
        before, behind = passage(7000 + i, rng.randint(1, 60))[rng.randint(0, 3):] + "#", "#" + passage(9000 + i, rng.randint(1, 60))
        docs.append((10_000 + i, before + text + behind))
        want[10_000 + i] = before + behind
    got = {r["doc_id"]: r for r in substring_dedup.dedup(make_docs(docs)).collect()}
    assert all(got[i]["n_removed"] == 0 for i in range(len(shared)))
    assert [i for i in want if got[i]["text"] != want[i]] == []


def test_stretches_of_run_bytes_share_a_chunk():
    import random

    rng = random.Random(8)
    for i in range(2000):
        text = passage(i, 40).encode()[:substring_dedup.RUN]
        found = []
        for _ in range(2):
            data = rng.randbytes(rng.randint(0, 200)) + text + rng.randbytes(rng.randint(0, 200))
            ends, low = substring_dedup.cuts(data), data.index(text)
            found.append({(a - low, b - low) for a, b in itertools.pairwise([0, *ends]) if a >= low and b <= low + len(text)})
        assert found[0] & found[1]


def test_a_partly_repeated_character_stays(make_docs):
    shared = passage(0, 40)
    got = {r["doc_id"]: r["text"] for r in substring_dedup.dedup(make_docs([(1, "x" + shared + "é."), (2, "y" + shared + "è!")])).collect()}
    assert got[2] == "yè!"


def test_substring_odd_rows(odd_docs, no_docs):
    got = {(r["doc_id"], r["n_bytes"], r["n_removed"] > 0) for r in substring_dedup.dedup(odd_docs).collect()}
    assert {(1, 0, False), (2, 0, False), (None, 28, False)} <= got
    assert {x[2] for x in got if x[0] == 6} == {True}
    assert substring_dedup.dedup(no_docs).count() == 0


def plain_substring_dedup(docs):
    """``{doc_id: (n_repeated, spans, text)}`` of ``(doc_id, text)`` in their order, byte by byte."""
    last, out = {}, {}
    texts = {i: text.encode() for i, text in docs}
    for i, data in texts.items():
        ends = substring_dedup.cuts(data)
        chunks = list(itertools.pairwise([0, *ends])) if ends else []
        covered, repeated = set(), 0
        for a, b in chunks:
            before = last.get(data[a:b])
            last[data[a:b]] = (i, a)
            if before is None:
                continue
            repeated += 1
            other, low = texts[before[0]], before[1]
            covered.update(range(a, b))
            for step, x, y in ((-1, a - 1, low - 1), (1, b, low + b - a)):
                n = 0
                while n < substring_dedup.RUN and 0 <= x < len(data) and 0 <= y < len(other) and data[x] == other[y]:
                    covered.add(x)
                    x, y, n = x + step, y + step, n + 1
        spans, places = [], sorted(covered)
        for _, run in itertools.groupby(enumerate(places), lambda e: e[1] - e[0]):
            run = [p for _, p in run]
            if len(run) >= substring_dedup.RUN:
                spans.append(substring_dedup.whole_characters(data, run[0], run[-1] + 1))
        gone = {p for a, b in spans for p in range(a, b)}
        out[i] = (repeated, spans, bytes(c for p, c in enumerate(data) if p not in gone).decode())
    return out


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 30_000, "bucket_bytes": 50_000}])
def test_substring_dedup_equals_a_plain_version_on_a_whole_table(spark, sizes):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = plain_substring_dedup(sorted((r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()))
    got = {r["doc_id"]: (r["n_repeated"], [tuple(s) for s in r["spans"]], r["text"])
           for r in substring_dedup.dedup(docs, **sizes).collect()}
    assert [i for i in want if got[i] != want[i]] == [] and len(got) == docs.count()


def test_substring_blocks_make_no_difference(odd_docs, make_docs):
    many = make_docs([(i, passage(i % 7, 60) + f" {i} " + passage(1000 + i, 30)) for i in range(120)])
    for docs in (odd_docs, many):
        rows = [sorted((r["doc_id"] or 0, r["n_bytes"], r["n_repeated"], r["n_removed"], str(r["spans"]), r["text"])
                       for r in substring_dedup.dedup(docs, **sizes).collect())
                for sizes in ({}, {"block_bytes": 4_000, "bucket_bytes": 3_000})]
        assert rows[0] == rows[1] and len(rows[0]) == docs.count()


def test_a_task_s_pieces_go_with_it():
    """A Python worker outlives its task; what it met there would lie beside the next operator's memory."""
    from playtrack.llm import tokens

    with tokens.encoding("byte_bpe_50k.json", True) as tokenizer:
        before = tokenizer.encode(["some words of a text, and more words"])
        assert len(tokenizer.cache) > 5
    assert len(tokenizer.cache) == 1 and not tokenizer.older
    with pytest.raises(ValueError), tokens.encoding("byte_bpe_50k.json", True) as tokenizer:
        assert tokenizer.encode(["some words of a text, and more words"]) == before       # loaded once, forgets pieces only
        raise ValueError
    assert len(tokenizer.cache) == 1 and tokenizer is tokens.piece_tokenizer("byte_bpe_50k.json", True)
