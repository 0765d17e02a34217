"""Stored tables: a query stores what it reads and no more; rows are dealt before their texts are made; buckets follow the staged bytes."""

import os

import pytest

from playtrack.plans import queries
from playtrack.sources import staging as S

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.mark.parametrize("name, stored", [
    ("ml_hash_split", {"plays"}), ("injury_renamed", {"plays", "injuries"}), ("injury_play_detail", {"plays", "injuries"}),
    ("frames_trimmed", {"plays", "tracks", "snaps", "ends"}),
    ("game_features", {"plays", "game_marks", "game_rows"})])
def test_a_query_stores_what_it_reads(spark, tmp_path, name, stored):
    os.symlink(SF, tmp_path / "sf")
    folder = str(tmp_path / "sf")                         # another path: nothing is stored for it yet
    queries()[name](spark, folder).collect()
    found = [names for (_, at, _), names in S._STORED.items() if at == folder]
    assert [set(names) for names in found] == [stored]


def test_plays_are_dealt_without_their_texts(spark):
    _, _, _, rows = S._store_plays(spark, SF, 4)
    lines = rows._jdf.queryExecution().optimizedPlan().toString().splitlines()
    dealt = next(i for i, line in enumerate(lines) if "RepartitionByExpression" in line)
    for text in ("Linebacker", "Natural", "Mostly Coudy"):
        assert next(i for i, line in enumerate(lines) if text in line) < dealt


def test_a_bucket_holds_a_bounded_share_of_the_staged_rows(spark, monkeypatch):
    """88 MB of source files were 1.6 GB of staged rows in memory (six times sf0.1)."""
    for files in (88e6, 88e7, 88e8):
        monkeypatch.setattr(S, "source_state", lambda *_, size=files: ((int(size), 0),))
        assert files * 18 / S.bucket_count(spark, "any") <= 1.01 * S.BYTES_PER_BUCKET


def test_plays_are_dealt_once_for_both_facts(spark, tmp_path):
    from playtrack.operators import features as FE

    plan = FE.facts_together(S.plays(spark, SF), 4)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1
    for conf in (None, "3"):                            # every key in a heavy slot: summed before it is dealt
        os.symlink(SF, tmp_path / f"sf{conf}")
        folder = str(tmp_path / f"sf{conf}")
        if conf:
            spark.conf.set("spark.playtrack.hotKeyRows", conf)
        try:
            stored = S.game_facts(spark, folder)
        finally:
            spark.conf.unset("spark.playtrack.hotKeyRows")
        expected = FE.game_facts(S.plays(spark, folder))
        for a, b in zip(stored, expected, strict=True):
            assert a.columns == b.columns and a.count() == b.count() > 0
            assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_appended_batches_read_rows_derived_once(spark, monkeypatch):
    from playtrack.plans import q_io

    plans, append = [], q_io.IO.append_parquet
    monkeypatch.setattr(q_io.IO, "append_parquet", lambda df, *a: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or append(df, *a))
    queries()["sink_parquet_append"](spark, SF).collect()
    assert len(plans) == 3 and not any("Join" in p or "Aggregate" in p for p in plans)


def test_categories_are_dealt_as_numbers_and_come_back(spark):
    """Their texts were about a fifth of the bytes dealt; unusual values and nulls travel as they are."""
    from playtrack.operators import features as FE

    plan = FE.facts_together(S.plays(spark, SF), 4)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    below = plan[next(i for i, line in enumerate(plan) if "RepartitionByExpression" in line) + 1]
    assert "_number" in below and "AS StadiumType#" not in below
    lines = S._as_plays(S._line_rows(spark, SF, 4).repartition(4, S._play_key()))._jdf.queryExecution().optimizedPlan()
    found, dealt = [lines], None
    while dealt is None:
        node = found.pop(0)
        dealt = node if node.nodeName() == "RepartitionByExpression" else None
        found += [node.children().apply(i) for i in range(node.children().size())]
    kinds = [f.split(":")[1] for f in dealt.schema().simpleString()[7:-1].split(",")]
    assert kinds.count("string") == 3 and kinds.count("tinyint") == 4, kinds        # the return flag, the part's type and brand
    rows = [("1", "Safety", "outdoor", "Natural", "clear", "Rush"), ("2", None, "Roof of tin", None, "hail", "Missing"), ("3", *[None] * 5)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ("k", "RosterPosition", "StadiumType", "FieldType", "Weather", "PlayType")))
    back = FE._spelled(FE._numbered(df)).select(*df.columns)
    assert sorted(map(tuple, back.collect())) == rows
    assert [r["k"] for r in FE._numbered(df).where("_texts is null").collect()] == ["1"]
    assert all(len(v) < 1 << FE._USUAL_BITS for v in FE.USUAL.values())
