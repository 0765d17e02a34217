"""CSV sources as the reference reads them: header with a UTF-8 byte-order
mark, fixed schema applied by position, inferred schema, all-text read."""

import os
import tempfile

import pytest

from playtrack.sources import files as IO

HEADER = "PlayerKey,GameID,PlayKey,BodyPart,Surface,DM_M1,DM_M7,DM_M28,DM_M42\n"
ROWS = ["39873,39873-4,39873-4-32,Knee,Synthetic,1,1,1,1\n", "46074,46074-7,,Knee,Natural,1,1,0,0\n"]


def _csv(spark):
    ckpt = spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp()
    folder = tempfile.mkdtemp(prefix="csv-", dir=ckpt.replace("file:", "") if ckpt.startswith("file:") else None)
    path = os.path.join(folder, "injury.csv")
    with open(path, "w", encoding="utf-8-sig") as fh:        # writes the byte-order mark
        fh.write(HEADER + "".join(ROWS))
    return path


def test_fixed_schema_skips_bom_header(spark):
    df = IO.read_csv(spark, _csv(spark), schema=IO.INJURY_SCHEMA)
    rows = sorted(df.collect())
    assert len(rows) == 2 and rows[0].PlayerKey == "39873" and rows[1].PlayKey is None
    assert rows[0].DM_M42 == 1 and dict(df.dtypes)["DM_M1"] == "int"


def test_inferred_schema(spark):
    df = IO.read_csv(spark, _csv(spark), infer=True)
    assert df.columns[0] == "PlayerKey"                     # the mark is not part of the name
    assert dict(df.dtypes)["PlayerKey"] == "int" and dict(df.dtypes)["DM_M7"] == "int"


def test_all_text_read(spark):
    df = IO.read_csv(spark, _csv(spark))
    assert set(dict(df.dtypes).values()) == {"string"}


def test_positional_schema_renames(spark):
    df = IO.read_csv(spark, _csv(spark), schema=IO.PLAY_LIST_SCHEMA)
    assert df.columns[:3] == ["play_PlayerKey", "play_GameID", "play_PlayKey"]


def test_stored_staging_equals_lazy_derivation(spark):
    """The bucketed tables stored once per session hold exactly the rows the
    lazy derivation from the driver's parquet tables gives."""
    import pytest

    from playtrack.sources import staging as S

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver test data not present")
    for stored, lazy in [(S.plays, S.derive_plays), (S.injuries, S.derive_injuries), (S.tracks, S.derive_tracks)]:
        a, b = stored(spark, sf), lazy(spark, sf)
        assert a.columns == b.columns
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_play_schema_header_names():
    assert IO.PLAY_SCHEMA.names[:3] == ["PlayerKey", "GameID", "PlayKey"]
    assert IO.PLAY_SCHEMA.names[3:] == IO.PLAY_LIST_SCHEMA.names[3:]


# -- append as a commit ------------------------------------------------------------------

def _batch(spark, *ids):
    return spark.createDataFrame([(i, f"r{i}") for i in ids], "id int, name string")


def _ids(df):
    return sorted(r["id"] for r in df.collect())


def test_a_repeated_batch_adds_no_rows(spark):
    path = tempfile.mkdtemp(prefix="append-")
    assert IO.append_parquet(_batch(spark, 1, 2), path, "2024-01-01")
    assert IO.append_parquet(_batch(spark, 2, 3), path, "2024-01-02")       # rows may repeat, batches not
    assert not IO.append_parquet(_batch(spark, 1, 2), path, "2024-01-01")
    assert not IO.append_parquet(_batch(spark, 9), path, "2024-01-01")
    assert _ids(IO.read_appended(spark, path)) == [1, 2, 2, 3]
    assert IO.append_parquet(_batch(spark), path, "empty/../batch: 3") and _ids(IO.read_appended(spark, path)) == [1, 2, 2, 3]


def test_a_half_written_batch_is_never_read(spark):
    path = tempfile.mkdtemp(prefix="append-")
    assert IO.append_parquet(_batch(spark, 1), path, "a")
    _batch(spark, 7).write.parquet(f"{path}/data/b-dead")                   # files, but no manifest
    with open(f"{path}/_manifests/.b-dead", "w") as file:
        file.write('{"batch": "b", "fol')                                   # a draft that was never published
    assert _ids(IO.read_appended(spark, path)) == [1]
    assert IO.append_parquet(_batch(spark, 8), path, "b") and _ids(IO.read_appended(spark, path)) == [1, 8]


def test_the_second_of_two_racing_attempts_adds_nothing(spark, monkeypatch):
    path, looked = tempfile.mkdtemp(prefix="append-"), IO._Store.exists
    assert IO.append_parquet(_batch(spark, 1), path, "a")
    with monkeypatch.context() as m:
        m.setattr(IO._Store, "exists", lambda self, p: False if p.toString().endswith("a.json") else looked(self, p))
        assert not IO.append_parquet(_batch(spark, 5), path, "a")           # it had looked before the other one published
    assert _ids(IO.read_appended(spark, path)) == [1]
    assert len(os.listdir(f"{path}/data")) == 1 and not [n for n in os.listdir(f"{path}/_manifests") if n.startswith(".a-")]


def test_batches_may_gain_columns_but_not_change_them(spark):
    path = tempfile.mkdtemp(prefix="append-")
    IO.append_parquet(_batch(spark, 1), path, "a")
    IO.append_parquet(spark.createDataFrame([(2, 0.5)], "id int, score double"), path, "b")
    got = {(r["id"], r["name"], r["score"]) for r in IO.read_appended(spark, path).collect()}
    assert got == {(1, "r1", None), (2, None, 0.5)}
    IO.append_parquet(spark.createDataFrame([("x",)], "id string"), path, "c")
    with pytest.raises(ValueError, match="another type"):
        IO.read_appended(spark, path)
    with pytest.raises(FileNotFoundError):
        IO.read_appended(spark, tempfile.mkdtemp())
