"""File sources and sinks."""

from __future__ import annotations

import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

INJURY_SCHEMA = StructType([
    StructField("PlayerKey", StringType()), StructField("GameID", StringType()),
    StructField("PlayKey", StringType()), StructField("BodyPart", StringType()),
    StructField("Surface", StringType()), StructField("DM_M1", IntegerType()),
    StructField("DM_M7", IntegerType()), StructField("DM_M28", IntegerType()),
    StructField("DM_M42", IntegerType()),
])

# The play list with its first three columns renamed by position (a supplied
# CSV schema is applied by position, not by header name).
PLAY_LIST_SCHEMA = StructType([
    StructField("play_PlayerKey", StringType()), StructField("play_GameID", StringType()),
    StructField("play_PlayKey", StringType()), StructField("RosterPosition", StringType()),
    StructField("PlayerDay", IntegerType()), StructField("PlayerGame", IntegerType()),
    StructField("StadiumType", StringType()), StructField("FieldType", StringType()),
    StructField("Temperature", DoubleType()), StructField("Weather", StringType()),
    StructField("PlayType", StringType()), StructField("PlayerGamePlay", IntegerType()),
    StructField("Position", StringType()), StructField("PositionGroup", StringType()),
])

# The play list under its own header names (the layout the operators use).
PLAY_SCHEMA = StructType([StructField(f.name.replace("play_", ""), f.dataType) for f in PLAY_LIST_SCHEMA.fields])

TRACK_SCHEMA = StructType([StructField("PlayKey", StringType()), StructField("time", DoubleType()),
                           StructField("event", StringType())]
                          + [StructField(c, DoubleType()) for c in ["x", "y", "dir", "dis", "o", "s"]])


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None, infer: bool = False,
             sep: str = ",") -> DataFrame:
    """CSV with a header line.  ``schema`` given: applied by position, no
    inference pass; ``infer=True``: one extra pass to infer types; neither:
    every column is text."""
    reader = spark.read.option("header", True).option("sep", sep)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> str:
    """Parquet sink; ``overwrite`` by default so a re-run does not repeat rows
    (``append_parquet`` adds batches that are safe to repeat)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


# -- append as a commit (S5) ---------------------------------------------------------
_MANIFESTS = "_manifests"


class _Store:
    """The file system of a path, wherever it is: Spark's own Hadoop client."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.root = self.jvm.org.apache.hadoop.fs.Path(path)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.files = self.root.getFileSystem(conf)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.files.getUri(), conf)
        self.no_options = spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)

    def path(self, *parts: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.root, "/".join(parts))

    def exists(self, path) -> bool:
        return self.files.exists(path)

    def publish(self, text: str, path, attempt: str) -> bool:
        """Make ``path`` a file of this text, whole or not at all; False if it is there already."""
        draft = self.path(_MANIFESTS, f".{attempt}")
        out = self.files.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            self.context.rename(draft, path, self.no_options)       # refuses a target that exists
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in str(error.java_exception):
                raise
            self.files.delete(draft, False)
            return False
        return True

    def read(self, path) -> str:
        stream = self.files.open(path)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def names(self, *parts: str) -> list[str]:
        folder = self.path(*parts)
        return sorted(f.getPath().getName() for f in self.files.listStatus(folder)) if self.exists(folder) else []


def append_parquet(df: DataFrame, path: str, batch: str) -> bool:
    """Append ``df`` as the batch of this name; False (and nothing added) if that batch is committed already.

    The rows go to a folder named by batch and attempt, then one small
    manifest names that folder.  Readers follow manifests, so an attempt that
    died, or lost a race with another of the same batch, is never read, and a
    repeated batch adds no rows.
    """
    store = _Store(df.sparkSession, path)
    name = re.sub(r"[^A-Za-z0-9_=-]", lambda m: f"%{ord(m[0]):x}.", batch)
    manifest, attempt = store.path(_MANIFESTS, f"{name}.json"), f"{name}-{uuid.uuid4().hex}"
    if store.exists(manifest):
        return False
    folder = store.path("data", attempt)
    df.write.parquet(folder.toString())
    if store.publish(json.dumps({"batch": batch, "folder": attempt, "schema": df.schema.jsonValue()}), manifest, attempt):
        return True
    store.files.delete(folder, True)
    return False


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all committed batches; columns that a batch lacks are null in its rows."""
    store = _Store(spark, path)
    found = [json.loads(store.read(store.path(_MANIFESTS, n))) for n in store.names(_MANIFESTS) if not n.startswith(".")]
    if not found:
        raise FileNotFoundError(f"no committed batch in {path}")
    schema: dict[str, StructField] = {}
    for m in found:
        for field in StructType.fromJson(m["schema"]).fields:
            if schema.setdefault(field.name, field).dataType != field.dataType:
                raise ValueError(f"batch {m['batch']} has another type for column {field.name}")
    fields = StructType([StructField(f.name, f.dataType) for f in schema.values()])
    return spark.read.schema(fields).parquet(*[store.path("data", m["folder"]).toString() for m in found])
