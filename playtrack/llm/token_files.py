"""Token ids as flat unsigned binary files with 64-bit document offsets.

Layout under one folder, in ascending ``doc_id`` order (null first, then by
text digest):

    part-00000-<attempt>.bin   ids, little-endian uint16 (vocabularies up to 65,536) or uint32
    part-00000-<attempt>.idx   int64 offsets of the part's documents, counted in ids from the part's start (documents + 1)
    part-00000-<attempt>.doc   int64 document ids (the least int64 stands for null)
    manifest.json              dtype, and per part: file name, documents, ids, and the bases that prefix sums give

A document's ids are ``bin[base + idx[i] : base + idx[i + 1]]`` of the whole;
files are opened by memory map where the folder is a local path, else read as
a stream.

Scale: one range shuffle of the texts; every range is sorted, encoded and
written by one task, in the shared folder that the session names.  Every
attempt of a task writes files of its own and the manifest names those of the
attempt that Spark counted, so lost executors and second attempts need no
rename or overwrite, which stores treat differently.  The driver only sees one
row per part.

Defined cases: null and empty texts are the end id alone; repeated ids stay
separate documents; an empty table gives a manifest without parts; other
columns are not read.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playtrack.session import scratch_path

from .common import text_or_empty
from .tokens import encoding

VOCABULARY = "word_bpe_49k.json"
END = 2
NULL_ID = -(1 << 63)


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, end: int = END, keeps_space: bool = False) -> dict:
    """Writes the files of ``docs`` (``doc_id``, ``text``) into ``folder`` and returns the manifest."""
    from tokenizers import Tokenizer

    from .tokens import vocabulary_path

    spark = docs.sparkSession
    size = Tokenizer.from_file(vocabulary_path(vocabulary)).get_vocab_size()
    dtype = "<u2" if max(size, end + 1) <= 1 << 16 else "<u4"
    store, root = _store(folder)
    store.create_dir(root)
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
               .withColumn("digest", F.xxhash64("text"))
               .repartitionByRange(ranges, "doc_id", "digest").sortWithinPartitions("doc_id", "digest"))

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        store, root = _store(folder)
        name = f"part-{task.partitionId():05d}-{uuid.uuid4().hex}"
        offsets, ids, out, total = [0], [], None, 0
        with encoding(vocabulary, keeps_space) as tokenizer:
            for batch in batches:
                texts = batch["text"].tolist()
                numbers = batch["doc_id"].tolist()
                for at in range(0, len(texts), 200):
                    if out is None:
                        out = store.open_output_stream(f"{root}/{name}.bin")
                    for got in tokenizer.encode(texts[at:at + 200]):
                        block = np.append(np.frombuffer(got, "<u4"), end).astype(dtype)
                        out.write(block.tobytes())
                        total += len(block)
                        offsets.append(total)
                    ids += [NULL_ID if x is None or x != x else int(x) for x in numbers[at:at + 200]]
        if out is not None:
            out.close()
            for kind, values in (("idx", offsets), ("doc", ids)):
                with store.open_output_stream(f"{root}/{name}.{kind}") as f:
                    f.write(np.array(values, "<i8").tobytes())
            yield pd.DataFrame({"part": [task.partitionId()], "file": [name], "documents": [len(ids)], "ids": [total]})
    # nullable long ids reach the task as strings, so that pandas keeps them exact
    rows = (ordered.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
            .mapInPandas(put, "part int, file string, documents long, ids long").collect())       # one row a part
    parts, documents, ids = [], 0, 0
    for r in sorted(rows, key=lambda r: r["part"]):
        parts.append({"part": r["part"], "file": r["file"], "documents": r["documents"], "ids": r["ids"],
                      "first_document": documents, "first_id": ids})
        documents, ids = documents + r["documents"], ids + r["ids"]
    manifest = {"dtype": dtype, "documents": documents, "ids": ids, "parts": parts}
    with store.open_output_stream(f"{root}/manifest.json") as f:
        f.write(json.dumps(manifest).encode())
    return manifest


def _open(store, path: str):
    import pyarrow as pa
    from pyarrow import fs

    return pa.memory_map(path) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(path)


def read(spark: SparkSession, folder: str, keep_ids: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32[, ids])`` of every document, from the files alone."""
    store, root = _store(folder)
    with store.open_input_file(f"{root}/manifest.json") as f:
        manifest = json.loads(f.read())
    dtype, parts = np.dtype(manifest["dtype"]), manifest["parts"]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * keep_ids

    def get(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = _store(folder)
        for batch in batches:
            for file, first in zip(batch["file"], batch["first_id"], strict=True):
                name = f"{root}/{file}"
                with _open(store, f"{name}.idx") as a, _open(store, f"{name}.doc") as b, _open(store, f"{name}.bin") as c:
                    at, docs = np.frombuffer(a.read(), "<i8"), np.frombuffer(b.read(), "<i8")
                    for low in range(0, len(docs), 500):
                        high, rows = min(low + 500, len(docs)), []
                        for i in range(low, high):
                            n = int(at[i + 1] - at[i])
                            own = np.frombuffer(c.read_buffer(n * dtype.itemsize), dtype).astype("<u4")
                            rows.append((None if docs[i] == NULL_ID else int(docs[i]), int(first + at[i]), n,
                                         zlib.crc32(own.tobytes()), *([own.astype(np.int32)] * keep_ids)))
                        out = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * keep_ids)
                        yield out.astype({"doc_id": "Int64"})
    if not parts:
        return spark.createDataFrame([], schema)
    listed = spark.createDataFrame([(p["file"], p["first_id"]) for p in parts], "file string, first_id long")
    return listed.repartition(len(parts)).mapInPandas(get, schema)


def round_trip(docs: DataFrame, vocabulary: str = VOCABULARY, end: int = END) -> DataFrame:
    """Writes the documents to a new folder in the shared scratch space and reads them back."""
    folder = scratch_path(docs.sparkSession, "token-files")
    write(docs, folder, vocabulary, end)
    return read(docs.sparkSession, folder)
