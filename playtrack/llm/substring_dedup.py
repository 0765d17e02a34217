"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes of a text: ``h = 2 h + G[byte]`` modulo 2^16,
so ``h`` depends on the last 16 bytes alone.  A byte where the low bits of
``h`` after a shift are zero is a hit; a hit whose last hit is at least
``LEAST`` bytes back ends a chunk, and where ``MOST`` bytes in a row have no
such end, the byte with the least ``h`` of them is one (winnowing).  Cuts
therefore follow the content: an insertion moves only the cuts next to it, and
two equal stretches of ``RUN`` = ``WINDOW + LEAST + 2 MOST`` bytes share a whole
chunk.  Only where the least ``h`` is not unique (text that repeats itself
within ``MOST`` bytes) are chunks cut after ``MOST`` bytes.

Texts are packed once, in the order ``(doc_id, digest of the text)``, into
blocks of neighbours: place ``(block, row, byte)`` orders all bytes.  A chunk
is a copy if its 64-bit hash occurred at an earlier place, and is compared
with the last one before it.  Copies that go on at that place make one run; a
second hash of the run's bytes at either place confirms it, and it grows on
both sides as far as the texts agree, by up to ``RUN`` bytes (beyond, the next
shared chunk takes over).  Touching runs merge, and those of at least ``RUN``
bytes are removed from the text (shorter repeats, such as common short lines,
stay).  Every removed byte equals one at an earlier place, so the first of
equal stretches stays.

Scale: texts are shuffled once, compressed, into a table bucketed by block;
the steps after it read that table beside their own small messages and never
shuffle it again.  A block tells every hash bucket its distinct hashes with
the last place of each, packed into a column; the bucket answers with the
places before.  Per block, runs ask the blocks of their earlier places, with
one-byte hashes of what stands beside the run, and get no more bytes back than
can agree.  A place is the last before one other place at most, so a chunk
that sits in a third of all documents sends one hash per block to its bucket,
and no block is asked for more runs than it has chunks.  A task holds one
block (``BLOCK_BYTES`` of text, or one longer text) or one bucket.

Defined cases: null text is empty and has no chunk; rows that repeat an id and
text are one document and share its result; ties are settled by the text
digest; a text inside which a chunk repeats keeps its first copy; a
character of which only a part repeats stays whole; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrack.session import scratch_path

from .common import row_key, saved, size_hint_partitions, text_or_empty

WINDOW = 16             # bytes the hash depends on
BITS = 4                # a hit in 2^BITS bytes
LEAST = 8
MOST = 48
RUN = WINDOW + LEAST + 2 * MOST     # 120: equal stretches of it share a chunk
GEAR = np.random.default_rng(20240229).integers(0, 1 << 16, 256, dtype=np.uint32)
BLOCK_BYTES = 8 << 20   # text of a block
BUCKET_BYTES = 20 << 20  # text whose chunks (about a million) fill a hash bucket
MOST_BUCKETS = 65_536   # buckets of the stored table
BESIDE = (4, 16, 48)    # bytes beside a run that are compared by a one-byte hash first
_SLICE = 1 << 22


def _rolled(data: np.ndarray, at: int) -> np.ndarray:
    """The gear hash after each byte of a slice of ``data``."""
    low = max(at - WINDOW + 1, 0)
    h = GEAR[data[low:at + _SLICE]]
    reach = 1
    while reach < WINDOW:                        # h now covers ``reach`` bytes; twice that after the step
        grown = h.copy()
        grown[reach:] += h[:-reach] << np.uint32(reach)
        h, reach = grown, 2 * reach
    # the highest of the 16 bits have seen the whole window
    return (h & np.uint32((1 << WINDOW) - 1))[at - low:]


def _hits(data: np.ndarray) -> np.ndarray:
    """Places after which the gear hash asks for a cut."""
    found = [np.flatnonzero(_rolled(data, at) >> np.uint32(WINDOW - BITS) == 0) + at + 1 for at in range(0, len(data), _SLICE)]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _least(keys: np.ndarray) -> np.ndarray:
    """The least of every ``MOST`` keys in a row."""
    reach = 1
    while 2 * reach <= MOST:
        keys, reach = np.minimum(keys[:-reach], keys[reach:]), 2 * reach
    return np.minimum(keys[:len(keys) - (MOST - reach)], keys[MOST - reach:])


def _between(data: np.ndarray, far: np.ndarray) -> np.ndarray:
    """In every ``MOST`` places without a cut, the one place of the least hash."""
    n, found = len(data), []
    for at in range(0, n - MOST + 1, _SLICE):
        h = _rolled(data, at)
        if at + _SLICE < n:
            h = np.concatenate([h, _rolled(data, at + _SLICE)[:MOST - 1]])
        place = np.arange(len(h), dtype=np.uint64)
        back = np.uint64(len(h))
        key = h.astype(np.uint64) << np.uint64(32)
        first, last = _least(key | place), back - (_least(key | (back - place)) & np.uint64(0xFFFFFFFF))
        first &= np.uint64(0xFFFFFFFF)
        cut = np.zeros(len(h) + 1, np.int64)
        cut[far[(far > at) & (far <= at + len(h))] - at] = 1
        cut = np.cumsum(cut)
        free = (cut[MOST:] == cut[:-MOST]) & (first == last)
        found.append(np.unique(first[free]).astype(np.int64) + at + 1)
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``; the last is its length."""
    n = len(data)
    if not n:
        return []
    array = np.frombuffer(data, np.uint8)
    hits = _hits(array)
    far = hits[np.diff(hits, prepend=-LEAST) >= LEAST]
    if np.diff(far, prepend=0, append=n).max() > MOST:
        far = np.union1d(far, _between(array, far))
    ends, last = [], 0
    for end in [*far[far < n].tolist(), n]:
        while end - last > MOST:
            last += MOST
            ends.append(last)
        ends.append(end)
        last = end
    return ends


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of one length of whole numbers, as compressed byte planes as wide as each column needs."""
    out = [np.array([len(columns[0])], "<u4").tobytes()]
    for c in columns:
        width = max(1, -(-int(c.max(initial=0)).bit_length() // 8))
        out += [bytes([width]), c.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()]
    return _squeeze(b"".join(out))


def _unpacked(data: bytes) -> list[np.ndarray]:
    data = _unsqueeze(data)
    n, at, out = int.from_bytes(data[:4], "little"), 4, []
    while at < len(data):
        width = data[at]
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :width] = np.frombuffer(data, np.uint8, n * width, at + 1).reshape(width, n).T
        out.append(wide.view("<u8")[:, 0])
        at += 1 + n * width
    return out


def _squeeze(data: bytes) -> bytes:
    return len(data).to_bytes(4, "little") + pa.Codec("zstd", compression_level=1).compress(data, asbytes=True)


def _unsqueeze(data: bytes) -> bytes:
    size = int.from_bytes(data[:4], "little")
    return pa.Codec("zstd").decompress(data[4:], size, asbytes=True) if size else b""


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data = pa.array([_squeeze(x) for x in batch["data"].to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["digest"], batch["n"], data], names=["doc_id", "digest", "n", "data"])


def text_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int, bool]:
    """``(block, row, doc_id, n, data)`` with compressed texts, stored and bucketed by block; their bytes; whether rows repeat.

    Blocks follow each other in the order ``(doc_id, digest)``, as rows do in a
    block; ``n`` rows of the table are this document.
    """
    rows = docs.select(row_key().alias("k"), text_or_empty().cast("binary").alias("data")).select("k.doc_id", "k.digest", "data")
    known = saved(rows.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n"), F.max(F.length("data")).cast("long").alias("bytes")),
                  "substring-documents")
    total = known.agg(F.sum("bytes").alias("bytes"), F.max("n").alias("n")).first()
    size, repeats = total["bytes"] or 0, (total["n"] or 0) > 1
    thin = rows.withColumn("n", F.lit(1).cast("long")).select("doc_id", "digest", "n", "data").mapInArrow(
        _squeezed, "doc_id long, digest long, n long, data binary")
    if repeats:                                  # map-side aggregation: a row repeated very often is one row per task
        thin = thin.groupBy("doc_id", "digest").agg(F.sum("n").alias("n"), F.first("data").alias("data"))
    blocks = size_hint_partitions(size, block_bytes, least=1)
    number = F.monotonically_increasing_id()
    placed = (thin.repartitionByRange(blocks, "doc_id", "digest").sortWithinPartitions("doc_id", "digest").withColumn("_at", number)
              .select(F.shiftright("_at", 33).alias("block"), F.col("_at").bitwiseAND((1 << 33) - 1).alias("row"), "doc_id", "n", "data"))
    path = scratch_path(docs.sparkSession, "substring-blocks")
    name = "playtrack_" + path.rsplit("/", 1)[-1].replace("-", "_")
    (placed.write.option("path", path).option("compression", "uncompressed").bucketBy(min(blocks, MOST_BUCKETS), "block")
     .sortBy("block", "row").saveAsTable(name))
    return docs.sparkSession.table(name), size, repeats


class _Block:
    """The chunks of a block in their order, and its distinct hashes in theirs."""

    def __init__(self, table: pa.Table):
        from xxhash import xxh3_64_intdigest

        self.block = table["block"][0].as_py()
        self.texts = [_unsqueeze(x) for x in table.sort_by("row")["data"].to_pylist()]
        ends = [cuts(t) for t in self.texts]
        starts = [0 if not i else e[i - 1] for e in ends for i in range(len(e))]
        stops = [x for e in ends for x in e]
        self.row = np.repeat(np.arange(len(ends)), [len(e) for e in ends])
        names = np.array([xxh3_64_intdigest(self.texts[r][a:b]) for r, a, b in zip(self.row.tolist(), starts, stops, strict=True)], np.uint64)
        self.at = np.array(starts, np.int64)
        self.size = np.array(stops, np.int64) - self.at
        self.order = np.argsort(names, kind="stable")
        names = names[self.order]
        self.new = np.ones(len(names), bool)
        self.new[1:] = names[1:] != names[:-1]
        self.names = names[self.new]
        self.first = np.flatnonzero(self.new)
        self.last = np.append(self.first[1:], len(names))[:len(self.first)] - 1

    def bucket(self, buckets: int) -> np.ndarray:
        return (((self.names >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _parts(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Spans of equal sorted keys."""
    if len(keys):
        edge = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])).tolist()
        yield from zip(edge, [*edge[1:], len(keys)], strict=True)


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [c.split() for c in schema.split(", ")]
    return pa.table([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)], names=[c for c, _ in fields])


CELLS = "bucket int, block long, low long, cell binary"


def cells(blocks: DataFrame, buckets: int) -> DataFrame:
    """``CELLS``: the distinct hashes of a block in a bucket, from ``low`` on, with the last row and byte of each."""
    def tell(table: pa.Table) -> pa.Table:
        b = _Block(table)
        place, bucket, out = b.order[b.last], b.bucket(buckets), []
        for lo, hi in _parts(bucket):
            steps = np.diff(b.names[lo:hi], prepend=b.names[lo])
            out.append((int(bucket[lo]), b.block, int(b.names[lo:lo + 1].view(np.int64)[0]),
                        _packed(steps, b.row[place[lo:hi]], b.at[place[lo:hi]])))
        return _table(out, CELLS)
    return blocks.groupBy("block").applyInArrow(tell, CELLS)


ANSWERS = "block long, bucket int, answer binary"


def answers(told: DataFrame) -> DataFrame:
    """``ANSWERS``: for hashes of a cell, by number, that occurred in an earlier block, the last place there."""
    def find(table: pa.Table) -> pa.Table:
        names, owner, number, row, at = [], [], [], [], []
        for block, low, cell in zip(*(table[c].to_pylist() for c in ("block", "low", "cell")), strict=True):
            steps, rows, ats = _unpacked(cell)
            names.append(np.cumsum(steps, dtype=np.uint64) + np.uint64(low % (1 << 64)))
            owner.append(np.full(len(rows), block))
            number.append(np.arange(len(rows)))
            row.append(rows)
            at.append(ats)
        names, owner, number, row, at = (np.concatenate(x) for x in (names, owner, number, row, at))
        order = np.lexsort((owner, names))
        again = names[order][1:] == names[order][:-1]
        here, before = order[1:][again], order[:-1][again]
        by = np.lexsort((number[here], owner[here]))
        here, before = here[by], before[by]
        bucket = table["bucket"][0].as_py()
        return _table([(int(owner[here[lo]]), bucket,
                        _packed(np.diff(number[here[lo:hi]], prepend=0), owner[before[lo:hi]], row[before[lo:hi]], at[before[lo:hi]]))
                       for lo, hi in _parts(owner[here])], ANSWERS)
    return told.groupBy("bucket").applyInArrow(find, ANSWERS)


def _beside(data: bytes, a: int, b: int) -> int:
    """One-byte hashes of ``BESIDE`` bytes before ``a`` and after ``b``."""
    marks = [crc32(data[max(a - n, 0):a]) & 255 for n in BESIDE] + [crc32(data[b:b + n]) & 255 for n in BESIDE]
    return int.from_bytes(bytes(marks), "little")


def _reach(mine: int, other: int) -> int:
    """No fewer bytes than those that can agree on the side of these marks."""
    for i, n in enumerate(BESIDE):
        if (mine ^ other) >> 8 * i & 255:
            return n
    return RUN


REQUESTS = "block long, source long, runs binary"


def requests(blocks: DataFrame, found: DataFrame, buckets: int) -> DataFrame:
    """``REQUESTS``: runs of copies of block ``source`` whose earlier place is in ``block``."""
    def ask(table: pa.Table, replies: pa.Table) -> pa.Table:
        b = _Block(table)
        place = np.full((3, len(b.at)), -1, np.int64)           # block, row and byte of the place before
        inner = np.flatnonzero(~b.new)
        here, before = b.order[inner], b.order[inner - 1]
        place[:, here] = np.stack([np.full(len(here), b.block), b.row[before], b.at[before]])
        bucket = b.bucket(buckets)
        for name, answer in zip(replies["bucket"].to_pylist(), replies["answer"].to_pylist(), strict=True):
            number, *other = _unpacked(answer)
            number = np.cumsum(number.astype(np.int64)) + np.searchsorted(bucket, name)
            place[:, b.order[b.first[number]]] = np.stack(other)
        copy = np.flatnonzero(place[0] >= 0)
        (block, row, at), mine, size, own = place[:, copy], b.at[copy], b.size[copy], b.row[copy]
        new = np.ones(len(copy), bool)
        new[1:] = copy[1:] != copy[:-1] + 1
        for x in (own, block, row, mine - at):
            new[1:] |= x[1:] != x[:-1]
        begin = np.flatnonzero(new)
        n = np.diff(np.append(begin, len(copy)))
        size = np.add.reduceat(size, begin) if len(begin) else size
        block, row, at, own, mine = (x[begin] for x in (block, row, at, own, mine))
        order = np.lexsort((mine, own, at, row, block))
        block, row, at, own, mine, size, n = (x[order] for x in (block, row, at, own, mine, size, n))
        marks = np.array([_beside(b.texts[r], a, a + k) for r, a, k in zip(own.tolist(), mine.tolist(), size.tolist(), strict=True)], np.uint64)
        return _table([(int(block[lo]), b.block, _packed(*(x[lo:hi] for x in (row, at, size, own, mine, n, marks))))
                       for lo, hi in _parts(block)], REQUESTS)
    return blocks.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(ask, REQUESTS)


REPLIES = "block long, runs binary, beside binary"


def replies(blocks: DataFrame, asked: DataFrame) -> DataFrame:
    """``REPLIES``: the runs of ``block`` with a hash of their bytes at the earlier place and the bytes beside it there."""
    def reply(table: pa.Table, asks: pa.Table) -> pa.Table:
        from xxhash import xxh64_intdigest

        stored, texts, out = table.sort_by("row")["data"], {}, []
        half = 8 * len(BESIDE)
        for source, runs in zip(asks["source"].to_pylist(), asks["runs"].to_pylist(), strict=True):
            row, at, size, own, mine, n, marks = _unpacked(runs)
            inside, beside = [], []
            for r, a, k, other in zip(row.tolist(), at.tolist(), size.tolist(), marks.tolist(), strict=True):
                if r not in texts:
                    texts[r] = _unsqueeze(stored[r].as_py())
                data = texts[r]
                near = _beside(data, a, a + k)
                left = _reach(near & ((1 << half) - 1), other & ((1 << half) - 1))
                inside.append(xxh64_intdigest(data[a:a + k], 42))
                beside += [data[max(a - left, 0):a], data[a + k:a + k + _reach(near >> half, other >> half)]]
            lengths = np.array([len(x) for x in beside], np.int64)
            out.append((source, _packed(own, mine, size, n, lengths[::2], lengths[1::2], np.array(inside, np.uint64)),
                        _squeeze(b"".join(beside))))
        return _table(out, REPLIES)
    return blocks.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(reply, REPLIES)


def _agreed(a: bytes, b: bytes, order: str) -> int:
    """Bytes that agree at the start (order "little") or at the end ("big")."""
    n = min(len(a), len(b))
    a, b = (a[:n], b[:n]) if order == "little" else (a[len(a) - n:], b[len(b) - n:])
    x = int.from_bytes(a, order) ^ int.from_bytes(b, order)
    return ((x & -x).bit_length() - 1) // 8 if x else n


def grown(data: bytes, copies) -> tuple[list[tuple[int, int]], int]:
    """Confirmed runs as ``(start, size)`` of all bytes that agree with the earlier place, and the chunks in them."""
    from xxhash import xxh64_intdigest

    out, chunks_in = [], 0
    for a, size, n, left, right, inside in copies:
        b = a + size
        if xxh64_intdigest(data[a:b], 42) != inside:
            continue
        chunks_in += n
        a -= _agreed(data[max(a - RUN, 0):a], left, "big")
        b += _agreed(data[b:b + RUN], right, "little")
        out.append((a, b - a))
    return out, chunks_in


def merged(copies, least: int = RUN) -> list[tuple[int, int]]:
    """Runs of neighbouring copies as ``(start, end)`` bytes, those of ``least`` bytes or more."""
    runs: list[list[int]] = []
    for at, size in sorted(copies):
        if runs and runs[-1][1] >= at:
            runs[-1][1] = max(runs[-1][1], at + size)
        else:
            runs.append([at, at + size])
    return [(a, b) for a, b in runs if b - a >= least]


def whole_characters(data: bytes, a: int, b: int) -> tuple[int, int]:
    """The span without the characters at its ends that are only partly inside."""
    while a < b and data[a] & 0xC0 == 0x80:
        a += 1
    while a < b < len(data) and data[b] & 0xC0 == 0x80:
        b -= 1
    return a, b


_CLEANED = ("doc_id long, n_bytes long, n_repeated long, n_removed long, spans array<struct<start:int,end:int>>, text string, "
            "n long")


def _copies(told: pa.Table) -> dict[int, list[tuple]]:
    """Runs of a block by row, as ``grown`` takes them."""
    out = defaultdict(list)
    for runs, beside in zip(told["runs"].to_pylist(), told["beside"].to_pylist(), strict=True):
        beside, low = _unsqueeze(beside), 0
        for own, mine, size, n, left, right, inside in zip(*(x.tolist() for x in _unpacked(runs)), strict=True):
            out[own].append((mine, size, n, beside[low:low + left], beside[low + left:low + left + right], inside))
            low += left + right
    return out


def _without(table: pa.Table, told: pa.Table) -> pa.Table:
    table, copies, out = table.sort_by("row"), _copies(told), []
    for row, squeezed in enumerate(table["data"].to_pylist()):
        data = _unsqueeze(squeezed)
        found, repeated = grown(data, copies.get(row, ()))
        spans = [whole_characters(data, a, b) for a, b in merged(found)]
        left, last = [], 0
        for a, b in spans:
            left.append(data[last:a])
            last = b
        kept = b"".join([*left, data[last:]]).decode("utf-8", "ignore")
        out.append((len(data), repeated, sum(b - a for a, b in spans), [{"start": a, "end": b} for a, b in spans], kept))
    n_bytes, n_repeated, n_removed, spans, text = zip(*out, strict=True)
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    return pa.table([table["doc_id"], pa.array(n_bytes, pa.int64()), pa.array(n_repeated, pa.int64()), pa.array(n_removed, pa.int64()),
                     pa.array(spans, pa.list_(span)), pa.array(text, pa.string()), table["n"]],
                    names=["doc_id", "n_bytes", "n_repeated", "n_removed", "spans", "text", "n"])


def dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``(doc_id, n_bytes, n_repeated, n_removed, spans, text)`` of every row.

    ``n_repeated``: chunks that occurred before; ``spans``: the bytes removed.
    """
    blocks, size, repeats = text_blocks(docs, block_bytes)
    buckets = size_hint_partitions(size, bucket_bytes, least=1)
    found = answers(cells(blocks, buckets).repartition(buckets, "bucket"))
    told = replies(blocks, requests(blocks, found, buckets))
    out = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_without, _CLEANED)
    if repeats:
        out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    return out.select("doc_id", "n_bytes", "n_repeated", "n_removed", "spans", "text")
