"""Exact deduplication by a log-structured merge index of digests.

Each task keeps a memtable (digest to largest id, its row, count).  A full
memtable is flushed as a sorted run with a Bloom filter; when runs pile up they
are compacted into one, keeping one identifier of each digest.  A task first
indexes its own rows, so that copies are combined before the shuffle; digests
are then dealt by their hash and each shard's index is merged the same way.
The filters tell which digests of a new run can occur in older ones, and only
these are looked up.  Rows that hit a kept row are verified byte by byte: texts
whose digest can't have a copy stay out of that shuffle.

Runs live in the memory of the task that makes them, which bounds them and
hands them on; a lost task makes them again from its input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import Stage, attach_by_key, key_filter

MEMTABLE = 50_000
FANOUT = 8


class Filter:
    """A Bloom filter over digests of 32 bytes, given as rows of four 64-bit words."""

    def __init__(self, digests: np.ndarray):
        self.bits = max(64, 1 << int(np.ceil(np.log2(max(1, len(digests)) * 10))))
        self.words = np.zeros(self.bits // 64, np.uint64)
        for place in self._places(digests):
            np.bitwise_or.at(self.words, place >> np.uint64(6), np.uint64(1) << (place & np.uint64(63)))

    def _places(self, digests: np.ndarray) -> list[np.ndarray]:
        return [digests[:, i] % np.uint64(self.bits) for i in range(4)]

    def may_hold(self, digests: np.ndarray) -> np.ndarray:
        out = np.ones(len(digests), bool)
        for place in self._places(digests):
            out &= (self.words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) != 0
        return out


def _combine(digest: np.ndarray, keep: np.ndarray, row: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """One sorted entry of each digest: the largest (id, row), and the sum of counts."""
    order = np.lexsort((row, keep, digest[:, 3], digest[:, 2], digest[:, 1], digest[:, 0]))
    digest, keep, row, count = digest[order], keep[order], row[order], count[order]
    new = np.ones(len(digest), bool)
    new[1:] = (digest[1:] != digest[:-1]).any(axis=1)
    at = np.flatnonzero(new)
    if not len(at):
        return digest, keep, row, count
    last = np.append(at[1:], len(digest)) - 1
    return digest[at], keep[last], row[last], np.add.reduceat(count, at)


class Index:
    """Memtable, sorted runs with filters, and compaction."""

    def __init__(self, memtable: int = MEMTABLE, fanout: int = FANOUT):
        self.memtable, self.fanout = memtable, fanout
        self.fresh: list[tuple] = []
        self.runs: list[tuple] = []
        self.held = 0

    def add(self, digest: np.ndarray, keep: np.ndarray, row: np.ndarray, count: np.ndarray) -> None:
        self.fresh.append((digest, keep, row, count))
        self.held += len(digest)
        if self.held >= self.memtable:
            self.flush()

    def flush(self) -> None:
        if not self.held:
            return
        digest, keep, row, count = _combine(*(np.concatenate(x) for x in zip(*self.fresh, strict=True)))
        self.fresh, self.held = [], 0
        for old, ids, rows, n, bloom in self.runs:
            probe = np.flatnonzero(bloom.may_hold(digest))
            if not len(probe):
                continue
            found = _positions(old, digest[probe])
            hit, place = probe[found >= 0], found[found >= 0]
            more = (keep[hit] > ids[place]) | ((keep[hit] == ids[place]) & (row[hit] > rows[place]))
            ids[place[more]], rows[place[more]] = keep[hit[more]], row[hit[more]]
            n[place] += count[hit]
            rest = np.ones(len(digest), bool)
            rest[hit] = False
            digest, keep, row, count = digest[rest], keep[rest], row[rest], count[rest]
        if len(digest):
            self.runs.append((digest, keep, row, count, Filter(digest)))
        if len(self.runs) > self.fanout:
            whole = self.compacted()
            self.runs = [(*whole, Filter(whole[0]))]

    def compacted(self) -> tuple[np.ndarray, ...]:
        """All runs as one sorted run."""
        if not self.runs:
            return np.zeros((0, 4), np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
        return _combine(*(np.concatenate([r[i] for r in self.runs]) for i in range(4)))


def _positions(run: np.ndarray, probe: np.ndarray) -> np.ndarray:
    """Where each probe stands in a sorted run, -1 if it doesn't."""
    lo = np.searchsorted(run[:, 0], probe[:, 0], "left")
    out = np.full(len(probe), -1)
    live = np.arange(len(probe))
    while len(live):
        live = live[lo[live] < len(run)]
        live = live[run[lo[live], 0] == probe[live, 0]]
        same = (run[lo[live]] == probe[live]).all(axis=1)
        out[live[same]] = lo[live[same]]
        live = live[~same]
        lo[live] += 1
    return out


def _digests(column: pa.Array) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, ">u8").astype(np.uint64).reshape(-1, 4)


_ENTRY = "digest binary, keep_id long, keep_row long, group_size long"


def _rows(index: Index, step: int = 20_000) -> Iterator[pa.RecordBatch]:
    index.flush()
    digest, *columns = index.compacted()
    for a in range(0, len(digest), step):
        raw = digest[a : a + step].astype(">u8").tobytes()
        binary = [raw[i : i + 32] for i in range(0, len(raw), 32)]
        yield pa.RecordBatch.from_arrays([pa.array(binary, pa.binary()), *(pa.array(c[a : a + step]) for c in columns)], ["digest", "keep_id", "keep_row", "group_size"])


def _flusher(memtable: int):
    def flush(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task's rows; its index is handed on whenever it reaches 4 memtables, so memory is bounded."""
        index, added = Index(memtable), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            index.add(_digests(batch.column(0)), batch.column(1).to_numpy().copy(), batch.column(2).to_numpy().copy(), np.ones(batch.num_rows, np.int64))
            added += batch.num_rows
            if added >= 4 * memtable:
                yield from _rows(index)
                index, added = Index(memtable), 0
        yield from _rows(index)

    return flush


def _compactor(memtable: int):
    def compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(memtable)
        for batch in batches:
            if batch.num_rows:
                index.add(_digests(batch.column(0)), *(batch.column(i).to_numpy().copy() for i in (1, 2, 3)))
        yield from _rows(index)

    return compact


def exact_groups(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None, memtable: int = MEMTABLE, shard_rows: int = 1_000_000) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, one row a document.

    Texts are equal when identical; a null text counts as empty.  Of equal
    texts one row stays: that with the largest id, where several have it one
    of them (the last by row_col, a unique long of each row, which is then
    returned too).  Null ids lose to any other: where all are null, one such
    row stays and keep_id is null.  Other columns are ignored; an empty table
    gives no rows.
    """
    stage = Stage(spark, "exact")
    text = F.coalesce(F.col(text_col), F.lit(""))
    number = F.col(row_col).cast("long") if row_col else F.monotonically_increasing_id()  # fixed once it is staged
    hashed = F.unhex(F.sha2(text.cast("binary"), 256))
    signed = stage.write(docs.select(F.col(id_col).cast("long").alias("doc_id"), number.alias("row"), hashed.alias("digest")), "signed")
    total = signed.count()
    shards = max(min(12, max(1, total // 1000)), -(-total // shard_rows))
    lowest = F.coalesce("doc_id", F.lit(-(2**63)))
    runs = signed.select("digest", lowest.alias("keep_id"), "row").mapInArrow(_flusher(memtable), _ENTRY)
    merged = runs.repartition(shards, "digest").mapInArrow(_compactor(memtable), _ENTRY)
    index = stage.write(merged, "index")

    copies = index.filter("group_size > 1")
    may_be_copy = key_filter(copies.select(F.xxhash64("digest").alias("h")), "h")
    texts = docs.select(text.alias("text"), hashed.alias("digest")).filter(may_be_copy.column(F.xxhash64("digest")))
    if _verify(texts).limit(1).count():
        raise RuntimeError("texts of one SHA-256 digest differ")

    out = attach_by_key(signed, index, ["digest"], total, "group_size")
    keep = F.when(F.col("keep_id") != -(2**63), F.col("keep_id"))
    own = ["doc_id", keep.alias("keep_id"), "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")]
    return out.select(*own, *([F.col("row").alias(row_col)] if row_col else []))


def _verify(texts: DataFrame) -> DataFrame:
    """Digests of which two texts differ byte by byte, found by the smallest and largest text of each.

    Both are combined before the shuffle, so each task sends a group's text
    once, however many copies it read.
    """
    ends = [F.min(F.col("text").cast("binary")).alias("lo"), F.max(F.col("text").cast("binary")).alias("hi")]
    return texts.groupBy("digest").agg(*ends).filter("lo <> hi").select("digest")
