"""Best-fit packing by exact complements.

A document's token ids end with id 1 and only longer ones are cut.  What is
packed are counts of lengths, a table of at most ``capacity`` rows whatever the
corpus: for the longest piece left, a gap is closed by a single, a pair or a
triple of lengths that fills it exactly, as often as the counts allow; where
none does, the best fit goes in and the smaller gap is tried again.  The plan
(patterns of lengths with repetitions) is then dealt to pieces by their rank
among the pieces of their length.

Where documents have an order, it decides what the plan leaves open: sequences
are numbered by the place of their first, longest piece, and the pieces that
fill their gaps are dealt to them in order.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import Stage, rank_in_group
from .words import WORD, Words, word_chunks

CAPACITY = 4096
END = 1
CACHED_UNITS = 1_000_000

_PLAIN = np.zeros(256, np.uint8)
_PLAIN[33:127] = 3
_PLAIN[[*range(1, 9), *range(14, 32), 127, 0]] = 3
_PLAIN[48:58] = 2
_PLAIN[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), 0xC3]] = 1
_ODD = np.zeros(256, bool)
_ODD[[0x27, *range(0xC0, 0xC3), *range(0xC4, 256)]] = True


def units(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Classes of bytes whose runs the tokenizer encodes one by one.

    In words of ASCII and Latin-1 letters these are runs of letters, digits or
    signs, which its splitter never joins.  Words with an apostrophe (it splits
    off contractions), other characters (which may be marks or signs) or the
    start of a special token are units as a whole.
    """
    kind = _PLAIN[data]
    odd = _ODD[data]
    if len(data) > 1:
        odd[1:] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
        odd[1:] |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)
    if odd.any():
        words = Words(0, 0, data, bounds, False, WORD)
        seen = np.concatenate([[0], np.cumsum(odd)])
        whole = np.flatnonzero(seen[words.end] > seen[words.start])
        step = np.zeros(len(data) + 1, np.int8)
        step[words.start[whole]] += 1
        step[words.end[whole]] -= 1
        kind[np.cumsum(step[:-1]) > 0] = 4
    return kind


class TokenCache:
    """Token ids of units, each encoded once by the tokenizer.

    The tokenizer ignores ASCII case, drops white space and never joins across
    units, so a text's ids are those of its units.  The cache is emptied at
    ``most`` units.
    """

    def __init__(self, path: str, most: int = CACHED_UNITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self._empty()

    def _empty(self) -> None:
        self.known: dict[int, int] = {}
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0
        self.at, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _learn(self, keys: list[int], texts: list[str], step: int = 2000) -> None:
        """Units are encoded many at once, with blanks between them, and told apart by their tokens' offsets."""
        for lo in range(0, len(texts), step):
            part = texts[lo : lo + step]
            e = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(e.ids, np.uint32)
            start = np.array([a for a, _ in e.offsets], np.int64)
            first = np.cumsum([0, *(len(t) + 1 for t in part)])
            cut = np.searchsorted(start, first)
            n = len(self.known)
            while n + len(part) > len(self.at):
                self.at, self.size = np.concatenate([self.at, self.at]), np.concatenate([self.size, self.size])
            while self.used + len(ids) > len(self.pool):
                self.pool = np.concatenate([self.pool, self.pool])
            self.pool[self.used : self.used + len(ids)] = ids
            self.at[n : n + len(part)] = self.used + cut[:-1]
            self.size[n : n + len(part)] = np.diff(cut)
            self.used += len(ids)
            self.known.update(zip(keys[lo : lo + step], range(n, n + len(part)), strict=True))

    def encode(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first text, ids, offsets by text) of a column in chunks; each text ends with END."""
        for words in word_chunks(column, lower=True, classes=units):
            keys, first, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
            if len(self.known) + len(keys) > self.most:
                self._empty()
            named = keys.tolist()
            index = np.fromiter((self.known.get(k, -1) for k in named), np.int64, len(named))
            new = np.flatnonzero(index < 0)
            if len(new):
                data, n = words.data.tobytes(), len(self.known)
                spans = zip(words.start[first[new]].tolist(), words.end[first[new]].tolist(), strict=True)
                self._learn([named[i] for i in new.tolist()], [data[a:b].decode("utf-8", "replace") for a, b in spans])
                index[new] = np.arange(n, n + len(new))
            index = index[inverse]
            size = self.size[index]
            ends = np.concatenate([[0], np.cumsum(size)])
            ids = self.pool[np.repeat(self.at[index] - ends[:-1], size) + np.arange(ends[-1])]
            bounds = ends[words.offsets]
            texts = np.arange(len(bounds) - 1)
            out = np.full(len(ids) + len(texts), END, np.uint32)
            out[np.arange(len(ids)) + np.repeat(texts, np.diff(bounds))] = ids
            yield words.lo, out, bounds + np.arange(len(bounds))


_caches: dict[str, TokenCache] = {}


def token_cache(path: str) -> TokenCache:
    """The process's cache of a tokenizer, kept from task to task."""
    if path not in _caches:
        _caches[path] = TokenCache(path)
    return _caches[path]


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cutter(path: str, capacity: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = token_cache(path)
        for batch in batches:
            key = batch.column(0).to_pylist()
            at = batch.column(2).to_pylist() if batch.num_columns > 2 else None
            rows: list[tuple] = []
            for lo, ids, offsets in cache.encode(batch.column(1)):
                ids = ids.astype("<u4")
                for d, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                    for piece, s in enumerate(range(a, b, capacity)):
                        e = min(b, s + capacity)
                        rows.append((key[lo + d], piece, s - a, e - s, zlib.crc32(ids[s:e].data), *([at[lo + d]] if at else [])))
            if rows:
                types, names = [pa.int64(), pa.int32(), *[pa.int64()] * 4], ["doc_id", "piece", "start", "length", "ids_crc32", "_at"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=False)], names[: len(rows[0])])

    return cut


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths, times) that use every piece once; no pattern exceeds capacity.

    The number of patterns is bounded by the number of lengths, not of pieces,
    as each one uses up a length.
    """
    have = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        have[length] += n
    out = []

    def pair(gap: int) -> tuple[int, ...] | None:
        low = np.arange(1, gap // 2 + 1)
        fits = (have[low] > 0) & (have[gap - low] > 0)
        if gap % 2 == 0 and len(low) and have[gap // 2] < 2:
            fits[-1] = False
        i = np.flatnonzero(fits)
        return (gap - int(low[i[0]]), int(low[i[0]])) if len(i) else None

    def triple(gap: int) -> tuple[int, ...] | None:
        live = np.flatnonzero(have[:gap] > 0)
        if len(live) == 0:
            return None
        open_ = (have[:gap] > 0).astype(np.float64)
        size = 1 << int(2 * gap).bit_length()
        sums = np.fft.irfft(np.fft.rfft(open_, size) ** 2, size)[: gap + 1] > 0.5
        for a in live[::-1]:
            if sums[gap - a]:
                have[a] -= 1
                found = pair(gap - int(a))
                have[a] += 1
                if found:
                    return (int(a), *found)
        return None

    def times(pattern: list[int]) -> int:
        return min(int(have[x]) // pattern.count(x) for x in set(pattern))

    top = capacity
    while True:
        while top and not have[top]:
            top -= 1
        if not top:
            return out
        pattern, gap = [top], capacity - top
        while gap:
            for x in pattern:
                have[x] -= 1
            fill = (gap,) if have[gap] > 0 else pair(gap) or triple(gap)
            if fill is None:
                best = np.flatnonzero(have[: gap + 1] > 0)
                fill = (int(best[-1]),) if len(best) else None
            for x in pattern:
                have[x] += 1
            if fill is None:
                break
            pattern += fill
            gap -= sum(fill)
        n = times(pattern)
        for x in pattern:
            have[x] -= n
        out.append((tuple(pattern), n))


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Rows (length, first rank, sequence of the first rank, offset), by length and rank."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, n in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + n
            offset += length
        sequence += n
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 4).T
    return dict(zip(("length", "rank", "sequence", "offset"), cols, strict=True))


def _placer(table):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = table.value
        key = t["length"] * (1 << 44) + t["rank"]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            i = np.searchsorted(key, length * (1 << 44) + rank, "right") - 1
            keep = [n for n in batch.schema.names if n != "_rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array(t["sequence"][i] + rank - t["rank"][i]), pa.array(t["offset"][i])], [*keep, "sequence_id", "offset"])

    return place


def _header(table):
    """Tells heads of sequences, evenly spread among the pieces of a length, from fills, and numbers the fills.

    The k-th head of a length has the pattern whose run holds k; a fill has pattern -1.
    """

    def head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, heads, key, pattern = table.value
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            before = rank * heads[length] // total[length]
            first = (rank + 1) * heads[length] // total[length] > before
            i = np.searchsorted(key, length * (1 << 44) + before, "right") - 1
            keep = [n for n in batch.schema.names if n != "_rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array(np.where(first, pattern[np.maximum(i, 0)], -1)), pa.array(rank - before)], [*keep, "_pattern", "_rank"])

    return head


def _deal_in_order(spark: SparkSession, stage: Stage, pieces: DataFrame, counts: dict[int, int], patterns: list[tuple[tuple[int, ...], int]], capacity: int) -> DataFrame:
    """Pieces (with ``_at``) in the plan's patterns, sequences and fills in the order of ``_at``."""
    total, heads = np.ones(capacity + 1, np.int64), np.zeros(capacity + 1, np.int64)
    runs, fills = [], []
    for length, n in counts.items():
        total[length] = n
    for i, (pattern, n) in enumerate(patterns):
        runs.append((pattern[0] * (1 << 44) + int(heads[pattern[0]]), i))
        heads[pattern[0]] += n
        ends = np.cumsum(pattern).tolist()
        fills += [(i, slot, length, offset) for slot, (length, offset) in enumerate(zip(pattern[1:], ends, strict=False))]
    runs.sort()
    key, number = np.array(runs, np.int64).reshape(-1, 2).T if runs else np.zeros((2, 1), np.int64)
    table = spark.sparkContext.broadcast((total, heads, key, number))
    order, near = F.struct("_at", "piece"), F.shiftright("_at", 14)
    ranked = rank_in_group(pieces, ["length"], order, "_rank", bucket=near)
    ranked = ranked.select(*pieces.columns, "_rank").mapInArrow(_header(table), f"{_PIECES}, _at long, _pattern long, _rank long")
    ranked = stage.write(ranked, "ranked")
    first = ranked.filter("_pattern >= 0").drop("_rank").withColumn("_all", F.lit(0))
    first = stage.write(rank_in_group(first, ["_all"], order, "sequence_id", bucket=near).drop("_all"), "heads")
    gaps = F.broadcast(spark.createDataFrame(fills, "_pattern long, _slot int, length long, offset long"))
    slots = first.select("_pattern", "sequence_id").join(gaps, "_pattern")
    slots = rank_in_group(slots, ["length"], F.struct("sequence_id", "_slot"), "_rank", bucket=F.shiftright("sequence_id", 14))
    rest = ranked.filter("_pattern < 0").drop("_pattern").join(slots.select("length", "_rank", "sequence_id", "offset"), ["length", "_rank"])
    own = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id"]
    return first.select(*own, F.lit(0).cast("long").alias("offset")).unionByName(rest.select(*own, "offset"))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", order_col: str | None = None) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the end id alone, so it still has one piece.  The
    pieces of a sequence stand without gaps from 0.  Rows that repeat an id are
    packed as documents of their own; null ids are kept; an empty table gives
    no rows; other columns are ignored.  With order_col, a distinct number
    (long, 0 or more) of each row, sequence ids follow that order by their
    pieces at offset 0; without it, they follow the plan.
    """
    stage = Stage(spark, "packing")
    at = [F.col(order_col).cast("long").alias("_at")] if order_col else []
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *at)
    pieces = stage.write(base.mapInArrow(_cutter(tokenizer or default_tokenizer(), capacity), _PIECES + (", _at long" if at else "")), "pieces")
    counts = {int(r[0]): int(r[1]) for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    patterns = plan(counts, capacity)
    if order_col:
        return _deal_in_order(spark, stage, pieces, counts, patterns, capacity)
    table = spark.sparkContext.broadcast(slots(patterns))
    ranked = rank_in_group(pieces, ["length"], F.struct("doc_id", "piece", "ids_crc32"), "_rank")
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "_rank")
    return ranked.mapInArrow(_placer(table), f"{_PIECES}, sequence_id long, offset long")
