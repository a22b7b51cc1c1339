"""N-gram Jaccard self-join by parity sketches.

Each document's set of word shingles is dealt by hash over k parts, and every
part keeps the XOR of the 64-bit hashes of its shingles: a parity sketch.  A
shingle that only one of two sets holds flips bits of one part, so the number
of parts that differ is a lower bound of the symmetric difference.  Sets that
reach the threshold differ in at most d shingles, where d follows from their
sizes; with k = d + 1 parts they agree on at least one (pigeonhole).  Sizes are
cut into bands, and equal parts within a band, or a band and its upper
neighbour, make a bucket.

Equal sets share one node, so copies never meet as pairs.  Each bucket elects
the member that most buckets hold as its hub.  Members are gathered under
their hubs, a node once for each of its hubs, and compared there in blocks,
twice.  First by sketches of a byte a part: where more parts differ than
linked sets can have shingles apart, the pair is no link, and members without
another pair leave the block.  Then by exact intersection sizes, for which the
remaining members' texts are sent.  Two linked nodes share a bucket and hence
its hub, so no link is lost, and no pair is ever a row: blocks return the
links' counts and a spanning forest.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import connected_components
from .staging import KeyFilter, Stage, attach_by_key, key_filter, rank_in_group
from .words import mix, shingles, word_chunks

WIDTH = 4
PERCENT = 85
BLOCK = 256
REFINE_ABOVE = 128
REFINE_BELOW = 0.05
LEVELS = 4


def _bands(sizes: np.ndarray, percent: int) -> tuple[np.ndarray, ...]:
    """Sizes of 1 at least, the bands' edges, each set's band, and of each band the largest partner of its sets and the most shingles that link apart."""
    w = (100 / percent) ** 1.5
    n = np.maximum(sizes, 1)
    edges = [1]
    while edges[-1] <= int(n.max(initial=1)):
        edges.append(max(edges[-1] + 1, int(np.ceil(edges[-1] * w))))
    edges = np.array(edges, np.int64)
    largest = edges[1:] - 1  # of a band
    partner = largest * 100 // percent
    return n, edges, np.searchsorted(edges, n, "right") - 1, partner, (100 - percent) * (largest + partner) // (100 + percent)


def band_plan(sizes: np.ndarray, percent: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each document, the (band, parts, slack, present) of its own band and of the band below.

    Band i has sizes from ceil(w**i) up.  Pairs are keyed by the smaller set's
    band; a set also joins the band below if a set of that band can be its
    smaller partner.  parts is d + 1 + slack for the largest sizes that the band
    links, so that more than ``slack`` parts of linked sets are equal.  slack is
    what a set of the band's smallest size leaves empty, with a margin.
    """
    n, edges, own, partner, differ = _bands(sizes, percent)
    slack = np.zeros(len(differ), np.int64)
    for _ in range(8):
        parts = differ + 1 + slack
        empty = np.where(differ > 0, parts * np.exp(-edges[:-1] / parts), 0)
        slack = (empty + 0.8 * np.sqrt(empty)).astype(np.int64)
    parts = differ + 1 + slack
    below = np.maximum(own - 1, 0)
    return [(own, parts[own], slack[own], sizes > 0), (below, parts[below], slack[below], (sizes > 0) & (own > 0) & (n <= partner[below]))]


def parity_keys(tokens: np.ndarray, offsets: np.ndarray, percent: int, salt: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(document, key) of every part of every set; tokens ascending in each set.

    Empty parts send no key.  Sets with more than ``slack`` of them also send the
    keys of another dealing of all tokens: linked sets of which each equal part
    is empty have as many both, and meet there.
    salt prefixes the keys, and selects another dealing.
    """
    sizes = np.diff(offsets)
    docs_out, keys_out = [], []
    for band, parts, slack, present in(band_plan(sizes, percent)):
        live = np.flatnonzero(present)
        own = tokens
        for level in range(LEVELS):
            if not len(live):
                break
            take = sizes[live]
            begin = np.concatenate([[0], np.cumsum(take)])
            if level or salt is not None or len(live) < len(sizes):
                own = np.concatenate([tokens[offsets[d] : offsets[d + 1]] for d in live])
                if level or salt is not None:
                    own = mix(own ^ np.uint64(0x5851F42D4C957F2D * (level + 1 + 8 * (salt is not None)) % 2**64))
                    own = np.concatenate([np.sort(own[a:b]) for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)])
            row = np.repeat(np.arange(len(live)), take)
            part = ((own >> np.uint64(32)) * parts[live].astype(np.uint64)[row]) >> np.uint64(32)
            new = np.ones(len(own), bool)
            new[1:] = (row[1:] != row[:-1]) | (part[1:] != part[:-1])
            at = np.flatnonzero(new)
            sketch = np.bitwise_xor.reduceat(mix(own + np.uint64(0x2545F4914F6CDD1D)), at)
            where = row[at]
            tag = band[live].astype(np.uint64)[where] * np.uint64(1 << 40) + part[at] * np.uint64(8) + np.uint64(level)
            key = mix(sketch ^ mix(tag))
            if salt is not None:
                key = mix(key + salt[live][where])
            docs_out.append(live[where])
            keys_out.append(key)
            empty = np.bincount(where, minlength=len(live)) < (parts - slack)[live]
            if level == LEVELS - 1 and empty.any():
                rest = live[empty]
                docs_out.append(rest)
                key = mix(mix(band[rest].astype(np.uint64) + np.uint64(1 << 60)))
                keys_out.append(key if salt is None else mix(key + salt[rest]))
            live = live[empty]
    if not docs_out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(docs_out), np.concatenate(keys_out)


def part_bytes(tokens: np.ndarray, offsets: np.ndarray, percent: int) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Each set's band, and a byte a part of it for its own band and for the band below (empty where no set of that band links with it).

    A band's sets are all dealt over as many parts, somewhat more than linked
    sets can differ in, so that sets without relation differ in too many.
    """
    sizes = np.diff(offsets)
    n, _, own, partner, differ = _bands(sizes, percent)
    below = np.maximum(own - 1, 0)
    parts = differ + differ // 4 + 8
    mixed, out = mix(tokens + np.uint64(0x2545F4914F6CDD1D)), []
    for band, present in ((own, sizes > 0), (below, (sizes > 0) & (own > 0) & (n <= partner[below]))):
        many = np.where(present, parts[band], 0)
        begin = np.concatenate([[0], np.cumsum(many)])
        row = np.repeat(np.arange(len(sizes)), sizes)
        at = begin[row] + (((tokens >> np.uint64(32)) * many.astype(np.uint64)[row]) >> np.uint64(32)).astype(np.int64)
        at, values = at[present[row]], mixed[present[row]]
        data = np.zeros(begin[-1], np.uint8)
        if len(at):
            first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            data[at[first]] = (mix(np.bitwise_xor.reduceat(values, first)) >> np.uint64(56)).astype(np.uint8)
        out.append(pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(begin.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary()))
    return own, *out


def _set_hashes(tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set; 0 for empty sets only."""
    out = np.zeros(len(offsets) - 1, np.uint64)
    sizes = np.diff(offsets)
    full = np.flatnonzero(sizes)
    if len(full):
        out[full] = mix(np.add.reduceat(mix(tokens), offsets[:-1][full]) + sizes[full].astype(np.uint64)) | np.uint64(1)
    return out


def _signer(width: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, size = [], []
            for words in word_chunks(batch.column(2), lower=True):
                tokens, offsets = shingles(words, width)
                node.append(_set_hashes(tokens, offsets))
                size.append(np.diff(offsets))
            if node:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate(node).view(np.int64)), pa.array(np.concatenate(size))], ["doc_id", "row", "node", "n_shingles"])

    return sign


def _batch(key: np.ndarray, node: np.ndarray, wanted: KeyFilter | None) -> pa.RecordBatch:
    if wanted is not None:
        may = wanted.may_hold(key)
        key, node = key[may], node[may]
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(node.view(np.int64))], ["key", "node"])


def _standing(batch: pa.RecordBatch, stand: KeyFilter) -> pa.Array:
    """Texts of the rows (hash, text) that may stand for their set."""
    may = stand.may_hold(batch.column(0).to_numpy())
    return batch.column(1) if may.all() else batch.column(1).filter(pa.array(may))


def _keyer(width: int, percent: int, stand: KeyFilter, wanted: KeyFilter | None):
    """Keys of each set, of one of its rows: copies send none."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in word_chunks(_standing(batch, stand), lower=True):
                tokens, offsets = shingles(words, width)
                node = _set_hashes(tokens, offsets)
                at, key = parity_keys(tokens, offsets, percent)
                yield _batch(key, node[at], wanted)

    return keys


def _texter(width: int, stand: KeyFilter, wanted: KeyFilter):
    """(node, text) of the wanted sets; a row that the filters can't clear is there besides."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            standing = _standing(batch, stand)
            for words in word_chunks(standing, lower=True):
                node = _set_hashes(*shingles(words, width))
                keep = pa.array((node != 0) & wanted.may_hold(node))
                yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)).filter(keep), standing.slice(words.lo, words.hi - words.lo).filter(keep)], ["node", "text"])

    return texts


def _sketcher(width: int, percent: int, stand: KeyFilter, wanted: KeyFilter):
    """(node, n, band, own, below) of the wanted sets."""

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in word_chunks(_standing(batch, stand), lower=True):
                tokens, offsets = shingles(words, width)
                node = _set_hashes(tokens, offsets)
                keep = pa.array((node != 0) & wanted.may_hold(node))
                band, own, below = part_bytes(tokens, offsets, percent)
                cols = [pa.array(node.view(np.int64)), pa.array(np.diff(offsets)), pa.array(band), own, below]
                yield pa.RecordBatch.from_arrays([c.filter(keep) for c in cols], ["node", "n", "band", "own", "below"])

    return sketches


def _refiner(width: int, percent: int, wanted: KeyFilter | None):
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            salt = batch.column(0).to_numpy().view(np.uint64)
            node = batch.column(1).to_numpy()
            for words in word_chunks(batch.column(2), lower=True):
                tokens, offsets = shingles(words, width)
                at, key = parity_keys(tokens, offsets, percent, salt[words.lo : words.hi])
                own = _set_hashes(tokens, offsets).view(np.int64) == node[words.lo : words.hi]
                at, key = at[own[at]], key[own[at]]
                yield _batch(key, node[words.lo : words.hi][at], wanted)

    return keys


def _multi(stage: Stage, texts: DataFrame, keyer, name: str) -> DataFrame:
    """(key, node) of the buckets that hold two nodes at least; a few hold one that was sent twice.

    A key's rows are counted, combined before the shuffle, so a key of any
    number of sets is a row a task.  Then only the keys of such buckets are
    made again: most sets share none.
    """
    schema = "key long, node long"
    counted = texts.mapInArrow(keyer(None), schema).groupBy("key").agg(F.count(F.lit(1)).alias("m"))
    shared = stage.write(counted.filter("m > 1").select("key"), f"{name}-keys")
    rows = texts.mapInArrow(keyer(key_filter(shared, "key")), schema).distinct().join(shared, "key", "left_semi")
    multi = stage.write(rows, name)
    stage.drop(f"{name}-keys")
    return multi


def _elected(stage: Stage, multi: DataFrame, classes: DataFrame, name: str) -> DataFrame:
    """(key, m, share, hub) of each bucket: its members, the mean share of their parts that they have in
    common with anyone, and the member that most buckets hold."""
    popular = multi.groupBy("node").agg(F.count(F.lit(1)).alias("pop")).join(classes.select("node", "n"), "node")
    scored = multi.join(popular.select("node", "pop", (F.col("pop") / F.col("n")).alias("share")), "node")
    return stage.write(scored.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.avg("share").alias("share"), F.max_by("node", F.struct("pop", "node")).alias("hub")), name)


class _Forest:
    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[x] = y
        return x != y


def _intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Exact sizes of the intersections of each set of left with each of right.

    A product of 0/1 matrices over the shingles that two sets hold at least,
    a slice of them at a time, so that memory doesn't grow with the texts.
    """
    both = [*left, *right]
    tokens = np.concatenate(both)
    values, column = np.unique(tokens, return_inverse=True)
    row = np.repeat(np.arange(len(both)), [len(x) for x in both])
    seen = np.bincount(column, minlength=len(values))
    keep = seen[column] > 1
    new = np.cumsum(seen > 1) - 1
    row, column = row[keep], new[column[keep]]
    width = int((seen > 1).sum())
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, width, 8192):
        a, b = np.searchsorted(column, [lo, lo + 8192])
        m = np.zeros((len(both), min(8192, width - lo)), np.float32)
        m[row[a:b], column[a:b] - lo] = 1
        out += m[: len(left)] @ m[len(left) :].T
    return out.astype(np.int64)


#: Bytes of parts that a task compares at a time.
BYTES_AT_ONCE = 1 << 23


def may_link(left: np.ndarray, right: np.ndarray, n: np.ndarray, band: np.ndarray, own: list[bytes], below: list[bytes], percent: int) -> np.ndarray:
    """Whether each set may link with a set of the other side: all but those whose parts tell them apart from every one.

    left and right are places in the other arrays; they may be the same array.
    """
    ok = np.zeros(len(n), bool)

    def meet(x: np.ndarray, y: np.ndarray, xs: list[bytes], ys: list[bytes]) -> None:
        if not len(x) or not len(y):
            return
        a, b = (np.frombuffer(b"".join([of[i] for i in at.tolist()]), np.uint8).reshape(len(at), -1) for at, of in ((x, xs), (y, ys)))
        step = max(1, BYTES_AT_ONCE // b.size)
        for lo in range(0, len(x), step):
            at = x[lo : lo + step]
            apart = np.count_nonzero(a[lo : lo + step, None] != b[None], axis=2)
            hit = ((100 + percent) * apart <= (100 - percent) * (n[at][:, None] + n[y][None])) & (at[:, None] != y[None])
            ok[at] |= hit.any(1)
            ok[y] |= hit.any(0)

    upper = np.array([len(b) > 0 for b in below], bool)
    for b in np.unique(band).tolist():
        a, c = (side[(band[side] == b) & (n[side] > 0)] for side in (left, right))
        over, cover = (side[(band[side] == b + 1) & upper[side]] for side in (left, right))
        meet(a, c, own, own)
        meet(a, cover, own, below)
        if left is not right:
            meet(over, c, below, own)
    return ok


def _prober(percent: int):
    """The rows that may link in their pair of blocks; they come ordered by (hub, left block, right block), a task at a time."""

    def alive(t: pa.Table, same: bool) -> np.ndarray:
        side, n, band = (t.column(c).to_numpy() for c in ("side", "n", "band"))
        left = np.flatnonzero(side == 0)
        right = left if same else np.flatnonzero(side == 1)
        if not len(left) or not len(right) or (same and len(left) < 2):
            return np.zeros(len(side), bool)
        return may_link(left, right, n, band, t.column("own").to_pylist(), t.column("below").to_pylist(), percent)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        at = None

        def flush() -> pa.Table:
            t = pa.Table.from_batches(held)
            return t.select(["hub", "lb", "rb", "node", "side"]).filter(pa.array(alive(t, at[1] == at[2])))

        for batch in batches:
            if not batch.num_rows:
                continue
            hub, lb, rb = (batch.column(i).to_numpy() for i in range(3))
            cuts = np.flatnonzero((hub[1:] != hub[:-1]) | (lb[1:] != lb[:-1]) | (rb[1:] != rb[:-1])) + 1
            out = []
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(hub)], strict=True):
                here = (hub[lo], lb[lo], rb[lo])
                if here != at:
                    if held:
                        out.append(flush())
                    held, at = [], here
                held.append(batch.slice(lo, hi - lo))
            if out:
                yield from pa.concat_tables(out).combine_chunks().to_batches()
        if held:
            yield from flush().to_batches()

    return probe


def _comparer(width: int, percent: int):
    """Rows come ordered by (hub, left block, right block), a task at a time."""

    def links(group: list[tuple], same: bool) -> tuple[list, list]:
        """group: (node, side, copies, hubs, set) rows of one pair of blocks of one hub."""
        left = [g for g in group if g[1] == 0]
        right = left if same else [g for g in group if g[1] == 1]
        if not left or not right:
            return [], []
        n = np.array([len(g[4]) for g in left])
        m = np.array([len(g[4]) for g in right])
        shared = _intersections([g[4] for g in left], [g[4] for g in right])
        hit = (100 + percent) * shared >= percent * (n[:, None] + m[None, :])
        forest, edges, counts = _Forest(), [], {}
        hub = group[0][5]
        for i, j in zip(*np.nonzero(hit), strict=True):
            if same and j <= i:
                continue
            a, b = left[i], right[j]
            if forest.join(a[0], b[0]):
                edges.append((a[0], b[0]))
            if len(a[3]) == 1 or len(b[3]) == 1 or min(set(a[3]) & set(b[3])) == hub:  # else another hub counts this pair
                counts[a[0]] = counts.get(a[0], 0) + b[2]
                counts[b[0]] = counts.get(b[0], 0) + a[2]
        return edges, list(counts.items())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        seen: set[tuple] = set()
        at = None

        def flush():
            edges, counts = links(held, at[1] == at[2])
            rows = [(a, b, 0) for a, b in edges] + [(a, None, c) for a, c in counts]
            if rows:
                cols = list(zip(*rows, strict=True))
                return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b", "n"])

        for batch in batches:
            meta = batch.select(["hub", "lb", "rb", "node", "side", "copies", "hubs"]).to_pydict()
            for words in word_chunks(batch.column(batch.schema.get_field_index("text")), lower=True):
                tokens, offsets = shingles(words, width)
                own = _set_hashes(tokens, offsets).view(np.int64).tolist()
                for d in range(words.hi - words.lo):
                    i = words.lo + d
                    here = (meta["hub"][i], meta["lb"][i], meta["rb"][i])
                    if here != at:
                        if held and (out := flush()) is not None:
                            yield out
                        held, at = [], here
                        seen.clear()
                    if own[d] != meta["node"][i] or (own[d], meta["side"][i]) in seen:  # an id that several rows have
                        continue
                    seen.add((own[d], meta["side"][i]))
                    held.append((meta["node"][i], meta["side"][i], meta["copies"][i], meta["hubs"][i], tokens[offsets[d] : offsets[d + 1]], here[0]))
        if held and (out := flush()) is not None:
            yield out

    return compare


def jaccard_components(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id, n_links.

    Documents link when 100 * intersection >= percent * union of their sets of
    ``width``-word shingles (words lower-cased in A-Z).  component_id is the
    smallest id reachable by links, n_links the number of linked documents.
    A null or blank text has no shingle, links with nothing and is its own
    component; a text of fewer words is one shingle.  Copies and ties link as
    any pair; an empty table gives no rows; other columns are ignored; rows
    with a null id keep their shingles' component of documents that have an id.
    With row_col, a unique long of each row, that column is returned too, and
    ``first``: true for one row of each component, the smallest by (id, row),
    null ids last.
    """
    stage = Stage(spark, "jaccard")
    number = F.col(row_col if row_col else id_col).cast("long").alias("row")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), number, F.col(text_col).alias("text"))
    signed = stage.write(base.mapInArrow(_signer(width), "doc_id long, row long, node long, n_shingles long"), "signed")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    classes = stage.write(signed.filter("n_shingles > 0").groupBy("node").agg(least.alias("least"), F.count(F.lit(1)).alias("copies"), F.max("n_shingles").alias("n")), "classes")
    stand = key_filter(classes.select(F.xxhash64("least.row").alias("h")), "h")
    hashed = base.select(F.xxhash64("row").alias("h"), "text")
    multi = _multi(stage, hashed, functools.partial(_keyer, width, percent, stand), "multi")

    def texts_of(nodes: DataFrame, name: str) -> DataFrame:
        return stage.write(hashed.mapInArrow(_texter(width, stand, key_filter(nodes, "node")), "node long, text string"), name)

    # Near copies share many parts.  A large bucket whose members share few parts with anyone
    # holds texts that have a passage in common, and is split by another dealing of their sets.
    buckets = _elected(stage, multi, classes, "buckets")
    large = buckets.filter((F.col("m") > REFINE_ABOVE) & (F.col("share") < REFINE_BELOW)).select("key")
    if large.limit(1).count():
        members = stage.write(multi.join(large, "key").select("key", "node"), "members")
        texts = texts_of(stage.write(members.select("node").distinct(), "split"), "parted")
        rows = stage.write(members.join(texts, "node").select("key", "node", "text"), "large")
        stage.drop("parted", "split", "members")
        finer = _multi(stage, rows, functools.partial(_refiner, width, percent), "finer")
        multi = stage.write(multi.join(large, "key", "left_anti").unionByName(finer), "refined")
        stage.drop("multi", "finer", "large", "buckets")
        buckets = _elected(stage, multi, classes, "rebuckets")
    star = stage.write(multi.join(buckets.select("key", "hub"), "key").select("node", "hub").distinct(), "star")

    hubs = star.groupBy("node").agg(F.sort_array(F.collect_list("hub")).alias("hubs")).join(classes.select("node", "copies"), "node")
    sized = star.groupBy("hub").agg(F.count(F.lit(1)).alias("m"))
    placed = rank_in_group(star, ["hub"], F.col("node"), "place")
    blocks = attach_by_key(placed.withColumn("block", F.floor(F.col("place") / F.lit(BLOCK)).cast("int")), sized, ["hub"], star.count(), "m")
    last = F.floor((F.col("m") - 1) / F.lit(BLOCK)).cast("int")
    pair = F.explode(F.transform(F.sequence(F.lit(0), last), lambda o: F.struct(F.least("block", o).alias("lb"), F.greatest("block", o).alias("rb"), F.when(F.col("block") <= o, 0).otherwise(1).alias("side"))))
    spread = blocks.select("hub", "node", pair.alias("p")).select("hub", "node", "p.lb", "p.rb", "p.side")
    wanted = stage.write(star.select("node").distinct(), "wanted")
    bands = hashed.mapInArrow(_sketcher(width, percent, stand, key_filter(wanted, "node")), "node long, n long, band long, own binary, below binary").join(wanted, "node", "left_semi")
    sketches = stage.write(bands.groupBy("node").agg(F.max(F.struct("n", "band", "own", "below")).alias("s")).select("node", "s.*"), "sketches")
    probed = spread.join(sketches, "node").select("hub", "lb", "rb", "node", "side", "n", "band", "own", "below").repartition("hub", "lb", "rb").sortWithinPartitions("hub", "lb", "rb", "side")
    near = stage.write(probed.mapInArrow(_prober(percent), "hub long, lb int, rb int, node long, side int"), "near")
    texts = texts_of(stage.write(near.select("node").distinct(), "linking"), "texts")
    work = near.join(hubs, "node").join(texts, "node").repartition("hub", "lb", "rb").sortWithinPartitions("hub", "lb", "rb", "side")
    found = stage.write(work.select("hub", "lb", "rb", "node", "side", "copies", "hubs", "text").mapInArrow(_comparer(width, percent), "a long, b long, n long"), "found")
    stage.drop("texts", "wanted", "sketches", "near", "linking")

    roots = connected_components(found.filter(F.col("b").isNotNull()).select("a", "b"), stage, "cc")
    degree = found.filter(F.col("b").isNull()).groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    named = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).join(degree, "node", "left")
    smallest = named.groupBy("root").agg(F.min("least").alias("top"))
    verdict = stage.write(named.join(smallest, "root").select("node", "top", "copies", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "verdict")
    stage.drop("found", "star", "refined", "multi", "classes", "buckets", "rebuckets")
    total = signed.count()
    # Texts without a shingle share no class; they stay out of the join, where they'd be one hot key.
    out = attach_by_key(signed.filter("n_shingles > 0"), verdict, ["node"], total, "copies").unionByName(signed.filter("n_shingles = 0"), allowMissingColumns=True)
    own = ["doc_id", "n_shingles", F.coalesce("top.doc_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")]
    return out.select(*own, *([F.col("row").alias(row_col), F.coalesce(F.col("top.row") == F.col("row"), F.lit(True)).alias("first")] if row_col else []))
