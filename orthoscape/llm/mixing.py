"""Mixing sources to target weights by Pfair scheduling.

A source's documents, in the order of a keyed hash, are cut into blocks.  With
share w of the weights, block j of a source may not run before slot
floor(j / w) and is due by slot ceil((j + 1) / w).  The earliest deadline first
among released blocks meets all of these windows, so at every slot each source
is less than one block away from its share.  Weights are kept as integers, the
exact fractions that were given, and releases and deadlines are computed from
them without rounding.

When a source runs out, the others go on in proportion to their weights, with
releases and deadlines counted from there: the bound holds in each such phase.
The driver plans slots, not documents: one number a block and some a source.
"""

from __future__ import annotations

import heapq
from array import array
from fractions import Fraction
from math import gcd, lcm
from numbers import Rational

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import Stage, attach_by_key, rank_in_group

BLOCK = 32
TEMPERATURE = 0.7
#: Sources whose names the driver holds; more are numbered on the cluster.
NAMED_SOURCES = 4096
OUTPUT = ("block_no", "slot", "slot_pos", "mix_position")


def exact_weights(weights: dict) -> dict:
    """Coprime integers in the proportion of the weights; a float is the fraction that it stands for."""
    parts = {s: w if isinstance(w, Rational) else Fraction(w) for s, w in weights.items()}
    if any(p <= 0 for p in parts.values()):
        raise ValueError("weights must be positive")
    scale = lcm(*(p.denominator for p in parts.values()))
    whole = {s: int(p * scale) for s, p in parts.items()}
    common = gcd(*whole.values())
    return {s: n // common for s, n in whole.items()}


class _Run:
    """Live sources of one weight, in order; those from ``at`` on haven't run in the present phase."""

    def __init__(self, weight: int):
        self.weight, self.items, self.start, self.at = weight, array("i"), 0, 0

    def remove(self, i: int) -> None:
        """Drop a source that has run in this phase: those before it move up by one."""
        k = self.items.index(i, self.start, self.at)
        self.items[self.start + 1 : k + 1] = self.items[self.start : k]
        self.start += 1


def schedule(weights: list[int], blocks: list[int]) -> np.ndarray:
    """The source (its place in the lists) of each slot, by earliest deadline first, until all blocks are placed.

    A phase, which ends when a source runs out, looks only at the sources that
    run in it: of those that haven't yet, the first of each weight stands for
    all of that weight, and weights are looked at from the largest down.  So
    the time is that of a heap over the slots, however many sources and phases.
    """
    left, out = array("q", blocks), array("i")
    by_weight: dict[int, _Run] = {}
    for i, n in enumerate(left):
        if n:
            by_weight.setdefault(weights[i], _Run(weights[i])).items.append(i)
    runs = [by_weight[w] for w in sorted(by_weight, reverse=True)]
    total = sum(r.weight * len(r.items) for r in runs)
    while runs:
        done: dict[int, int] = {}
        waiting, ready, fresh, near, slot = [], [], [], 0, 0
        while True:
            while waiting and waiting[0][0] <= slot:
                i = heapq.heappop(waiting)[1]
                heapq.heappush(ready, (-(-(done[i] + 1) * total // weights[i]), i))
            while near < len(runs):
                due = -(-total // runs[near].weight)
                if min(ready[0] if ready else (due,), fresh[0] if fresh else (due,))[0] < due:
                    break
                run = runs[near]
                heapq.heappush(fresh, (due, run.items[run.start], near))
                run.at = run.start
                near += 1
            if fresh and (not ready or fresh[0][:2] < ready[0]):
                deadline, i, k = fresh[0]
                run = runs[k]
                run.at += 1
                if run.at < len(run.items):
                    heapq.heapreplace(fresh, (deadline, run.items[run.at], k))
                else:
                    heapq.heappop(fresh)
            else:
                deadline, i = heapq.heappop(ready)
            if deadline <= slot:
                raise AssertionError("a block misses its deadline")
            out.append(i)
            done[i] = done.get(i, 0) + 1
            left[i] -= 1
            slot += 1
            if not left[i]:
                break
            heapq.heappush(waiting, (done[i] * total // weights[i], i))
        run = by_weight[weights[i]]
        run.remove(i)
        total -= run.weight
        if run.start == len(run.items):
            runs.remove(run)
    return np.array(out, np.int32)


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def output_names(columns: list[str]) -> dict[str, str]:
    """What mix_sources calls each input column: its own name, or input_<name> where that is an output column."""
    taken, names = set(OUTPUT) | {c.lower() for c in columns}, {}
    for c in columns:
        new = c
        while new.lower() in OUTPUT or (new != c and new.lower() in taken):
            new = f"input_{new}"
        taken.add(new.lower())
        names[c] = new
    return names


def _row_hash(docs: DataFrame) -> Column:
    """A hash of all columns; those that hold maps are hashed as JSON."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    return F.xxhash64(F.lit(0), *[F.to_json(F.struct(_named(c))) if "map<" in k else _named(c) for c, k in kinds.items() if "void" not in k])


def _targets(counts: list[int], weights: list | None) -> list[int]:
    """Integers in the proportion of the weights; without them, of the counts' powers."""
    target = [int(1000 * n**TEMPERATURE) for n in counts] if weights is None else weights
    exact = exact_weights({w: w for w in set(target)}) if target else {}
    return [exact[w] for w in target]


def _counted(docs: DataFrame, key: Column, weights: dict | None):
    """(_source, count) table, its order, and the weights by key."""
    named = {("=" + s if s is not None else "null"): w for s, w in (weights or {}).items()}
    asked = F.col("_source").isin(*named) if named else F.lit(False)
    return docs.groupBy(key.alias("_source")).count(), (asked.desc(), F.desc("count"), F.col("_source")), named, asked


def _all_sources(docs: DataFrame, key: Column, weights: dict | None, held: int):
    """(_source, _place, _n) table, rows and weight of each source by place; the names stay on the cluster if they are over ``held``."""
    counted, order, named, asked = _counted(docs, key, weights)
    least = min(named.values(), default=None)
    first = counted.orderBy(*order).limit(held + 1).collect()
    spark = docs.sparkSession
    if len(first) <= held:
        table = spark.createDataFrame([(r[0], i, r[1]) for i, r in enumerate(first)], "_source string, _place int, _n long")
        counts, own = [r[1] for r in first], [named.get(r[0], least) for r in first]
        return F.broadcast(table), counts, _targets(counts, own if named else None)
    ordered = Stage(spark, "sources").write(counted.orderBy(*order), "ordered")
    # Files follow the order; a source's place is the rows of the files before it and its row.
    ordered = ordered.withColumn("_file", F.col("_metadata.file_name")).withColumn("_row", F.col("_metadata.row_index"))
    size = sorted(map(tuple, ordered.groupBy("_file").count().collect()))
    start = np.concatenate([[0], np.cumsum([n for _, n in size])])[:-1].tolist()
    files = F.broadcast(spark.createDataFrame([(f, b) for (f, _), b in zip(size, start, strict=True)], "_file string, _start long"))
    table = ordered.join(files, "_file").select("_source", (F.col("_start") + F.col("_row")).cast("int").alias("_place"), F.col("count").alias("_n"))
    got = table.select("_place", "_n").toArrow()  # two numbers a source
    counts = got.column(1).to_numpy()[np.argsort(got.column(0).to_numpy())].tolist()
    own = [named[r[0]] for r in counted.filter(asked).orderBy(*order).collect()] if named else []
    return table, counts, _targets(counts, own + [least] * (len(counts) - len(own)) if named else None)


def _bundled_sources(docs: DataFrame, key: Column, weights: dict | None, most: int):
    """As _all_sources, with bundles of the smallest sources beyond ``most``; None without need of them."""
    counted, order, named, _ = _counted(docs, key, weights)
    alone = counted.orderBy(*order).limit(most + 1).collect()
    if len(alone) <= most:
        return None
    alone, spark = alone[: most // 2], docs.sparkSession
    own = spark.createDataFrame([(r[0], i) for i, r in enumerate(alone)], "_source string, _place int")
    rest = counted.join(F.broadcast(own), "_source", "left_anti").withColumn("_b", F.pmod(F.xxhash64("_source"), F.lit(most // 2)))
    power = F.floor(1000 * F.pow("count", F.lit(TEMPERATURE)))
    bundled = rest.groupBy("_b").agg(F.sum("count"), F.sum(power), F.count(F.lit(1))).orderBy("_b").collect()
    if weights is None:
        target = [int(1000 * n**TEMPERATURE) for _, n in alone] + [r[2] for r in bundled]
    else:
        least = min(named.values())
        target = [named.get(s, least) for s, _ in alone] + [Fraction(least) * r[3] for r in bundled]
    groups = F.broadcast(spark.createDataFrame([(r[0], len(alone) + i) for i, r in enumerate(bundled)], "_b long, _place int"))
    table = own.join(counted, "_source").select("_source", "_place", F.col("count").alias("_n")).unionByName(rest.join(groups, "_b").select("_source", "_place", F.col("count").alias("_n")))
    return table, [r[1] for r in [*alone, *bundled]], _targets([], target)


def mix_sources(spark: SparkSession, docs: DataFrame, weights: dict | None = None, block: int = BLOCK, id_col: str = "doc_id", source_col: str = "source", seed: int = 17, most_sources: int | None = None, plan_slots: int | None = None) -> DataFrame:
    """All columns and rows of docs, with block_no, slot, slot_pos and mix_position (dense, from 0).

    Weights are numbers (ints, fractions, floats) by source, None naming the
    null source; sources that aren't named get the smallest of them.  Without
    weights, a source's weight is 1000 times its count to the power 0.7,
    rounded down.  No row is dropped or repeated: once a source runs out, the
    others share its slots.  A null source is a source by itself, an empty
    name another.  Repeated rows and null ids are scheduled like others; an
    empty table gives no rows.  An input column called as an output column is
    kept as input_<name>; all others keep their names, whatever they are.

    Every source has windows of its own, however many there are; beyond
    ``NAMED_SOURCES`` their names stay on the cluster and the driver plans with
    numbers.  A caller may ask for a coarser plan: with plan_slots, blocks have
    rows / plan_slots documents where there are more rows; with most_sources,
    those beyond the largest half of that number (and the named ones) are dealt
    by hash to as many bundles, each scheduled as one source with the sum of
    its weights, inside which documents mix in proportion to their counts.
    """
    key = F.coalesce(F.concat(F.lit("="), _named(source_col).cast("string")), F.lit("null"))
    coarse = _bundled_sources(docs, key, weights, max(most_sources, 2 * len(weights or ()))) if most_sources else None
    table, rows, whole = coarse or _all_sources(docs, key, weights, NAMED_SOURCES)
    if plan_slots:
        block = max(block, -(-sum(rows) // plan_slots))
    who = schedule(whole, [-(-n // block) for n in rows])
    # Slots of each source's blocks, in order, and the rows before each slot.
    slot_of = np.argsort(who, kind="stable").astype(np.int32)
    first = np.concatenate([[0], np.cumsum(np.bincount(who, minlength=len(rows)))]).astype(np.int64)
    size = np.full(len(who), block, np.int64)
    if len(who):
        size[slot_of[first[1:] - 1]] = [(n - 1) % block + 1 for n in rows]
    plan = spark.sparkContext.broadcast((first, slot_of, np.concatenate([[0], np.cumsum(size)])))

    @F.pandas_udf("slot long, before long")
    def placed(source: pd.Series, number: pd.Series) -> pd.DataFrame:
        first, slot_of, before = plan.value
        slot = slot_of[first[source.to_numpy()] + number.to_numpy()].astype(np.int64)
        return pd.DataFrame({"slot": slot, "before": before[slot]})

    names = list(output_names(docs.columns).values())
    order = F.struct(F.xxhash64(_named(id_col), F.lit(seed)).alias("h"), _named(id_col).alias("i"), _row_hash(docs).alias("r"))
    held = [f"_c{i}" for i in range(len(names))]  # names of the input's columns meanwhile: none of the plan's own
    # An exploded order is a plain column to the optimizer, which else rewrites the hash by every subset of renamed columns.
    tagged = docs.select("*", F.explode(F.array(F.struct(order.alias("by"), key.alias("source")))))
    tagged = tagged.toDF(*held, "_by").select(*held, "_by.by", F.col("_by.source").alias("_source")).withColumnRenamed("by", "_by")
    few = coarse is None and len(rows) <= NAMED_SOURCES
    tagged = tagged.join(table, "_source", "left") if few else attach_by_key(tagged, table, ["_source"], sum(rows), "_n")
    ranked = rank_in_group(tagged.select(*held, "_by", "_place"), ["_place"], F.col("_by"), "_rank", rows_per_bucket=5_000)  # rows may carry whole texts
    number = F.floor(F.col("_rank") / block).cast("long")
    done = ranked.withColumn("_no", number).withColumn("_at", placed("_place", "_no"))
    inside = (F.col("_rank") % block).cast("long")
    out = {"block_no": F.col("_no"), "slot": F.col("_at.slot"), "slot_pos": inside, "mix_position": F.col("_at.before") + inside}
    return done.select(*[F.col(h).alias(n) for h, n in zip(held, names, strict=True)], *[c.cast("long").alias(n) for n, c in out.items()])
