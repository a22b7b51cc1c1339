"""Filters on scenes, frames and modalities: DataFrame -> DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def slice_rows(df: DataFrame, start: int | None, stop: int | None, step: int = 1, order: str = "scene") -> DataFrame:
    """Rows of a Python slice over df in the order of a unique column.

    A bound from the front is a top-k by the order, so it needs no full sort
    in one task; with bounds from the end the row count is used.
    """
    if step < 1:
        raise ValueError("step must be positive")
    total = df.count() if (start or 0) < 0 or stop is None or stop < 0 else None
    lo, hi = slice(start, stop).indices(total)[:2] if total is not None else (start or 0, stop)
    if hi <= lo:
        return df.limit(0)
    head = df.orderBy(order).limit(hi)
    if lo == 0 and step == 1:
        return head
    ranked = head.withColumn("_i", F.row_number().over(Window.orderBy(order)) - 1)
    return ranked.filter((F.col("_i") >= lo) & ((F.col("_i") - lo) % step == 0)).drop("_i")


def named(df: DataFrame, names: list[str], col: str = "scene") -> DataFrame:
    """Rows whose name is listed, pushed to the scan as an IN predicate."""
    return df.filter(F.col(col).isin(names))


def matching(df: DataFrame, pattern: str, col: str = "scene", full: bool = True) -> DataFrame:
    """Names that match a regex: the whole name, or from its start only."""
    return df.filter(F.col(col).rlike(f"^(?:{pattern})$" if full else f"^(?:{pattern})"))


def having(df: DataFrame, present: DataFrame, on: str | list[str], wanted: bool = True) -> DataFrame:
    """Rows with (or without) a partner in ``present``: exists and exists_not."""
    return df.join(present, on, "left_semi" if wanted else "left_anti")


def in_state(df: DataFrame, log: str, process: str, state: str, wanted: bool = True) -> DataFrame:
    """Rows whose process log (a map of process to struct<state>) is, or isn't, in a state; no entry is no state."""
    now = F.coalesce(F.element_at(F.col(log), process)["state"], F.lit(""))
    return df.filter((now == state) if wanted else (now != state))


def chain(df: DataFrame, steps: list) -> DataFrame:
    """Apply filters one after the other, each on what its predecessor kept."""
    return reduce(lambda d, f: f(d), steps, df)


def weight_in(w: Column, low: float, high: float) -> Column:
    """The half-open range [low, high), with the upper bound kept clear of rounding."""
    return (w >= low) & (w < high - 1e-12)


def in_image(row: Column, col: Column, depth: Column, height: Column | int, width: Column | int, min_depth: float = 0.0) -> Column:
    return (row >= 0) & (col >= 0) & (depth >= 0) & (row < height) & (col < width) & (depth > min_depth)


def valid_depth(z: Column, floor: float = 0.0) -> Column:
    """Finite and above the floor; null isn't valid."""
    return F.coalesce((z > floor) & ~F.isnan(z) & (z != float("inf")), F.lit(False))


def finite_or_zero(x: Column) -> Column:
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")) | x.isNull(), F.lit(0.0)).otherwise(x)


def down_angle(fx: Column, fy: Column, fz: Column, either_way: bool = False) -> Column:
    """Degrees between a forward vector and straight down (0, 0, -1)."""
    norm = F.sqrt(fx * fx + fy * fy + fz * fz)
    down = -fz / F.greatest(norm, F.lit(1e-12))
    down = F.abs(down) if either_way else down
    return F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), down))))


def view_class(angle: Column, limit: float = 35.0) -> Column:
    return F.when(angle <= limit, "down").otherwise("side")


def pick_modality(names: Column, wanted: str) -> Column:
    """A literal name, or the first name that matches a regex; of a nested path, the last part."""
    if any(c in wanted for c in ".|*+?[]()^$\\"):
        found = F.get(F.filter(names, lambda n: n.rlike(f"^(?:{wanted})")), F.lit(0))
    else:
        found = F.when(F.array_contains(names, wanted), F.lit(wanted))
    return F.element_at(F.split(found, "/"), -1)


def remap(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename the columns that are there."""
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def with_default(frame: Column, scene: Column) -> Column:
    """A frame's value, or its scene's where it has none."""
    return F.coalesce(frame, scene)


#: Rules that go to every task; more are joined by shuffles.
RULES_AT_ONCE = 100_000


def assign_splits(scenes: DataFrame, rules: DataFrame, repeats: bool = False) -> DataFrame:
    """(dataset, scene, split) by the first rule that matches; a rule may name several splits or none.

    rules: dataset, rule_order, kind (all, prefix, name), pattern, splits, any
    number of them.  A scene is looked up under its name, its dataset and its
    prefixes of the lengths that rules have, so that rules are found by an equi
    join.  Its side of the join is never broadcast: it looks small where the
    table is, but has a row for each lookup.  A scene that comes several times
    gets its splits once, with ``repeats`` as often as it comes.
    """
    kind = lambda k, p: F.struct(F.lit(k).alias("kind"), p.alias("pattern"))
    known = rules.withColumn("pattern", F.when(F.col("kind") == "all", "").otherwise(F.col("pattern")))
    lengths = known.filter("kind = 'prefix'").agg(F.collect_set(F.length("pattern")).alias("_lengths"))  # a number for each length of a name at most
    times = scenes.groupBy("dataset", "scene").agg((F.count(F.lit(1)) if repeats else F.lit(1).cast("long")).alias("_times")).crossJoin(F.broadcast(lengths))
    fitting = F.filter("_lengths", lambda n: n <= F.length("scene"))
    prefixes = F.transform(fitting, lambda n: kind("prefix", F.substring(F.col("scene"), F.lit(1), n)))
    keys = F.concat(F.array(kind("all", F.lit("")), kind("name", F.col("scene"))), prefixes)
    asked = times.select("dataset", "scene", "_times", F.explode(keys).alias("k")).select("dataset", "scene", "_times", "k.kind", "k.pattern")
    few = known.limit(RULES_AT_ONCE + 1).count() <= RULES_AT_ONCE
    found = asked.hint("merge").join(known, ["dataset", "kind", "pattern"]) if not few else asked.join(F.broadcast(known), ["dataset", "kind", "pattern"])
    first = found.groupBy("dataset", "scene").agg(F.min_by("splits", "rule_order").alias("splits"), F.max("_times").alias("_times"))
    return first.select("dataset", "scene", F.explode(F.flatten(F.array_repeat("splits", F.col("_times").cast("int")))).alias("split"))
