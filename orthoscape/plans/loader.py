"""Sample views, load, align, derive: one operator, configured by a small table of loaders."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ranges
from ..operators import walks
from ..operators.raster import unproject


@dataclass(frozen=True)
class Loader:
    """Constants of one dataset's loader."""

    dataset: str
    metric_scale: bool
    synthetic: bool
    mode: str = "random_walk"  # random_walk, chain, tree, star
    low: float = 0.2
    high: float = 0.95
    topk: int = 20


def config(defaults: dict, overrides: dict) -> Loader:
    """A loader from defaults and overrides; unknown keys are an error, null overrides count for nothing."""
    known = {f.name for f in fields(Loader)}
    merged = defaults | {k: v for k, v in overrides.items() if v is not None}
    if odd := set(merged) - known:
        raise ValueError(f"unknown settings: {sorted(odd)}")
    return Loader(**merged)


def parsed_settings(text: str) -> dict:
    """Settings of a YAML (or JSON) text; an empty one has none, anything but a map is an error."""
    import yaml

    out = yaml.safe_load(text) or {}
    if not isinstance(out, dict):
        raise ValueError(f"settings must be a map, not a {type(out).__name__}")
    return out


def command_line(words: list[str], checks: dict[str, Callable]) -> dict:
    """Settings given as ``--name value`` or ``--name=value``; dashes and underscores are the same.

    checks: the reader of each known name; a boolean one may stand alone, or
    with ``no-`` before its name.  Unknown names and bad values are errors.
    """
    out, rest = {}, list(words)
    while rest:
        name, given, value = rest.pop(0).partition("=")
        if not name.startswith("--"):
            raise ValueError(f"not a setting: {name}")
        name = name[2:].replace("-", "_")
        if not given and name.startswith("no_") and checks.get(name[3:]) is ranges.boolean:
            out[name[3:]] = False
            continue
        if name not in checks:
            raise ValueError(f"unknown setting: {name}")
        if not given:
            alone = not rest or rest[0].startswith("--")
            if alone and checks[name] is not ranges.boolean:
                raise ValueError(f"{name} needs a value")
            value = "true" if alone else rest.pop(0)
        out[name] = checks[name](value)
    return out


def settings(defaults: dict, text: str, words: list[str], checks: dict[str, Callable]) -> dict:
    """defaults, then those of a text, then the command line: the later ones win; null counts for nothing."""
    read = {k.replace("-", "_"): v for k, v in parsed_settings(text).items()}
    return defaults | {k: v for k, v in read.items() if v is not None} | command_line(words, checks)


def sampled_views(loader: Loader, edges: DataFrame, samples: DataFrame, views: int, seed: int) -> DataFrame:
    """(scene, sample, step, view) by the loader's mode; short samples are filled with their own views in turn."""
    rule = {
        "random_walk": lambda g, n, r: walks.random_walk(g, n, r, loader.low, loader.high, loader.topk),
        "tree": lambda g, n, r: walks.tree(g, n, r, loader.low, loader.high, loader.topk),
        "star": lambda g, n, r: walks.star(g, n, r, loader.low, loader.high, loader.topk),
        "chain": lambda g, n, r: walks.chain(g, n, g.pick(r), loader.low, loader.high, loader.topk) if g.size else [],
    }[loader.mode]

    def padded(g: walks.Graph, n: int, r) -> list[int]:
        got = rule(g, n, r) or ([g.pick(r)] if g.size else [])
        return (got * n)[:n] if got else []

    return walks.sample_walks(edges, samples, padded, views, seed, least=loader.low)


def view_records(loader: Loader, chosen: DataFrame, frames: DataFrame, pixels: DataFrame) -> DataFrame:
    """One row a (sample, view): valid pixels, mean depth, mean point in the camera, and the loader's flags.

    frames: scene, view, fx, fy, cx, cy.  pixels: view, y, x, z; values that
    aren't finite or positive are invalid.  Pixels are reduced by view before
    they meet the samples, as a view is in many of them.
    """
    cam = frames.select("scene", "view", "fx", "fy", "cx", "cy")
    ok = (F.col("z") > 0) & ~F.isnan("z") & (F.col("z") != float("inf"))
    p = pixels.filter(ok).join(cam, "view")
    px, py, pz = unproject(F.col("x"), F.col("y"), F.col("z"), *[F.col(c) for c in ("fx", "fy", "cx", "cy")])
    by_view = p.groupBy("scene", "view").agg(F.count(F.lit(1)).alias("n_valid"), F.avg("z").alias("mean_depth"), F.avg(px).alias("mx"), F.avg(py).alias("my"), F.avg(pz).alias("mz"))
    out = chosen.join(cam, ["scene", "view"]).join(by_view, ["scene", "view"], "left")
    return out.select("scene", "sample", "step", "view", F.coalesce("n_valid", F.lit(0)).alias("n_valid"), "mean_depth", "mx", "my", "mz", F.lit(loader.dataset).alias("dataset"), F.lit(loader.metric_scale).alias("is_metric_scale"), F.lit(loader.synthetic).alias("is_synthetic"))
