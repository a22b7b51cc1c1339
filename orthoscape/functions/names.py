"""Parsing of file, frame and camera names, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stem(path: Column) -> Column:
    """The file name without its last extension."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(.)\.[^.]*$", "$1")


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"[^/.][^/]*(\.[^./]+)$", 1))


def numeric_prefix(name: Column) -> Column:
    return F.regexp_extract(name, r"^(\d+)", 1).try_cast("long")


def role_of_name(name: Column) -> Column:
    """Flight role by suffix, the longest first; other names are an error."""
    return F.when(name.endswith("_nadir_2"), "nadir2").when(name.endswith("_oblique"), "oblique").when(name.endswith("_nadir"), "nadir").otherwise(F.raise_error(F.concat(F.lit("no role in "), name)))


def camera_of_name(name: Column, patterns: list[str]) -> tuple[Column, Column]:
    """(rig name, camera) by the first case-insensitive pattern that occurs.

    The camera is the pattern's first group; the rig is the name with the match
    replaced by ``_`` and stripped of ``_ - .`` and blanks at its ends.
    """
    camera, rig = F.lit(None).cast("string"), name
    for p in reversed(patterns):
        hit = name.rlike(f"(?i){p}")
        camera = F.when(hit, F.lower(F.regexp_extract(name, f"(?i){p}", 1))).otherwise(camera)
        rig = F.when(hit, F.regexp_replace(F.regexp_replace(name, f"(?i){p}", "_"), r"^[_\-. ]+|[_\-. ]+$", "")).otherwise(rig)
    return rig, camera


def split_time_camera(name: Column, how: str, at: int = 1) -> tuple[Column, Column]:
    """(time, camera) of a stem: by first_char, last_char, prefix, suffix or split.

    prefix and suffix take ``at`` characters; split cuts at ``_`` and takes the
    part at position ``at`` (from the end if negative) as camera.
    """
    if how == "first_char":
        return F.substring(name, 2, 10_000), F.substring(name, 1, 1)
    if how == "last_char":
        return F.substring(name, F.lit(1), F.length(name) - 1), F.substring(name, F.length(name), F.lit(1))
    if how == "prefix":
        return F.substring(name, at + 1, 10_000), F.substring(name, 1, at)
    if how == "suffix":
        return F.substring(name, F.lit(1), F.length(name) - at), F.right(name, F.lit(at))
    if how == "split":
        parts = F.split(name, "_")
        i = F.lit(at) if at >= 0 else F.size(parts) + at
        rest = F.filter(parts, lambda p, k: k != i)
        return F.array_join(rest, "_"), F.get(parts, i)
    raise ValueError(f"no such way to split names: {how}")


def float_list(text: Column) -> Column:
    """Numbers of a blank-separated text; null if any token is none."""
    tokens = F.filter(F.split(text, r"\s+"), lambda t: t != "")
    numbers = F.transform(tokens, lambda t: t.try_cast("double"))
    return F.when(F.forall(numbers, lambda x: x.isNotNull()), numbers)


def matrix_shape(path: Column) -> Column:
    """[A, B] of a file named ``...--AxB.npy``; null for other names."""
    a, b = (F.regexp_extract(path, r"--(\d+)x(\d+)\.npy$", i).try_cast("int") for i in (1, 2))
    return F.when(a.isNotNull() & b.isNotNull(), F.array(a, b))


def padded(left: Column, right: Column) -> Column:
    """Names like 0007_00000042."""
    return F.concat_ws("_", F.lpad(left.cast("string"), 4, "0"), F.lpad(right.cast("string"), 8, "0"))
