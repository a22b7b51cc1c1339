"""Text sources and sinks: camera files, COLMAP text, tables with a header, calibration JSON.

Each parser maps a column of whole file contents to columns, so files come from
any folder that Spark can list: ``spark.read.text(path, wholetext=True)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.camera import hfov, inverse_rigid
from ..functions.names import float_list, stem

NUMBER = "%.12f"


def whole_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(path, stem, value) of files in a folder tree, one row a file."""
    text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(path, wholetext=True)
    return text.select(F.col("_metadata.file_path").alias("path"), stem(F.col("_metadata.file_path")).alias("stem"), "value")


def _let(x: Column, use) -> Column:
    return F.element_at(F.transform(F.array(x), use), 1)


def camera_file(text: Column) -> Column:
    """struct<ok, extrinsic(16), pose(16), k(9), h, w, fov> of a camera file; ok is false for malformed ones.

    Headers match by a case-insensitive prefix and the last one wins.  Four
    rows of four or more numbers must follow ``extrinsic``, three of three or
    more ``intrinsic``; the size is on the first line of three or more numbers
    from the fourth line after ``intrinsic``.
    """
    lines = F.transform(F.split(text, r"\r?\n"), lambda x: F.trim(x))

    def parse(ls: Column) -> Column:
        def header(name: str) -> Column:
            hits = F.filter(F.transform(ls, lambda x, i: F.when(F.lower(x).startswith(name), i)), lambda i: i.isNotNull())
            return F.element_at(F.when(F.size(hits) > 0, hits), -1)

        def rows(at: Column, n: int, width: int) -> Column:
            got = F.transform(F.slice(ls, at + 2, n), lambda x: F.slice(float_list(x), 1, width))
            good = (F.size(got) == n) & F.forall(got, lambda r: F.coalesce(F.size(r) == width, F.lit(False)))
            return F.when(good, F.flatten(got))

        def read(e: Column, k: Column) -> Column:
            later = F.filter(F.transform(F.slice(ls, k + 5, 10), float_list), lambda r: F.coalesce(F.size(r) >= 3, F.lit(False)))
            size = F.when(F.size(later) > 0, F.get(later, F.lit(0)))
            return F.struct(rows(e, 4, 4).alias("e"), rows(k, 3, 3).alias("k"), size.alias("s"))

        return read(header("extrinsic"), header("intrinsic"))

    def finish(p: Column) -> Column:
        e, k, s = p["e"], p["k"], p["s"]
        ok = F.coalesce(e.isNotNull() & k.isNotNull() & (F.get(s, F.lit(0)) > 0) & (F.get(s, F.lit(1)) > 0), F.lit(False))
        return F.struct(ok.alias("ok"), F.when(ok, e).alias("extrinsic"), F.when(ok, inverse_rigid(e)).alias("pose"), F.when(ok, k).alias("k"), F.when(ok, F.get(s, F.lit(0)).cast("int")).alias("h"), F.when(ok, F.get(s, F.lit(1)).cast("int")).alias("w"), F.when(ok, F.get(s, F.lit(2))).alias("fov"))

    return _let(_let(lines, parse), finish)


def quick_hfov(text: Column) -> Column:
    """Whole degrees of the horizontal field of view from K and the width; twice cx where no width is given."""
    c = camera_file(text)
    k = F.regexp_extract(text, r"(?is).*intrinsic[^\n]*\n([^\n]*)", 1)
    n = float_list(k)
    width = F.coalesce(c["w"].cast("double"), 2 * F.get(n, F.lit(2)))
    return F.bround(hfov(width, F.get(n, F.lit(0))), 0).cast("int")


def format_camera(extrinsic: Column, k: Column, h: Column, w: Column, fov: Column) -> Column:
    """The text of a camera file: 12 decimals, and a ``h w fov`` trailer."""

    def lines(m: Column, rows: int, width: int) -> list[Column]:
        return [F.array_join(F.transform(F.slice(m, i * width + 1, width), lambda v: F.format_string(NUMBER, v)), " ") for i in range(rows)]

    return F.concat_ws("\n", F.lit("extrinsic opencv(world2camera)"), *lines(extrinsic, 4, 4), F.lit(""), F.lit("intrinsic"), *lines(k, 3, 3), F.lit(""), F.lit("h w fov"), F.concat_ws(" ", h.cast("string"), w.cast("string"), F.format_string(NUMBER, fov)), F.lit(""))


def colmap_cameras(df: DataFrame, text: str) -> DataFrame:
    """(camera_id, model, width, height, params) of a cameras file."""
    line = df.select(F.explode(F.split(text, "\n")).alias("l")).filter(~F.col("l").startswith("#") & (F.trim("l") != ""))
    p = F.split(F.trim("l"), r"\s+")
    return line.select(F.get(p, F.lit(0)).cast("int").alias("camera_id"), F.get(p, F.lit(1)).alias("model"), F.get(p, F.lit(2)).cast("int").alias("width"), F.get(p, F.lit(3)).cast("int").alias("height"), F.transform(F.slice(p, 5, 100), lambda v: v.cast("double")).alias("params"))


def colmap_images(df: DataFrame, text: str) -> DataFrame:
    """(image_id, qw..qz, tx..tz, camera_id, name) of an images file: the first of each two lines; names may have blanks."""
    lines = F.filter(F.split(text, "\n"), lambda l: ~l.startswith("#"))
    line = df.select(F.posexplode(lines).alias("i", "l")).filter((F.col("i") % 2 == 0) & (F.trim("l") != ""))
    p = F.split(F.trim("l"), r"\s+", 10)
    names = ("qw", "qx", "qy", "qz", "tx", "ty", "tz")
    return line.select(F.get(p, F.lit(0)).cast("int").alias("image_id"), *[F.get(p, F.lit(i + 1)).cast("double").alias(n) for i, n in enumerate(names)], F.get(p, F.lit(8)).cast("int").alias("camera_id"), F.get(p, F.lit(9)).alias("name"))


def headed_table(df: DataFrame, text: str) -> DataFrame:
    """(row, values): maps of a blank-separated table under a ``# label ...`` header; rows of another arity are left out."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda l: F.trim(l)), lambda l: l != "")
    head = F.split(F.trim(F.regexp_replace(F.get(F.filter(lines, lambda l: l.startswith("#")), F.lit(0)), "^#+", "")), r"\s+")
    body = F.filter(lines, lambda l: ~l.startswith("#"))
    rows = df.select(head.alias("head"), F.posexplode(body).alias("row", "l")).withColumn("p", F.split("l", r"\s+"))
    return rows.filter(F.size("p") == F.size("head")).select("row", F.map_from_arrays("head", "p").alias("values"))


def calibration(df: DataFrame, text: str) -> DataFrame:
    """(name, fx, fy, cx, cy) of a JSON list of camera calibrations."""
    schema = "array<struct<name:string,fx:double,fy:double,cx:double,cy:double>>"
    return df.select(F.inline(F.from_json(text, schema)))


def process_log(text: Column) -> Column:
    """Map of process to struct<state>; empty for missing or corrupt logs."""
    kind = "map<string,struct<state:string>>"
    return F.coalesce(F.from_json(text, kind, {"mode": "PERMISSIVE"}), F.from_json(F.lit("{}"), kind))
