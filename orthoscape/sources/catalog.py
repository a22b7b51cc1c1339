"""Scene catalogs: listing, discovery, scene metadata, splits, and the format registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.names import extension, stem

#: Readers and writers by format name: (spark, path) -> DataFrame and (df, path) -> None.
#: json is one document a file and is read only; tables are written as jsonl.
READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "json": lambda s, p: s.read.option("multiLine", "true").json(p),
    "jsonl": lambda s, p: s.read.json(p),
    "parquet": lambda s, p: s.read.parquet(p),
    "orc": lambda s, p: s.read.orc(p),
    "csv": lambda s, p: s.read.option("header", "true").csv(p),
    "text": lambda s, p: s.read.text(p, wholetext=True),
    "binary": lambda s, p: s.read.format("binaryFile").load(p),
}
WRITERS: dict[str, Callable[[DataFrame, str], None]] = {
    "jsonl": lambda d, p: d.write.json(p),
    "parquet": lambda d, p: d.write.parquet(p),
    "orc": lambda d, p: d.write.orc(p),
    "csv": lambda d, p: d.write.option("header", "true").csv(p),
    "text": lambda d, p: d.write.text(p),
}
SUFFIXES = {".json": "json", ".jsonl": "jsonl", ".parquet": "parquet", ".orc": "orc", ".csv": "csv", ".txt": "text", ".npy": "binary", ".png": "binary", ".jpg": "binary", ".exr": "binary", ".pfm": "binary"}


def format_of(path: str, format_type: str | None = None) -> str:
    if format_type:
        if format_type not in READERS:
            raise ValueError(f"unknown format {format_type}")
        return format_type
    for suffix, name in SUFFIXES.items():
        if path.lower().rstrip("/").endswith(suffix):
            return name
    raise ValueError(f"no format known for {path}")


def load(spark: SparkSession, path: str, format_type: str | None = None) -> DataFrame:
    return READERS[format_of(path, format_type)](spark, path)


def store(df: DataFrame, path: str, format_type: str | None = None) -> None:
    name = format_of(path, format_type)
    if name not in WRITERS:
        raise ValueError(f"{name} can't be written")
    WRITERS[name](df, path)


def files_by_stem(paths: DataFrame, by: list[str], path: str, extensions: list[str]) -> DataFrame:
    """(by, stem, path): files with one of the extensions, in any case; of equal stems the later path wins."""
    kept = paths.filter(extension(F.col(path)).isin([e.lower() for e in extensions]))
    return kept.groupBy(*by, stem(F.col(path)).alias("stem")).agg(F.max(path).alias(path))


def complete_scenes(files: DataFrame, kinds: list[str], datasets: list[str] | None = None) -> DataFrame:
    """(dataset, scene) of the wanted datasets with every kind of folder."""
    kept = files.filter(F.col("kind").isin(kinds))
    if datasets is not None:
        kept = kept.filter(F.col("dataset").isin(datasets))
    return kept.groupBy("dataset", "scene").agg(F.count_distinct("kind").alias("n")).filter(F.col("n") == len(kinds)).select("dataset", "scene")


def scene_metadata(frames: DataFrame, by: list[str], name: str, fields: list[str]) -> DataFrame:
    """One row a scene: its frames in name order as structs, and a map from name to position.

    Frames of a scene are one document by contract; scenes are spread.
    """
    ordered = frames.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(name, *fields))).alias("frames"))
    return ordered.withColumn("frame_names", F.map_from_entries(F.transform("frames", lambda f, i: F.struct(f[name], i))))


def frames_of(scenes: DataFrame, by: list[str]) -> DataFrame:
    """The frames of scene documents as rows, with frame_idx."""
    return scenes.select(*by, F.posexplode("frames").alias("frame_idx", "_f")).select(*by, "frame_idx", "_f.*")


def video_frames(chunks: DataFrame, by: list[str], start: str, end: str, fps: str) -> DataFrame:
    """(by, chunk columns, k, t): a frame every 1/fps in [start, end) of each chunk."""
    n = F.ceil((F.col(end) - F.col(start)) * F.col(fps) - 1e-9).cast("int")
    rows = chunks.withColumn("_n", n).filter("_n > 0").withColumn("k", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return rows.withColumn("t", F.col(start) + F.col("k") / F.col(fps)).drop("_n")


def write_splits(splits: DataFrame, path: str) -> None:
    """Scene lists as a table by dataset and split; empty splits write nothing."""
    splits.repartition("dataset", "split").write.partitionBy("dataset", "split").mode("overwrite").parquet(path)


def hfov_json(hfovs: DataFrame) -> DataFrame:
    """(dataset, json): one document a dataset, scenes in order: {"scene": {"hfovs": [..]}}."""
    entry = F.struct("scene", F.struct("hfovs").alias("v"))
    whole = hfovs.groupBy("dataset").agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("m"))
    return whole.select("dataset", F.to_json("m").alias("json"))


def regrouped(files: DataFrame, scene: Column, root: str) -> DataFrame:
    """New paths of files under their new scenes; conflicts (two files for one path) are counted."""
    out = files.withColumn("out_path", F.concat_ws("/", F.lit(root), scene, F.regexp_extract("path", r"([^/]+)$", 1)))
    return out.withColumn("conflicts", F.count(F.lit(1)).over(Window.partitionBy("out_path")) - 1)


def links(pages: DataFrame, html: str, pattern: str) -> DataFrame:
    """(page columns, link): targets of anchors that match a pattern."""
    found = F.regexp_extract_all(F.col(html), F.lit(r'href="([^"]+)"'), F.lit(1))
    return pages.withColumn("link", F.explode(found)).filter(F.col("link").rlike(pattern)).drop(html)


def store_metadata(df: DataFrame, path: str) -> None:
    """Write scene documents stamped with the time, in place of the old ones, of which one backup is kept.

    The new files are written beside the old first, so a failed write leaves
    them as they were.
    """
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    fresh, old, backup = (jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}{s}") for s in ("._new", "", "._backup"))
    fs = old.getFileSystem(conf)
    df.drop("frame_names").withColumn("last_modified", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")).write.mode("overwrite").json(str(fresh.toString()))
    if fs.exists(old):
        fs.delete(backup, True)
        fs.rename(old, backup)
    fs.rename(fresh, old)


def load_metadata(spark: SparkSession, path: str, schema, name: str = "frame_name") -> DataFrame:
    """Scene documents with the map from frame name to position, which isn't stored."""
    docs = spark.read.schema(schema).json(path)
    return docs.withColumn("frame_names", F.map_from_entries(F.transform("frames", lambda f, i: F.struct(f[name], i))))
