"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of documents.  Rows are told apart by
their place in the staged files, not by their ids: repeated and null ids, nulls
in any column, repeated rows and empty tables go through like any others.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orthoscape.llm.exact_dedup import exact_groups
from orthoscape.llm.jaccard_join import jaccard_components
from orthoscape.llm.mixing import mix_sources, output_names
from orthoscape.llm.packing import pack
from orthoscape.llm.quality import quality_score
from orthoscape.llm.staging import Stage, without_rows

WIDTH, PERCENT = 5, 80
#: Target weights of sources; None are those of mix_sources.
WEIGHTS: dict[str, float] | None = None


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; each row is scored by itself."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return docs.filter(quality_score(spark, docs, labels) >= 0.5)


def dedup_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: that with the largest id, the last of those that have it."""
    placed = _with_place(spark, docs)
    return _without(spark, placed, exact_groups(spark, placed, row_col="_place").filter("not kept")).select(*docs.columns)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that with the smallest id, the first of those that have it, of each component of near copies."""
    placed = _with_place(spark, docs)
    found = jaccard_components(spark, placed, row_col="_place", width=WIDTH, percent=PERCENT)
    return _without(spark, placed, found.filter("not first")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix; files and rows follow it."""
    mixed, names = mix_sources(spark, docs, WEIGHTS), output_names(docs.columns)
    return mixed.repartitionByRange(F.col("mix_position")).sortWithinPartitions("mix_position").select(*[F.col(f"`{names[c]}`").alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences, which follow the order of files and rows."""
    return pack(spark, _with_place(spark, docs), order_col="_place")


def _with_place(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """docs with _place, a number that rises with (part of the file's name, row in it)."""
    name = F.col("_metadata.file_name")
    part, split = (F.coalesce(F.regexp_extract(name, r, 1).try_cast("long"), F.lit(0)) for r in (r"^part-(\d+)", r"-c(\d+)\."))
    place = F.shiftleft(part, 43) + F.shiftleft(split, 33) + F.col("_metadata.row_index")
    try:
        return docs.withColumn("_place", place)
    except AnalysisException:  # not read from files
        return Stage(spark, "ordered").write(docs, "docs").withColumn("_place", place)


def _without(spark: SparkSession, placed: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of placed whose places aren't in gone."""
    return without_rows(placed, Stage(spark, "gone").write(gone.select("_place"), "rows"), "_place")


STAGES = [
    ("quality classifier", classify),
    ("exact dedup", dedup_exact),
    ("n-gram Jaccard join", dedup_near),
    ("mixing sources", mix),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each staged as Parquet for the next."""
    stage = Stage(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, f in STAGES:
        docs = stage.write(f(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


#: The classifier and the tokenizer can't be expressed in SQL.
ORACLE_SQL: str | None = None
