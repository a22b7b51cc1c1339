"""Quality classifier: hashed word n-grams, logistic regression trained by follow-the-regularised-leader.

Tokens are runs of letters and digits, or of signs, as written.  Features are
tokens and pairs of neighbours, hashed into 2**18 buckets; a pair of equal
tokens is the one feature "repeat".  A feature's value is its share of the
text's features.  The model is learnt on a bounded sample of labelled rows and
is a table of 2**18 weights whatever the corpus, so it is broadcast; a score
is a sparse dot product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .words import TOKEN, Words, mix, word_chunks

BITS = 18
SCALE = 24.0
MAX_LABELLED = 6000


def held_out(id_col: str, parts: int, which: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder ``which``; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == which, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, parts: int, which: int, most: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, label) of at most about ``most`` labelled rows that aren't held out, chosen by a hash of the id.

    Only the chosen ids and labels, at most about ``most``, are broadcast.
    """
    usable = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id", parts, which)).groupBy("doc_id").agg(F.max(label).cast("int").alias("_label"))
    share = min(1.0, most / max(1, usable.count()))
    chosen = usable.filter(F.pmod(F.xxhash64("doc_id", F.lit(77)), F.lit(1 << 20)) < int(share * (1 << 20)))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen.withColumnRenamed("doc_id", "_id")), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "_label")


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of a chunk's texts, and their offsets by text (tokens, then pairs)."""
    h, n = words.hash, words.counts()
    single = (h >> np.uint64(64 - BITS)).astype(np.int32)
    pair = mix(h[1:] + mix(h[:-1])) >> np.uint64(64 - BITS)
    pair = np.where(h[1:] == h[:-1], np.uint64(1), pair).astype(np.int32)
    total = np.maximum(2 * n - 1, 0)
    offsets = np.concatenate([[0], np.cumsum(total)])
    out = np.zeros(offsets[-1], np.int32)
    doc = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(h)) - words.offsets[:-1][doc]
    out[offsets[doc] + place] = single
    second = np.flatnonzero(place > 0)
    out[offsets[doc[second]] + n[doc[second]] + place[second] - 1] = pair[second - 1]
    return out, offsets


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        label = batch.column(2).to_pylist()
        key = batch.column(0).to_pylist()
        for words in word_chunks(batch.column(1), classes=TOKEN):
            f, offsets = features(words)
            at, counts = [], []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                i, c = np.unique(f[a:b], return_counts=True)
                at.append(i.astype("<i4").tobytes())
                counts.append((c * (SCALE / max(1, b - a))).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(key[words.lo : words.hi], pa.int64()), pa.array(label[words.lo : words.hi], pa.int32()), pa.array(at, pa.binary()), pa.array(counts, pa.binary())], ["doc_id", "label", "at", "value"])


class Ftrl:
    """Logistic regression under per-coordinate follow-the-regularised-leader updates."""

    def __init__(self, size: int, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        shrunk = np.sign(z) * self.l1 - z
        return np.where(np.abs(z) <= self.l1, 0.0, shrunk / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        """One example; the last coordinate is the constant."""
        at, value = np.append(at, len(self.z) - 1), np.append(value, 1.0)
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ value, -30, 30)))
        g = (p - label) * value
        step = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - step * w
        self.n[at] += g * g

    def table(self) -> np.ndarray:
        return self.weights(np.arange(len(self.z))).astype(np.float32)


def train(sample: DataFrame, epochs: int = 3) -> np.ndarray:
    """Weights from a bounded sample (doc_id, text, _label); all zero without rows."""
    rows = sample.mapInArrow(_extract, "doc_id long, label int, at binary, value binary").toPandas()
    model = Ftrl(1 << BITS)
    rows = rows.sort_values("doc_id")
    order = np.random.Generator(np.random.PCG64(5))
    cases = [(np.frombuffer(a, "<i4"), np.frombuffer(v, "<f4").astype(float), int(y)) for a, v, y in zip(rows["at"], rows["value"], rows["label"], strict=True)]
    for _ in range(epochs):
        for i in order.permutation(len(cases)):
            model.learn(*cases[i])
    del rows, cases
    pa.default_memory_pool().release_unused()
    return model.table()


def scores(weights, column: pa.Array) -> np.ndarray:
    """Scores of a column of texts, by sparse dot products with the broadcast weights."""
    table, out = weights.value, [np.zeros(0)]
    for words in word_chunks(column, classes=TOKEN):
        f, offsets = features(words)
        total = np.concatenate([[0.0], np.cumsum(table[f], dtype=np.float64)])
        n = np.diff(offsets)
        margin = (total[offsets[1:]] - total[offsets[:-1]]) * (SCALE / np.maximum(n, 1)) + float(table[-1])
        out.append(1 / (1 + np.exp(-np.clip(margin, -30, 30))))
    return np.concatenate(out)


def quality_score(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MAX_LABELLED) -> Column:
    """The score (0 to 1) of each row of docs as a column, learnt as in ``quality_scores``: rows need no join with it."""
    weights = spark.sparkContext.broadcast(train(labelled_sample(docs, labels, "quality", 3, 1, most, id_col, text_col)))
    return F.arrow_udf(lambda text: pa.array(scores(weights, text)), "double")(F.col(text_col))


def quality_scores(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MAX_LABELLED) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.5), one row a document, in whole texts.

    Learns labels.quality from rows that aren't held out (crc32 of the id mod
    3 is 1), of which at most about ``most`` are used.  A null text counts as
    empty, and an empty text scores by the model's constant.  Without usable
    labels every score is 0.5.  Repeated rows score alike; other columns are
    ignored; an empty table gives no rows.
    """
    score = quality_score(spark, docs, labels, id_col, text_col, most)
    scored = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col, 3, 1).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
