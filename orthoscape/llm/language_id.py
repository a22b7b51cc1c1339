"""Language identification by a convolutional network over bytes, in numpy.

A text is cut into windows of ``WINDOW`` bytes, all of them scored in batches.
Filters of 2, 3 and 4 bytes slide over a window, each filter keeps its maximum
(max pooling), and a linear layer with softmax gives the languages.  Bytes are
mapped to classes first (ASCII letters without case, digits, space, signs, and
each byte over 0x7F); a filter is a table of weights by place and class, so a
convolution is a sum of table rows, and rows of neighbouring pairs are added up
beforehand.  A text's scores are the mean log-probabilities of its windows,
weighted by their letters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .quality import held_out
from .words import utf8

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 12
MAX_LABELLED = 3000
AT_ONCE = 256

CLASS = np.zeros(256, np.uint8)
CLASS[[0x20, 9, 10, 11, 12, 13]] = 1
CLASS[33:127] = 2
CLASS[48:58] = 3
CLASS[65:91] = np.arange(4, 30)
CLASS[97:123] = np.arange(4, 30)
CLASS[128:192] = np.arange(30, 94)
CLASS[192:256] = np.arange(94, 158)
CLASSES = 158


def windows(data: np.ndarray, bounds: np.ndarray, at_once: int = AT_ONCE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All windows of the texts as rows of classes (0 past the end), with the text of each, at_once at a time.

    What is held is one block of windows, however long the texts are.
    """
    block, doc, n = np.zeros((at_once, WINDOW), np.uint8), np.zeros(at_once, np.int64), 0
    for d, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        while a < b:
            end = min(b, a + (at_once - n) * WINDOW)
            k = -(-(end - a) // WINDOW)
            flat = block[n : n + k].reshape(-1)
            flat[: end - a] = CLASS[data[a:end]]
            flat[end - a :] = 0
            doc[n : n + k] = d
            n, a = n + k, end
            if n == at_once:
                yield block, doc
                n = 0
    if n:
        yield block[:n], doc[:n]


class ByteCnn:
    def __init__(self, languages: list[str], seed: int = 3):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.languages = languages
        self.conv = [rng.normal(0, 0.3, (w, CLASSES, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(FILTERS * len(WIDTHS), np.float32)
        self.out = rng.normal(0, 0.2, (FILTERS * len(WIDTHS), len(languages))).astype(np.float32)
        self.base = np.zeros(len(languages), np.float32)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows by pair: the first two places of all widths; by class: the third; by pair: the last two of width 4."""
        head = [(c[0][:, None] + c[1][None]).reshape(CLASSES**2, FILTERS) for c in self.conv]
        tail = (self.conv[2][2][:, None] + self.conv[2][3][None]).reshape(CLASSES**2, FILTERS)
        return np.concatenate(head, 1), self.conv[1][2], tail

    def pooled(self, x: np.ndarray, tables: tuple, argmax: bool = False):
        pair = x[:, :-1].astype(np.int32) * CLASSES + x[:, 1:]
        head, third, tail = tables
        h = head[pair]
        best = [h[:, :, :FILTERS], h[:, :-1, FILTERS : 2 * FILTERS] + third[x[:, 2:]], h[:, :-2, 2 * FILTERS :] + tail[pair[:, 2:]]]
        top = np.concatenate([b.max(1) for b in best], 1) + self.bias
        return (top, [b.argmax(1) for b in best]) if argmax else top

    def log_prob(self, top: np.ndarray) -> np.ndarray:
        z = np.maximum(top, 0) @ self.out + self.base
        z = z - z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 3, batch: int = 128, rate: float = 0.01) -> None:
        """Softmax cross-entropy by Adam; only the pooled places get gradients."""
        params = [*self.conv, self.bias, self.out, self.base]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        order, step = np.random.Generator(np.random.PCG64(11)), 0
        for _ in range(epochs):
            for own in np.array_split(order.permutation(len(x)), max(1, len(x) // batch)):
                if not len(own):
                    continue
                xb, yb = x[own], y[own]
                top, where = self.pooled(xb, self.tables(), argmax=True)
                z = np.exp(self.log_prob(top))
                z[np.arange(len(yb)), yb] -= 1
                z /= len(yb)
                live = np.maximum(top, 0)
                back = (z @ self.out.T) * (top > 0)
                grads = [np.zeros_like(c) for c in self.conv]
                for k, (w, at) in enumerate(zip(WIDTHS, where, strict=True)):
                    g = back[:, k * FILTERS : (k + 1) * FILTERS]
                    rows, filters = np.arange(len(yb))[:, None], np.arange(FILTERS)[None, :]
                    for j in range(w):
                        np.add.at(grads[k][j], (xb[rows, at + j], np.broadcast_to(filters, at.shape)), g)
                grads += [back.sum(0), live.T @ z, z.sum(0)]
                step += 1
                for p, g, m, v in zip(params, grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)


def _sample_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All windows of each training text, in its order, as one row."""
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        rows: list[list[bytes]] = [[] for _ in range(batch.num_rows)]
        for x, doc in windows(data, offsets):
            for d in np.unique(doc).tolist():
                rows[d].append(x[doc == d].tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([b"".join(r) for r in rows], pa.binary()), batch.column(2)], ["doc_id", "x", "lang"])


def train(docs: DataFrame, most: int, id_col: str, text_col: str, lang_col: str) -> ByteCnn | None:
    """A network from about ``most`` labelled texts at most, chosen by a hash of the id; None without any."""
    usable = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}") & ~held_out(id_col, 4, 2))
    labelled = docs.filter(F.col(lang_col).isNotNull()).count()
    share = min(1.0, most / max(1, labelled))
    chosen = usable.filter(F.pmod(F.xxhash64(id_col, F.lit(31)), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = chosen.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).mapInArrow(_sample_windows, "doc_id long, x binary, lang string").toPandas()
    if not len(rows):
        return None
    rows = rows.sort_values(["doc_id", "lang", "x"])
    languages = sorted(rows["lang"].unique())
    net = ByteCnn(languages)
    x = np.frombuffer(b"".join(rows["x"]), np.uint8).reshape(-1, WINDOW)
    label = rows["lang"].map({v: i for i, v in enumerate(languages)}).to_numpy()
    net.train(x, np.repeat(label, [len(v) // WINDOW for v in rows["x"]]))
    return net


def _classifier(shared):
    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        tables = net.tables() if net else None
        for batch in batches:
            n, letters = batch.num_rows, np.array(batch.column(2).to_pylist(), bool)
            if net is None:
                names, scores = ["und"] * n, np.zeros(n)
            else:
                total, mass = np.zeros((n, len(net.languages))), np.zeros(n)
                data, offsets = utf8(batch.column(3))
                for x, doc in windows(data, offsets):
                    weight = (x >= 4).sum(1)
                    np.add.at(total, doc, net.log_prob(net.pooled(x, tables)) * weight[:, None])
                    np.add.at(mass, doc, weight)
                mean = total / np.maximum(mass, 1)[:, None]
                p = np.exp(mean - mean.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                names = [net.languages[k] if known else "und" for k, known in zip(p.argmax(1).tolist(), letters.tolist(), strict=True)]
                scores = np.where(letters, p.max(1, initial=0), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return classify


def identify(spark: SparkSession, docs: DataFrame, most: int = MAX_LABELLED, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score, one row a document, from whole texts.

    Learns from rows whose crc32 of the id mod 4 isn't 2 and whose language
    isn't null, about ``most`` of them at most, each with all its windows.  A null text or one without a
    letter is ``und`` with score 0, as is every text if nothing can be learnt.
    Ties go to the first language in order; repeated rows score alike; other
    columns are ignored; an empty table gives no rows.
    """
    net = spark.sparkContext.broadcast(train(docs, most, id_col, text_col, lang_col))
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col, 4, 2).alias("held_out"), letters.alias("letters"), F.col(text_col).alias("text"))
    return base.mapInArrow(_classifier(net), "doc_id long, held_out boolean, lang_pred string, score double")
