"""Toxicity on restored text: noisy-channel decoding, then a word model.

A disguised stretch is a lattice of letters: a sign or digit may stand for some
letters, a repeated letter for fewer, a separator for none, a blank between
single letters for none or for a border of words.  Viterbi decoding under a
character trigram model picks the likeliest words.  A token whose lattice has
one path is its own decoding; all others are decoded, each distinct one once a
task.  The trigrams are counted over all words of all documents.  Scores are
logistic regressions on the distinct words of the restored text and their
stems, trained by follow-the-regularised-leader on a bounded sample of labelled
rows.
"""

from __future__ import annotations

import collections
import math
import re
import unicodedata
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .quality import Ftrl, held_out, labelled_sample
from .words import CHUNK_BYTES, WORD, Words, mix, word_chunks

BITS = 20
MAX_LABELLED = 6000
THRESHOLD = 0.3
CACHED = 200_000
#: Cost of a letter that repeats the one before and isn't meant.
SQUEEZED = 0.3
#: Letters of a stem: words that begin alike share a feature.
STEM = 5

# Letters that a sign or digit is written for.
LOOKALIKE = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t"}
SEPARATORS = ".-_* "
#: Accented Latin letters in lower case, and the plain ones that they are read as.
_BASE = {chr(c): unicodedata.normalize("NFD", chr(c))[0] for c in range(0xDF, 0x180) if chr(c).islower()} | {"ß": "s", "ø": "o"}
ACCENTED, PLAIN = ("".join(x) for x in zip(*((c, p) for c, p in _BASE.items() if p.isascii()), strict=True))
_FOLD = str.maketrans(ACCENTED, PLAIN)
#: The letter for those outside the alphabets that are told apart.
OTHER = "\u0294"
_ALPHABETS = r"a-z\u0370-\u052F"

_REPEATED = re.compile(r"(.)\1+", re.DOTALL)

LETTER = np.zeros(256, np.uint8)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
#: Bytes of tokens: 1 letters, 2 look-alikes, 3 separators, 0 what else.
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[[ord(c) for c in LOOKALIKE]] = 2
_KIND[[ord(c) for c in SEPARATORS.strip()]] = 3


def _known(c: str) -> bool:
    return "a" <= c <= "z" or "\u0370" <= c <= "\u052f"


def folded(text: str) -> str:
    """Lower case without accents; letters of other alphabets become one sign."""
    out = text.lower().translate(_FOLD)
    return out if out.isascii() else "".join(c if not c.isalpha() or _known(c) else OTHER for c in out)


class CharModel:
    """Character trigrams of folded words, with add-one smoothing over bigrams."""

    def __init__(self, counts: dict[str, int]):
        tri: dict[str, float] = {}
        for word, n in counts.items():
            padded = f"^^{folded(word)}$"
            for i in range(len(padded) - 2):
                tri[padded[i : i + 3]] = tri.get(padded[i : i + 3], 0) + n
        self._fit(tri)

    @classmethod
    def of_trigrams(cls, tri: dict[str, int]) -> CharModel:
        """A model of counted trigrams of words, each padded as ``^^word$``."""
        model = cls({})
        model._fit(tri)
        return model

    def _fit(self, tri: dict[str, float]) -> None:
        context: dict[str, float] = {}
        for gram, n in tri.items():
            context[gram[:2]] = context.get(gram[:2], 0) + n
        self.cost = {g: math.log((n + 0.1) / (context[g[:2]] + 2.7)) for g, n in tri.items()}
        self.rare = {c: math.log(0.1 / (n + 2.7)) for c, n in context.items()}

    def log_prob(self, context: str, letter: str) -> float:
        found = self.cost.get(context + letter)
        return found if found is not None else self.rare.get(context, -3.3)

    def word(self, word: str) -> float:
        """The log-probability of a whole word."""
        padded, total, cost = f"^^{word}$", 0.0, self.cost
        for i in range(len(padded) - 2):
            found = cost.get(padded[i : i + 3])
            total += found if found is not None else self.rare.get(padded[i : i + 2], -3.3)
        return total

    def doubled(self, word: str, at: int) -> bool:
        """Whether a word is likelier with its letter ``at`` twice, as it stands, than once: only trigrams there differ."""
        w, i = f"^^{word}$", at + 2
        twice = [w[i - 1 : i + 2], w[i : i + 3], w[i + 1 : i + 4]]
        once = [w[i - 1 : i + 1] + w[i + 2], w[i] + w[i + 2 : i + 4]]
        cost, rare, total = self.cost, self.rare, SQUEEZED
        for grams, sign in ((twice, 1), (once, -1)):
            for g in grams:
                if len(g) == 3:
                    found = cost.get(g)
                    total += sign * (found if found is not None else rare.get(g[:2], -3.3))
        return total >= 0


def _options(text: str, i: int, squeeze: bool) -> list[tuple[str, float]]:
    """Letters that the i-th sign can stand for, each with its channel log-probability; a blank is a border of words."""
    c = text[i]
    if c.isalpha():
        out = [(c, 0.0)]
        if squeeze and i and text[i - 1] == c:
            out.append(("", -SQUEEZED))
        return out
    if c == " ":
        return [("", -0.2), (" ", -0.2)]
    if c in LOOKALIKE:
        out = [(x, -0.5 - 0.3 * k) for k, x in enumerate(LOOKALIKE[c])]
        if squeeze and i and text[i - 1] == c:
            out.append(("", -SQUEEZED))
        out.append(("", -6.0))
        return out
    return [("", -0.2 if c in SEPARATORS else -4.0)]


def _squeezed(word: str, most: int = 16) -> list[str]:
    """All spellings of a word of letters with repeated ones left out; none if there are over ``most``."""
    out = [word]
    for m in reversed(list(_REPEATED.finditer(word))):
        a, b = m.span()
        out = [w[:a] + w[a + k :] for w in out for k in range(b - a)]
        if len(out) > most:
            return []
    return out


def decode(token: str, model: CharModel, squeeze: bool = True) -> str:
    """The likeliest words for a token of any length, by Viterbi; states are the last two letters of a word.

    Each step holds its states only, with pointers back, so time and memory
    grow with the length.  Without ``squeeze`` repeated letters stay, as
    doubled ones are common.
    """
    text = folded(token)
    if text.isalpha():
        if not squeeze:
            return text
        if few := _squeezed(text):
            if len(few) == 2:
                at = _REPEATED.search(text).start()
                return few[0] if model.doubled(text, at) else few[1]
            return max(few, key=lambda w: model.word(w) + SQUEEZED * len(w)) if len(few) > 1 else text
    best: dict[str, tuple[float, tuple | None]] = {"^^": (0.0, None)}
    for i in range(len(text)):
        ahead: dict[str, tuple[float, tuple | None]] = {}
        for letter, channel in _options(text, i, squeeze):
            for state, (score, path) in best.items():
                if letter == " ":
                    if state == "^^":
                        continue
                    to, total, made = "^^", score + channel + model.log_prob(state, "$"), (path, " ")
                elif letter:
                    to, total, made = state[1] + letter, score + channel + model.log_prob(state, letter), (path, letter)
                else:
                    to, total, made = state, score + channel, path
                if to not in ahead or total > ahead[to][0]:
                    ahead[to] = (total, made)
        best = ahead
    path = max(((s + model.log_prob(state, "$"), i, p) for i, (state, (s, p)) in enumerate(best.items())), key=lambda x: (x[0], -x[1]), default=(0.0, 0, None))[2]
    out: list[str] = []
    while path is not None:
        path, letter = path
        out.append(letter)
    return "".join(reversed(out)).strip()


def _disguised(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of stretches whose lattice has more than one path.

    These are tokens with a letter and a look-alike, a separator or a repeated
    letter, tokens of three look-alikes or more that aren't numbers, and runs of two or more tokens
    of one sign each.
    """
    data, kind = words.data, _KIND[words.data]
    letters, alike, signs, doubled, digits = np.zeros((5, len(data) + 1), np.int32)
    np.cumsum(kind == 1, out=letters[1:])
    np.cumsum((data >= 48) & (data <= 57), out=digits[1:])
    np.cumsum(kind == 2, out=alike[1:])
    np.cumsum(kind == 3, out=signs[1:])
    if len(data) > 1:
        np.cumsum(((data[1:] | 32) == (data[:-1] | 32)) & (kind[1:] == 1) & (kind[:-1] == 1), out=doubled[2:])
    a, b = words.start, words.end
    n, m, inner = letters[b] - letters[a], alike[b] - alike[a], np.zeros(len(a), np.int64)
    strong = np.flatnonzero((kind == 1) | (kind == 2))
    some = np.flatnonzero(signs[b] > signs[a])
    if len(some) and len(strong):  # signs at the ends of a token are punctuation
        i, j = np.searchsorted(strong, a[some]), np.searchsorted(strong, b[some])
        some, i, j = some[i < j], i[i < j], j[i < j]
        inner[some] = signs[strong[j - 1]] - signs[strong[i]]
    twice = doubled[b] - doubled[np.minimum(a + 1, b)]
    index = np.flatnonzero(((n > 0) & ((m > 0) | (inner > 0) | (twice > 0))) | ((m > 2) & (n == 0) & (digits[b] - digits[a] < m)))
    start, end = a[index], b[index]
    single = (b - a == 1) & (kind[a] > 0) & (kind[a] < 3) if len(a) else np.zeros(0, bool)
    near = np.zeros(len(single), bool)
    near[1:] = single[1:] & single[:-1] & (a[1:] - b[:-1] == 1)
    doc = np.searchsorted(words.offsets, np.arange(len(single)), "right") - 1
    near[1:] &= doc[1:] == doc[:-1]
    edge = np.diff(np.concatenate([[0], near.astype(np.int8), [0]]))
    lo, hi = np.flatnonzero(edge == 1) - 1, np.flatnonzero(edge == -1) - 1
    start = np.concatenate([start, a[lo]])
    end = np.concatenate([end, b[hi]])
    return start, end, np.searchsorted(words.bounds, start, "right") - 1


def _stems(letters: Words) -> np.ndarray:
    """Hashes of the first STEM letters of each longer run of letters; of shorter ones their own."""
    start, end = letters.start, letters.end
    out = letters.hash.copy()
    long = np.flatnonzero(end - start > STEM)
    if len(long):
        spelled = np.zeros(len(long), np.uint64)
        for j in range(STEM):
            c = letters.data[start[long] + j]
            c = np.where((c >= 65) & (c <= 90), c + 32, c)
            spelled = mix(spelled + c.astype(np.uint64) + np.uint64(1))
        out[long] = spelled
    return out


def _distinct(x: np.ndarray) -> np.ndarray:
    x.sort()
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


class Restorer:
    """Hashes of the distinct words of restored texts, and of their stems."""

    def __init__(self, model: CharModel):
        self.model, self.known = model, {}

    def _restored(self, raw: bytes) -> set[str]:
        """Readings of a stretch: with repeated letters squeezed or not, with one or two signs at its end as letters or as punctuation."""
        token = raw.decode("utf-8", "replace")
        plain = token.rstrip("!$|+.-_*,;:?\"')").lstrip("+.-_*,;:?\"'(|")
        tail = token[token.rfind(plain) + len(plain) :].rstrip(".-_*,;:?\"')") if plain else token
        meant = bool(tail) and (len(tail) < 3 or not plain)
        if not meant and plain.isalpha():
            made = decode(plain, self.model)
            return set() if made == plain.lower() else {made}  # as it stands, it is a word of the text already
        out = set()
        for x in {plain, token} if meant else {plain}:
            out.add(decode(x, self.model))
            if not x.isalpha():  # letters alone are their own reading
                out.add(decode(x, self.model, False))
        return out

    def _learn(self, raws: list[bytes]) -> None:
        """Decode new stretches, and hash the words of all of them at once."""
        if len(self.known) + len(raws) > CACHED:
            self.known.clear()
        spelled, owner = [], []
        for raw in raws:
            for x in self._restored(raw):
                spelled.append(x)
                owner.append(raw)
        found: dict[bytes, set[int]] = {raw: set() for raw in raws}
        for words in word_chunks(pa.array(spelled, pa.string()), lower=True, classes=LETTER):
            hashes, stems, o = words.hash.tolist(), _stems(words).tolist(), words.offsets.tolist()
            for d in range(words.hi - words.lo):
                found[owner[words.lo + d]].update(hashes[o[d] : o[d + 1]], stems[o[d] : o[d + 1]])
        self.known.update((raw, tuple(h)) for raw, h in found.items())

    def __call__(self, column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
        for words in word_chunks(column, classes=WORD):
            letters = Words(words.lo, words.hi, words.data, words.bounds, True, LETTER)
            stems = _stems(letters)
            extra: dict[int, set[int]] = {}
            start, end, doc = _disguised(words)
            data = words.data.tobytes() if len(start) else b""
            raws = [data[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
            known = self.known
            if new := list(dict.fromkeys(r for r in raws if r not in known)):
                if len(known) + len(new) > CACHED:
                    new = list(dict.fromkeys(raws))
                self._learn(new)
            for raw, d in zip(raws, doc.tolist(), strict=True):
                extra.setdefault(d, set()).update(known[raw])
            o = letters.offsets
            yield words.lo, [_distinct(np.concatenate([letters.hash[o[d] : o[d + 1]], stems[o[d] : o[d + 1]], np.fromiter(extra.get(d, ()), np.uint64)])) for d in range(words.hi - words.lo)]


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


_restorers: dict[str, Restorer] = {}


def _restorer(shared, name: str) -> Restorer:
    """The process's restorer of a broadcast model, kept from task to task."""
    if name not in _restorers:
        _restorers.clear()
        _restorers[name] = Restorer(shared.value)
    return _restorers[name]


def _extractor(shared):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(shared.value)
        for batch in batches:
            for lo, texts in restore(batch.column(1)):
                rows = [np.unique(_buckets(h)).astype("<i4").tobytes() for h in texts]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(rows)), batch.column(2).slice(lo, len(rows)), pa.array(rows, pa.binary())], ["doc_id", "label", "at"])

    return extract


def _classes() -> np.ndarray:
    """Class of each code point: 1-26 letters as folded, 27 other letters, 30 and up the other alphabets', 29 digits, 0 the rest."""
    out = np.zeros(0x10000, np.int32)
    for c in range(0x10000):
        sign = folded(chr(c))[:1]
        if "a" <= sign <= "z":
            out[c] = ord(sign) - 96
        elif sign.isalpha():
            out[c] = ord(sign) - 0x370 + 30 if _known(sign) else 27
        elif sign.isalnum():
            out[c] = 29
    return out


_CLASSES = _classes()
_START, _END, _FEW = 28, 29, 30


def _letter(c: int) -> str:
    return OTHER if c == 27 else chr(c + 96) if c < 27 else "^" if c == _START else chr(c - 30 + 0x370)


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the trigrams of a task's words: runs of letters and digits without a digit, folded, as ``^^word$``."""
    few, more = np.zeros(_FEW**3, np.int64), collections.Counter()
    for batch in batches:
        texts = batch.column(0).to_pylist()
        size = np.cumsum([len(t or "") for t in texts])
        for group in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(size // CHUNK_BYTES)) + 1):
            points = np.frombuffer(" ".join(texts[i] or "" for i in group).encode("utf-32-le", "replace"), np.uint32)
            kind = np.concatenate([[0, 0], np.where(points < 0x10000, _CLASSES[np.minimum(points, 0xFFFF)], 27), [0]]).astype(np.int32)
            run = kind > 0
            number = np.cumsum(run[1:] & ~run[:-1])
            digit = np.bincount(number[kind[1:] == 29], minlength=number[-1] + 1) > 0
            kind[1:][digit[number]] = 0
            x, before, first = kind[2:], kind[1:-1], kind[:-2]
            p1 = np.where(before > 0, before, _START)
            p2 = np.where((before > 0) & (first > 0), first, _START)
            for at, last in ((np.flatnonzero(x > 0), x), (np.flatnonzero((x == 0) & (before > 0)), np.full(len(x), _END, np.int32))):
                a, b, c = p2[at], p1[at], last[at]
                plain = np.maximum(np.maximum(a, b), c) < _FEW
                few += np.bincount((a[plain] * _FEW + b[plain]) * _FEW + c[plain], minlength=_FEW**3)
                codes, counts = np.unique((a[~plain] * 512 + b[~plain]).astype(np.int64) * 512 + c[~plain], return_counts=True)
                more.update(dict(zip(codes.tolist(), counts.tolist(), strict=True)))
    spelled = {(i // _FEW**2, i // _FEW % _FEW, i % _FEW): int(few[i]) for i in np.flatnonzero(few).tolist()}
    spelled |= {(i >> 18, i >> 9 & 511, i & 511): n for i, n in more.items()}
    if spelled:
        grams = [_letter(a) + _letter(b) + ("$" if c == _END else _letter(c)) for a, b, c in spelled]
        yield pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), pa.array(list(spelled.values()), pa.int64())], ["g", "n"])


def char_model(docs: DataFrame, text_col: str = "text") -> CharModel:
    """A model of all words of docs; what tasks send and the driver collects is bounded by the alphabets."""
    grams = docs.select(text_col).mapInArrow(_trigrams, "g string, n long")
    return CharModel.of_trigrams({r[0]: r[1] for r in grams.groupBy("g").agg(F.sum("n")).collect()})


def train(spark: SparkSession, docs: DataFrame, sample: DataFrame, text_col: str = "text", epochs: int = 4):
    """(broadcast character model of all docs, word weights from a bounded labelled sample)."""
    shared = spark.sparkContext.broadcast(char_model(docs, text_col))
    rows = sample.mapInArrow(_extractor(shared), "doc_id long, label int, at binary").toPandas().sort_values("doc_id")
    model = Ftrl(1 << BITS, alpha=0.3, l1=5.0, l2=0.1)
    cases = [(np.frombuffer(a, "<i4").astype(np.int64), int(y)) for a, y in zip(rows["at"], rows["label"], strict=True)]
    order = np.random.Generator(np.random.PCG64(23))
    for _ in range(epochs):
        for i in order.permutation(len(cases)):
            model.learn(cases[i][0], np.ones(len(cases[i][0])), cases[i][1])
    return shared, model.table()


def _scorer(shared, weights):
    name = uuid.uuid4().hex

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore, table = _restorer(shared, name), weights.value
        for batch in batches:
            out: list[float] = []
            for _, texts in restore(batch.column(2)):
                margin = np.array([float(table[_buckets(h)].sum()) for h in texts]) + float(table[-1])
                out.extend(1 / (1 + np.exp(-np.clip(margin, -30, 30))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.float64())], ["doc_id", "held_out", "score"])

    return score


def toxicity_scores(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MAX_LABELLED) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 if score >= 0.3), one row a document, in whole texts.

    Learns labels.toxic from rows that aren't held out (crc32 of the id mod 4
    is 2), about ``most`` of them at most, and letters from all docs.  A null text counts as empty; an
    empty text scores by the model's constant.  Without usable labels every
    score is 0.5.  Repeated rows score alike; other columns are ignored; an
    empty table gives no rows.
    """
    shared, table = train(spark, docs, labelled_sample(docs, labels, "toxic", 4, 2, most, id_col, text_col), text_col)
    weights = spark.sparkContext.broadcast(table)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col, 4, 2).alias("held_out"), F.col(text_col).alias("text"))
    scored = base.mapInArrow(_scorer(shared, weights), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
