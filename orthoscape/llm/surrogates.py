"""Personal data: keyed, type-consistent surrogates for detected entities.

An entity's surrogate follows from a secret key, its kind and its normal form
only, so it is the same in all documents (coreference) without a shared table.
Surrogates keep the layout: digits stay digits, letters stay letters of their
case and script, addresses stay addresses, valid check digits stay valid, and a
name keeps its gender and script; a name has one surrogate with any title or
other name.  A given name's gender is that of its titles in the whole corpus.
A mail domain is permuted by a keyed bijection, so all addresses of a domain
share one and no two domains do.  All distinct entities of the corpus are
checked on the cluster: if two entities of a kind would share a surrogate, or
one would get another's true form, all but the smallest take their next
attempt, until none collide.
"""

from __future__ import annotations

import functools
import hashlib
import hmac
import re
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .staging import Stage

KINDS = ("email", "iban", "ip", "ssn", "phone", "card", "given", "surname")
BROADCAST_ROWS = 50_000
ROUNDS = 40
#: From this attempt on, addresses get longer: short ones have too few surrogates.
LENGTHEN = 6

# Titles that announce a name, by gender (m, f, or n for either).
TITLES = {"Mr": "m", "Mister": "m", "Sir": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Don": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Madam": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Señora": "f", "Sra": "f", "Doña": "f", "Dr": "n", "Prof": "n", "Господин": "m", "Госпожа": "f"}
# Frequent given names by gender.
GIVEN = {
    "m": "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Anthony Mark Steven Andrew Paul Peter George Edward Hans Karl Klaus Jürgen Stefan Wolfgang Jean Pierre Michel André Philippe Jacques José Juan Carlos Luis Javier Miguel Antonio Pedro Иван Сергей Андрей Дмитрий Николай".split(),
    "f": "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Margaret Emily Emma Alice Helen Ruth Laura Anna Maria Julia Monika Ursula Sabine Petra Claudia Marie Sophie Nathalie Isabelle Camille Claire Carmen Lucía Elena Ana Isabel Pilar Мария Ольга Елена Анна Наталья".split(),
}
_GENDER = {name: g for g, names in GIVEN.items() for name in names}

_CAP = r"[A-ZÀ-ÖØ-ÞА-Я][a-zß-öø-ÿа-яё]+(?:-[A-ZÀ-ÖØ-ÞА-Я][a-zß-öø-ÿа-яё]+)?"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_ENTITY = re.compile(
    rf"""(?P<iban>\b[A-Z]{{2}}\d{{2}}(?:\ ?[A-Z0-9]{{4}}){{3,7}}(?:\ ?[A-Z0-9]{{1,3}})?\b)
    |(?P<ip>(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\d.]*\d))
    |(?P<card>(?<!\w)\d(?:[\ -]?\d){{12,18}}(?!\w))
    |(?P<ssn>(?<![\w-])\d{{3}}-\d{{2}}-\d{{4}}(?![\w-]))
    |(?P<phone>(?<![\w+(])(?:\+\d{{1,3}}[\ .-]?)?(?:\(\d{{2,4}}\)|\d{{2,4}})[\ .-]?\d{{3,4}}[\ .-]\d{{3,4}}(?!\w))
    |\b(?P<title>{"|".join(TITLES)})\.?\ +(?:(?P<g1>{_CAP})\ +)?(?P<s1>{_CAP})
    |\b(?P<g2>{"|".join(_GENDER)})\ +(?P<s2>{_CAP})""",
    re.VERBOSE,
)
_LOCAL = frozenset(string.ascii_letters + string.digits + "_.%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
_NAME = re.compile(rf"(?<!\w){_CAP}(?!\w)")
_HINT = re.compile(rf"[0-9@]|\b(?:{'|'.join([*TITLES, *_GENDER])})\b")

_VOWELS = {"latin": "aeiou", "cyrillic": "аеиоу"}
_CONSONANTS = {"latin": "bdfghklmnprstvz", "cyrillic": "бвгдзклмнпрст"}
_ENDS = {"latin": {"m": ("o", "an", "er"), "f": ("a", "ia", "ine"), "n": ("en", "is", "el")}, "cyrillic": {"m": ("ан", "ор"), "f": ("а", "ия"), "n": ("ин", "ен")}}


class _Stream:
    """Keyed numbers for one entity and attempt."""

    def __init__(self, key: bytes, *parts: object):
        self.seed = hmac.new(key, "\x1f".join(map(str, parts)).encode(), hashlib.sha256).digest()
        self.block, self.bits, self.n = 0, 0, 1

    def below(self, n: int) -> int:
        while self.n < n << 32:
            more = hashlib.sha256(self.seed + self.block.to_bytes(4, "big")).digest()[:8]
            self.block += 1
            self.bits, self.n = self.bits << 64 | int.from_bytes(more, "big"), self.n << 64
        self.bits, out = divmod(self.bits, n)
        self.n //= n
        return out


def _script(text: str) -> str:
    return "cyrillic" if re.search("[А-Яа-яЁё]", text) else "latin"


def _luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10


def _letters(text: str, stream: _Stream) -> str:
    """Letters for letters and digits for digits, other signs as they are."""
    out = []
    for c in text:
        if c.isdigit():
            out.append(str(stream.below(10)))
        elif c.isalpha():
            script = _script(c)
            pool = _VOWELS[script] + _CONSONANTS[script]
            x = pool[stream.below(len(pool))]
            out.append(x.upper() if c.isupper() else x)
        else:
            out.append(c)
    return "".join(out)


def normal(kind: str, text: str) -> str:
    """The form by which two mentions are the same entity."""
    if kind == "email":
        return text.lower()
    if kind in ("ssn", "phone", "card"):
        return re.sub(r"\D", "", text)
    if kind == "iban":
        return text.replace(" ", "")
    return text


def _feistel(number: int, size: int, key: bytes, turns) -> int:
    """One of a keyed permutation of 0..size-1: rounds on halves of its bits, again while the result is too large."""
    half = max(1, (size.bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        a, b = number >> half, number & mask
        for turn in turns:
            if turns[0] < turns[-1]:
                a, b = b, a ^ _round(key, turn, b, half, mask)
            else:
                a, b = b ^ _round(key, turn, a, half, mask), a
        number = a << half | b
        if number < size:
            return number


def _round(key: bytes, turn: int, x: int, half: int, mask: int) -> int:
    return int.from_bytes(hashlib.shake_256(key + bytes([turn]) + x.to_bytes(half // 8 + 1, "big")).digest(half // 8 + 1), "big") & mask


@functools.lru_cache(100_000)
def domain_surrogate(domain: str, key: bytes) -> str:
    """Another host of the same layout and top level, never the same one; different domains stay different.

    Letters and digits of the host are digits of a number, which moves one
    place along a keyed cycle of all numbers of that layout.
    """
    host, _, top = domain.rpartition(".")
    signs = [string.digits if c.isdigit() else string.ascii_lowercase if c.isalpha() else "" for c in host]
    layout = "".join("9" if s == string.digits else "a" if s else c for s, c in zip(signs, host, strict=True))
    own = hmac.new(key, f"domain\x1f{layout}\x1f{top}".encode(), hashlib.sha256).digest()
    size, number = 1, 0
    for s, c in zip(signs, host, strict=True):
        if s:
            size, number = size * len(s), number * len(s) + s.index(c)
    number = _feistel((_feistel(number, size, own, range(8)) + 1) % size, size, own, range(7, -1, -1))
    out = []
    for s, c in zip(reversed(signs), reversed(host), strict=True):
        if s:
            number, at = divmod(number, len(s))
        out.append(s[at] if s else c)
    return f"{''.join(reversed(out))}.{top}"


def surrogate(kind: str, form: str, key: bytes, attempt: int = 0, gender: str = "n") -> str:
    """The surrogate's normal form; never the entity's own."""
    for again in range(100):
        stream = _Stream(key, kind, form, attempt, again)
        if kind == "email":
            local, _, domain = form.partition("@")
            more = "a" * (max(0, attempt - LENGTHEN) + (again > 50))
            out = f"{_letters(local + more, stream)}@{domain_surrogate(domain, key)}"
        elif kind == "ip":
            out = ".".join(str(1 + stream.below(254)) for _ in range(4))
        elif kind == "card":
            body = _letters(form[:-1], stream)
            valid = _luhn(form) == 0
            check = [c for c in "0123456789" if (_luhn(body + c) == 0) == valid]
            out = body + check[stream.below(len(check))]
        elif kind == "phone":
            keep = len(form) - 10 if len(form) > 10 else 0
            out = form[:keep] + _letters(form[keep:], stream)
            if form[-7:-4] == "555":  # numbers reserved for fiction stay so
                out = out[:-7] + "555" + out[-4:]
        elif kind == "ssn":
            out = _letters(form, stream)
        elif kind == "iban":
            body = form[:2] + "00" + _letters(form[4:], stream)
            number = int("".join(str(int(c, 36)) for c in body[4:] + body[:2] + "00"))
            out = f"{body[:2]}{98 - number % 97:02d}{body[4:]}"
        else:
            script = _script(form)
            own = "".join(_CONSONANTS[script][stream.below(len(_CONSONANTS[script]))] + _VOWELS[script][stream.below(5)] for _ in range((2 if kind == "given" else 3) + max(0, attempt - LENGTHEN)))
            ends = _ENDS[script][gender]
            out = (own + _CONSONANTS[script][stream.below(10)] + ends[stream.below(len(ends))]).capitalize()
        if out != form:
            return out
    raise ValueError(f"no surrogate for a {kind}")


def _laid_out(kind: str, text: str, made: str) -> str:
    """A surrogate in the layout of a mention."""
    if kind in ("ssn", "phone", "card", "iban"):
        signs = iter(made)
        return "".join(next(signs) if c.isalnum() else c for c in text)
    if kind == "email":
        case = [c.isupper() for c in text.partition("@")[0]] + [False] * len(made)
        local, at, domain = made.partition("@")
        if text[: len(text.partition("@")[0])].isupper():
            case = [True] * len(made)
        tail = text.partition("@")[2]
        return "".join(m.upper() if up else m for m, up in zip(local, case, strict=False)) + at + "".join(m.upper() if c.isupper() else m for m, c in zip(domain, tail, strict=True))
    return made


def emails(text: str) -> list[tuple[int, int]]:
    """Spans of addresses, sought from each @ to both sides: the time grows with the length."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        a = at
        while a > last and (text[a - 1] in _LOCAL or (text[a - 1] > "\x7f" and text[a - 1].isalnum())):
            a -= 1
        while a < at and not (text[a].isascii() and text[a].isalnum() or "À" <= text[a] <= "ÿ"):
            a += 1
        domain = _DOMAIN.match(text, at + 1) if a < at else None
        if domain:
            out.append((a, domain.end()))
            last = domain.end()
        else:
            last = at + 1
        at = text.find("@", last)
    return out


def mentions(text: str) -> list[tuple[int, int, str, str, str]]:
    """(start, end, kind, normal form, gender or "") of a text's entities, in order, without overlaps.

    Addresses come first, then what stands between them, leftmost first; last
    the repeats, without a title, of surnames found so.
    """
    if not _HINT.search(text):
        return []
    out: list[tuple[int, int, str, str, str]] = []
    spans = emails(text)
    ends = [0, *(b for _, b in spans)]
    for lo, hi in zip(ends, [*(a for a, _ in spans), len(text)], strict=True):
        for m in _ENTITY.finditer(text, lo, hi):
            if m["title"] or m["g2"]:
                given = "g1" if m["g1"] else "g2" if m["g2"] else None
                if given:
                    gender = _GENDER.get(m[given]) or (TITLES[m["title"]] if m["title"] else "n")
                    out.append((*m.span(given), "given", m[given], gender))
                last = "s1" if m["title"] else "s2"
                out.append((*m.span(last), "surname", m[last], ""))
            else:
                out.append((*m.span(), m.lastgroup, normal(m.lastgroup, m.group()), ""))
    out += [(a, b, "email", text[a:b].lower(), "") for a, b in spans]
    out.sort()
    names = {x[3] for x in out if x[2] == "surname"}
    if names:
        taken, at, more = [(x[0], x[1]) for x in out], 0, []
        for m in _NAME.finditer(text):
            while at < len(taken) and taken[at][1] <= m.start():
                at += 1
            if m.group() in names and (at == len(taken) or m.end() <= taken[at][0]):
                more.append((*m.span(), "surname", m.group(), ""))
        out = sorted(out + more)
    return out


def _finder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = {x[2:] for t in batch.column(0) for x in mentions(t.as_py() or "")}
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*sorted(found), strict=True)], ["kind", "form", "gender"])


_ENTITIES = "kind string, form string, gender string, attempt int"


def _maker(key: bytes):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            made = [surrogate(k, f, key, a, g) for k, f, g, a in zip(rows["kind"], rows["form"], rows["gender"], rows["attempt"], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], ["kind", "form", "gender", "attempt", "made"])

    return make


def attempts(stage: Stage, texts: DataFrame, key: bytes) -> DataFrame:
    """(kind, form, gender, attempt) of the entities that can't take their first surrogate, or whose name has a gender.

    A name that stands after titles of both genders has none.
    """
    found = texts.mapInArrow(_finder, "kind string, form string, gender string").groupBy("kind", "form")
    genders = found.agg(F.bool_or(F.col("gender") == "m").alias("m"), F.bool_or(F.col("gender") == "f").alias("f"))
    forms = genders.select("kind", "form", F.when(F.col("m") & ~F.col("f"), "m").when(F.col("f") & ~F.col("m"), "f").otherwise("n").alias("gender"), F.lit(0).alias("attempt"))
    entities = stage.write(forms.mapInArrow(_maker(key), f"{_ENTITIES}, made string"), "entities-0")
    for i in range(1, ROUNDS):
        shared = entities.groupBy("kind", "made").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("attempt", "form")).alias("first")).filter("n > 1")
        clash = entities.join(shared, ["kind", "made"]).filter(F.struct("attempt", "form") != F.col("first")).select("kind", "form")
        true = entities.select("kind", F.col("form").alias("made"))
        taken = entities.join(true, ["kind", "made"], "left_semi").select("kind", "form")
        losers = stage.write(clash.unionByName(taken).distinct(), f"losers-{i}")
        if not losers.limit(1).count():
            return entities.filter("attempt > 0 or gender <> 'n'").select("kind", "form", "gender", "attempt")
        again = entities.join(losers, ["kind", "form"], "left_semi").select("kind", "form", "gender", (F.col("attempt") + 1).alias("attempt"))
        again = again.mapInArrow(_maker(key), f"{_ENTITIES}, made string")
        entities = stage.write(entities.join(losers, ["kind", "form"], "left_anti").unionByName(again), f"entities-{i}")
        stage.drop(f"entities-{i - 1}", f"losers-{i}")
    raise RuntimeError("surrogates still collide; their space is too small for the entities")


def _rewriter(key: bytes, known):
    """Rows (doc_id, text[, own]); own or known hold the gender and attempt of entities that need them."""

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = known.value if known is not None else {}
        cache: dict[tuple, str] = {}
        for batch in batches:
            own = batch.column(2).to_pylist() if batch.num_columns > 2 else [None] * batch.num_rows
            out: list[tuple] = []
            for text, extra in zip(batch.column(1), own, strict=True):
                text = text.as_py()
                spans = mentions(text) if text else []
                tries = {(x["kind"], x["form"]): (x["attempt"], x["gender"]) for x in extra or ()}
                parts, last = [], 0
                for a, b, kind, form, _ in spans:
                    at = (kind, form, *tries.get((kind, form), shared.get((kind, form), (0, "n"))))
                    if at not in cache:
                        if len(cache) > 100_000:
                            cache.clear()
                        cache[at] = surrogate(kind, form, key, at[2], at[3])
                    parts += [text[last:a], _laid_out(kind, text[a:b], cache[at])]
                    last = b
                kinds = [s[2] for s in spans]
                out.append((*(kinds.count(k) for k in KINDS), ",".join(f"{x[2]}:{x[0]}:{x[1]}" for x in spans), "".join([*parts, text[last:]]) if spans else text))
            cols = list(zip(*out, strict=True)) or [()] * (len(KINDS) + 2)
            types = [pa.int64()] * len(KINDS) + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], ["doc_id", *(f"n_{k}" for k in KINDS), "spans", "text"])

    return rewrite


def replace_personal_data(spark: SparkSession, docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts by kind, spans (kind:start:end in code points) and the text with surrogates.

    The key is the caller's secret, 16 bytes at least: who has it can compute
    surrogates again, and the same key gives the same ones in every run.  A null text stays null and an empty one empty, both without spans.
    Repeated rows get the same surrogates; null ids give rows of their own;
    other columns are ignored; an empty table gives no rows.
    """
    if len(key) < 16:
        raise ValueError("the key must have 16 bytes at least")
    stage = Stage(spark, "surrogates")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    late = stage.write(attempts(stage, base.select("text"), key), "late")
    n = late.count()
    known = None
    if 0 < n <= BROADCAST_ROWS:
        known = spark.sparkContext.broadcast({(r.kind, r.form): (r.attempt, r.gender) for r in late.collect()})
    elif n:
        # Too many to broadcast: each document brings those of its own entities.
        seen = docs.select(F.xxhash64(text_col).alias("_t"), F.col(text_col).alias("text")).mapInArrow(_occurrences, "_t long, kind string, form string").distinct()
        own = seen.join(late, ["kind", "form"]).groupBy("_t").agg(F.collect_set(F.struct("kind", "form", "gender", "attempt")).alias("own"))
        base = base.withColumn("_t", F.xxhash64("text")).join(own, "_t", "left").select("doc_id", "text", "own")
    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", spans string, text string"
    return base.mapInArrow(_rewriter(key, known), schema)


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = {(h.as_py(), x[2], x[3]) for h, t in zip(batch.column(0), batch.column(1), strict=True) for x in mentions(t.as_py() or "")}
        if rows:
            a, b, c = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.string()), pa.array(c, pa.string())], ["_t", "kind", "form"])
