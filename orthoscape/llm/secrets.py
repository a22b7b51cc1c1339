"""Secrets: base patterns, and random strings by their low characters per token.

Beside the base kinds, runs of ``[A-Za-z0-9+/_=-]`` of 16 or more characters
are encoded by a public byte-level vocabulary, each as a whole and each of its
segments between ``/ = _ - +`` of that length.  Words and names need few
tokens; random strings about one for one and a half characters.  A string is a
secret if its ratio is at most ``RATIO``; letters of one case, which words of a
language that the vocabulary covers badly are too, at most ``PLAIN_RATIO``.
Known digests (of 32, 40, 56, 64, 96 or 128 hexadecimal digits) and identifiers
(UUIDs, runs of digits, short segments joined by signs) are excluded.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "random")
RATIO = 2.2
PLAIN_RATIO = 1.5
SHORTEST = 16
#: A run whose segments are all shorter is names joined by signs.
SEGMENT = 8

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)
_UUID = re.compile(r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}")
_SEGMENT = re.compile(r"[A-Za-z0-9]+")
_MIXED = re.compile(r"[0-9]|[a-z][A-Z]")
_DIGEST = re.compile(r"[0-9a-f]+|[0-9A-F]+")


def vocabulary(path: str | None = None):
    """The tokenizer whose ratios are measured."""
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def is_random(run: str, encoding) -> bool:
    """Whether a string is random by its token efficiency."""
    if not re.search("[A-Za-z]", run):
        return False
    if _UUID.fullmatch(run) or (_DIGEST.fullmatch(run) and len(run) in (32, 40, 56, 64, 96, 128)):
        return False
    return len(run) <= (RATIO if _MIXED.search(run) else PLAIN_RATIO) * len(encoding.encode_ordinary(run))


def random_spans(text: str, encoding) -> list[tuple[int, int]]:
    """Random runs of a text, or else the random segments of a run."""
    out = []
    for m in _RUN.finditer(text):
        segments = [(m.start() + s.start(), m.start() + s.end()) for s in _SEGMENT.finditer(m.group())]
        if max((b - a for a, b in segments), default=0) >= SEGMENT and is_random(m.group(), encoding):
            out.append(m.span())
        elif len(segments) > 1:
            out += [(a, b) for a, b in segments if b - a >= SHORTEST and is_random(text[a:b], encoding)]
    return out


def find(text: str, encoding) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start, then by kind as listed."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(a, b, "random") for a, b in random_spans(text, encoding)]
    out += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def _scanner(path: str | None):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = vocabulary(path)
        for batch in batches:
            rows = []
            for text in batch.column(1):
                spans = find(text.as_py() or "", encoding)
                base = [s for s in spans if s[2] != "random"]
                n = [sum(s[2] == k for s in base) for k in KINDS[:3]]
                rows.append((*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), len(spans) - len(base)))
            cols = list(zip(*rows, strict=True)) or [()] * 6
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"])

    return scan


def scan_secrets(docs: DataFrame, vocabulary_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts by kind, base_sha256 and all spans, one row a document, in whole texts.

    A null text is empty: no spans, the digest of the empty string.  Repeated
    rows and null ids give rows of their own; spans of different kinds may
    overlap; other columns are ignored; an empty table gives no rows.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return base.mapInArrow(_scanner(vocabulary_path), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long")
