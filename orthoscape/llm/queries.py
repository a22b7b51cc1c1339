"""The registered queries of this subpackage, and their SQL where it can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .exact_dedup import exact_groups
from .jaccard_join import jaccard_components
from .language_id import identify
from .mixing import mix_sources
from .packing import pack
from .quality import quality_scores
from .rules import RULES, STOP_WORDS, quality_rules
from .secrets import scan_secrets
from .surrogates import replace_personal_data
from .toxicity import toxicity_scores


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark, _docs(spark, sf_dir))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(spark, _docs(spark, sf_dir).select("doc_id", "source"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_docs(spark, sf_dir))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(spark, _docs(spark, sf_dir))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(spark, _docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(spark, _docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, _docs(spark, sf_dir))


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key is the session's setting, or a fresh one: surrogates of different runs then don't match."""
    key = spark.conf.get("orthoscape.surrogate.key", None)
    return replace_personal_data(spark, _docs(spark, sf_dir), key.encode() if key else os.urandom(32))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(_docs(spark, sf_dir))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark, _docs(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join,
        op2_mix_sources,
        op3_quality_rules,
        op4_exact_dedup,
        op5_toxicity,
        op6_quality_classifier,
        op7_best_fit_packing,
        op8_pii_surrogates,
        op9_secret_scan,
        op10_language_id,
    )
}

_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: SQL where it can express an operator; the others are tested against brute force.
ORACLE_SQL: dict[str, str] = {
    "op1_ngram_jaccard_join": f"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS ws FROM documents),
 s AS MATERIALIZED (SELECT DISTINCT doc_id, sh FROM (SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS sh FROM w)),
 n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1), p AS (SELECT a.doc_id AS i, b.doc_id AS j, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
 l AS MATERIALIZED (SELECT i, j FROM p JOIN n x ON x.doc_id = i JOIN n y ON y.doc_id = j WHERE 100 * c >= 85 * (x.n + y.n - c)), e AS MATERIALIZED (SELECT i, j FROM l UNION ALL SELECT j, i FROM l),
 r AS (SELECT i AS a, i AS b FROM e UNION SELECT r.a, e.j FROM r JOIN e ON r.b = e.i), k AS (SELECT a, min(b) AS m FROM r GROUP BY 1), g AS (SELECT i, count(*) AS n FROM e GROUP BY 1)
 SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(k.m, d.doc_id) AS component_id, coalesce(g.n, 0) AS n_links FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN k ON k.a = d.doc_id LEFT JOIN g ON g.i = d.doc_id""",
    "op3_quality_rules": rf"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), w AS MATERIALIZED (SELECT doc_id, text, {_WORDS.format("text")} AS ws, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
 g AS (SELECT doc_id, i, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)), d AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
 v AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM d, range(0, 5) x(k) GROUP BY 1), s AS (SELECT {list(STOP_WORDS)} AS stops),
 c AS (SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(v.n, 0) AS n_repeat_words, len(ls) AS n_lines,
  len(list_filter(ls, lambda x: regexp_matches(x, '^[\x20\x09]*[-*•|]'))) AS marked, len(list_filter(ws, lambda x: list_contains(stops, lower(x)))) AS n_stops,
  length(array_to_string(list_filter(ws, lambda x: length(x) > 2), '')) - length(regexp_replace(array_to_string(list_filter(ws, lambda x: length(x) > 2), ''), '\p{{Lu}}', '', 'g')) AS upper_ FROM s, w LEFT JOIN v ON v.doc_id = w.doc_id),
 r AS (SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, word_chars / greatest(n_words, 1) AS mean_word_chars, n_symbols / greatest(n_words, 1) AS symbol_ratio, n_stops / greatest(n_words, 1) AS stop_ratio,
  n_dup_lines / greatest(n_lines, 1) AS dup_line_ratio, upper_ / greatest(word_chars, 1) AS shout_ratio, marked / greatest(n_lines, 1) AS marked_line_ratio FROM c)
 SELECT *, NOT base_failed AND {" AND ".join(b for n, lo, hi in RULES for b in ([f"{n} >= {lo}"] if lo is not None else []) + ([f"{n} <= {hi}"] if hi is not None else []))} AS kept FROM r""",
    "op4_exact_dedup": "SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256 FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))",
}
