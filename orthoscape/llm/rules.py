"""Quality rules as one Spark projection, without user functions.

``RULES`` is the threshold table: a measure and its lower and upper bound.  It
is compiled into one boolean column over measures of length, symbols, stop
words and lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is it that for was on as be with by are this at from "
    "de la le et les des un une du que en est dans pour par sur au qui "
    "der die das und den von zu mit ein eine ist nicht auf im sich für "
    "el los las se por con del no para y al lo su"
).split()

#: measure, smallest and largest value of a kept text; None: no bound.
RULES: tuple[tuple[str, float | None, float | None], ...] = (
    ("n_words", 10, None),
    ("mean_word_chars", 2.0, 20.0),
    ("symbol_ratio", None, 0.1),
    ("stop_ratio", 0.02, None),
    ("dup_line_ratio", None, 0.5),
    ("shout_ratio", None, 0.5),
    ("marked_line_ratio", None, 0.9),
)


def bound(value: Column, use) -> Column:
    """use(value) with the value computed once, as a lambda's variable."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words that stand in a window of ``width`` words found twice or more; windows are hashed to 64 bits."""
    hashed = F.transform(words, lambda w: F.xxhash64(w))

    def grams(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(width)]))

    def covered(g: Column) -> Column:
        placed = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def starts(p: Column) -> Column:
            def twin(x: Column, j: Column) -> Column:
                before = F.when(j > 0, F.get(p, j - 1)["x"] == x["x"])
                after = F.get(p, j + 1)["x"] == x["x"]
                return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

            return F.sort_array(F.transform(F.filter(p, twin), lambda x: x["i"]))

        def union(s: Column) -> Column:
            return F.aggregate(s, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-width).alias("last")), lambda a, i: F.struct((a["n"] + F.least(F.lit(width), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])

        return bound(placed, lambda p: bound(starts(p), union))

    def count(g: Column) -> Column:
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long")).otherwise(covered(g))

    return F.when(F.size(words) <= width, F.lit(0).cast("long")).otherwise(bound(hashed, lambda h: bound(grams(h), count)))


def compiled(rules=RULES) -> Column:
    """One boolean column: all measures within their bounds."""
    out = F.lit(True)
    for name, low, high in rules:
        if low is not None:
            out = out & (F.col(name) >= F.lit(low))
        if high is not None:
            out = out & (F.col(name) <= F.lit(high))
    return out


def quality_rules(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts, ratios, base_failed and kept, one row a document, in whole texts.

    n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words are counts;
    base_failed holds for fewer than 10 words, or if more than a fifth of the
    words repeat in windows; kept is false then, else the rules' verdict.  A
    null text has no words, so it fails.  Repeated rows and null ids give rows
    of their own; other columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("_text"), words.alias("_words"), lines.alias("_lines"))
    stops = F.array(*[F.lit(w) for w in STOP_WORDS])
    counted = read.select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
        F.size("_lines").alias("_n_lines"),
        F.size(F.filter("_lines", lambda x: x.rlike("^[\\x20\\x09]*[-*•|]"))).alias("_marked"),
        bound(F.array_join(F.filter("_words", lambda w: F.length(w) > 2), ""), lambda t: F.length(t) - F.length(F.regexp_replace(t, "\\p{Lu}+", ""))).alias("_upper"),
        F.size(F.filter("_words", lambda w: F.array_contains(stops, F.lower(w)))).alias("_stops"),
    )
    n = F.greatest(F.col("n_words"), F.lit(1))
    rated = counted.select(
        "*",
        (F.col("word_chars") / n).alias("mean_word_chars"),
        (F.col("n_symbols") / n).alias("symbol_ratio"),
        (F.col("_stops") / n).alias("stop_ratio"),
        (F.col("n_dup_lines") / F.greatest("_n_lines", F.lit(1))).alias("dup_line_ratio"),
        (F.col("_upper") / F.greatest("word_chars", F.lit(1))).alias("shout_ratio"),
        (F.col("_marked") / F.greatest("_n_lines", F.lit(1))).alias("marked_line_ratio"),
        ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias("base_failed"),
    )
    kept = rated.withColumn("kept", ~F.col("base_failed") & compiled(rules))
    return kept.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "mean_word_chars", "symbol_ratio", "stop_ratio", "dup_line_ratio", "shout_ratio", "marked_line_ratio")
