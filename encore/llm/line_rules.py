"""Quality rules with cross-document line frequency, in DataFrame functions only.

Base rules per document (words are runs of anything but space and \\x09-\\x0D):
word characters, symbols, repeated lines, and words in 8-word windows that occur
twice or more in the text. A document fails them with fewer than ``min_words``
words or more than ``max_repeat_percent`` of its words in repeated windows.

Line frequency: lines are normalised (lower case, digits as 0, white space
collapsed), hashed, and counted per host over distinct documents (equal texts
count once). Lines on more documents than ``max(min_docs, max_share * the host's
distinct documents)`` are removed; a document that loses more than
``depleted_percent`` of its words is depleted and rejected.

Windows are hashed by doubling (pairs, fours, eights), so a document costs a few
passes over its words; only documents with a repeated window are looked at
closer. Lines are counted by hash aggregates and joined back by (host, line).

Results: null texts have no words and fail the base rules; blank lines are not
counted; repeated rows are one distinct document but each gets its verdict; a
null host is a host of its own. Lines at exactly a limit stay. Very long texts are
measured whole; an empty table gives an empty result. Other columns pass through, those named like the
results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_key

SPACES = " \t\n\x0b\x0c\r"
GAP = r"[ \t-\r]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
           "n_lines_removed", "n_words_removed", "kept")


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP, -1))


def _pairs(name: str, step: int) -> Column:
    """Hashes of each element with the one ``step`` later."""
    n = F.greatest(F.size(name) - step, F.lit(0))
    return F.zip_with(F.slice(name, 1, n), F.slice(name, 1 + step, n), lambda a, b: F.xxhash64(a, b))


def _base(rows: DataFrame, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    plain = body
    for c in SYMBOLS:
        plain = F.replace(plain, F.lit(c), F.lit(""))
    rows = rows.withColumn("_words", _words(body))
    rows = rows.withColumn("_one", F.transform("_words", lambda w: F.xxhash64(w)))
    rows = rows.withColumn("_two", _pairs("_one", 1)).withColumn("_four", _pairs("_two", 2))
    rows = rows.withColumn("_eight", _pairs("_four", 4))
    # starts of repeated windows, found by sorting (hash, start) where there are any
    rows = rows.withColumn("_sorted", F.when(
        F.size("_eight") > F.size(F.array_distinct("_eight")),
        F.sort_array(F.transform("_eight", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    rows = rows.withColumn("_starts", F.sort_array(F.transform(F.filter(
        F.transform("_sorted", lambda x, i: F.struct(
            x.i.alias("i"),
            F.coalesce((F.get("_sorted", i - 1).h == x.h) | (F.get("_sorted", i + 1).h == x.h),
                       F.get("_sorted", i - 1).h == x.h, F.get("_sorted", i + 1).h == x.h,
                       F.lit(False)).alias("again"))),
        lambda x: x.again), lambda x: x.i)))
    m = F.size("_starts")
    covered = F.aggregate(
        F.zip_with(F.slice("_starts", 1, m - 1), F.slice("_starts", 2, m - 1),
                   lambda a, b: F.least(b - a, F.lit(WINDOW))), F.lit(WINDOW), lambda x, y: x + y)
    lines = F.filter(F.split(body, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    rows = rows.withColumn("_lines", lines)
    return (rows.withColumn("n_words", F.size("_words").cast("long"))
                .withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
                .withColumn("n_symbols", (F.length(body) - F.length(plain)).cast("long"))
                .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
                .withColumn("n_repeat_words",
                            F.when(F.col("_starts").isNull(), F.lit(0)).otherwise(covered).cast("long"))
                .drop("_words", "_one", "_two", "_four", "_eight", "_sorted", "_starts", "_lines"))


def _normal(line: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.btrim(line, F.lit(SPACES))), "[0-9]", "0"), GAP, " ")


def apply_rules(df: DataFrame, host: str = "source", text: str = "text", min_words: int = 20,
                max_repeat_percent: int = 30, max_share: float = 0.05, min_docs: int = 20,
                depleted_percent: int = 70) -> DataFrame:
    """The input with frequent lines removed from ``text``, the measures and the verdict ``kept``."""
    df = df.drop(*RESULTS)
    named = {c: f"_c{i}" for i, c in enumerate(df.columns)}
    rows = df.select(*[F.col(c).alias(a) for c, a in named.items()],
                     F.xxhash64(host, F.col(host).isNull()).alias("host"), *row_key(df, *df.columns))
    body = named[text]
    raw = F.split(F.coalesce(F.col(body), F.lit("")), "\n", -1)
    lines = (rows.select("host", "r1", "r2", F.xxhash64(body).alias("content"), F.explode(raw).alias("raw"))
                 .select("host", "r1", "r2", "content", _normal(F.col("raw")).alias("normal"))
                 .filter("normal <> ''")
                 .select("host", "r1", "r2", "content", F.xxhash64("normal").alias("line"),
                         F.size(F.split("normal", " ")).alias("w")))
    totals = (rows.select("host", F.xxhash64(body).alias("content")).distinct()
                  .groupBy("host").agg(F.count(F.lit(1)).alias("docs")))
    frequent = (lines.select("host", "line", "content").distinct()
                     .groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
                     .filter(F.col("n") > min_docs).join(totals, "host")
                     .filter(F.col("n") > max_share * F.col("docs")).select("host", "line"))
    hits = (lines.join(frequent, ["host", "line"]).groupBy("r1", "r2", "line")
                 .agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("c"))
                 .groupBy("r1", "r2").agg(F.sum("w").alias("w"), F.sum("c").alias("c"),
                                          F.collect_list("line").alias("gone")))
    # copies of one row reach ``hits`` under one key: their sums are divided again
    copies = rows.groupBy("r1", "r2").agg(F.count(F.lit(1)).alias("copies"))
    hits = hits.join(copies, ["r1", "r2"]).select(
        "r1", "r2", "gone", (F.col("w") / F.col("copies")).cast("long").alias("n_words_removed"),
        (F.col("c") / F.col("copies")).cast("long").alias("n_lines_removed"))
    out = _base(rows, body).join(hits, ["r1", "r2"], "left").fillna(0, ["n_words_removed", "n_lines_removed"])
    out = out.withColumn("base_failed", (F.col("n_words") < min_words)
                         | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")))
    left = F.when(F.col("gone").isNull(), F.coalesce(F.col(body), F.lit(""))).otherwise(
        F.array_join(F.filter(raw, lambda x: (_normal(x) == "") | ~F.array_contains(
            "gone", F.xxhash64(_normal(x)))), "\n"))
    kept = ~F.col("base_failed") & (100 * F.col("n_words_removed") <= depleted_percent * F.col("n_words"))
    return out.withColumn("kept", kept).select(
        *[left.alias(c) if c == text else F.col(a).alias(c) for c, a in named.items()], *RESULTS)
