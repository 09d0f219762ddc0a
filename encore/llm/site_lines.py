"""Line dedup by site-relative frequency.

Lines are the parts of a text between line feeds, compared without spaces, tabs
and carriage returns at their ends. For every host the pages that contain a line
are divided by the host's pages; a line on more than ``ratio`` of them (and on
``min_pages`` or more) is boilerplate and dropped from that host's pages.

A page contributes each of its lines once, and counts are summed before the
shuffle, so a line on a third of all pages is one number per task. The dropped
lines join back by (host, line); Spark splits a hot line's partition.

With ``distinct`` equal texts of a host are one page, in both counts, so a group
of copies does not make its own lines boilerplate. Without it they are pages of
their own. Either way every row loses the same lines as its copies.

Results: null texts count as empty pages and come out empty. Blank lines are
kept and not counted. Repeated rows are like other copies. A null host is a
host of its own. A page whose lines all go keeps its row with what blank lines
leave. A line at exactly ``ratio`` stays. Very long texts are split into lines
whole; an empty table gives an empty result. Other columns pass through; ``n_lines`` and ``n_dropped`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_key

ENDS = " \t\r"


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def _key(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(ENDS)))


def _filled(lines: Column) -> Column:
    return F.filter(lines, lambda x: F.btrim(x, F.lit(ENDS)) != "")


def drop_boilerplate(df: DataFrame, host: str = "source", text: str = "text", ratio: float = 0.02,
                     min_pages: int = 5, distinct: bool = False) -> DataFrame:
    """The input with boilerplate lines removed from ``text``, and ``n_lines``, ``n_dropped``."""
    df = df.drop("n_lines", "n_dropped")
    named = {c: f"_c{i}" for i, c in enumerate(df.columns)}
    pages = df.select(*[F.col(c).alias(a) for c, a in named.items()],
                      F.xxhash64(host, F.col(host).isNull()).alias("host"), *row_key(df, *df.columns))
    body = named[text]
    lines = pages.select("host", "r1", "r2", F.explode(F.array_distinct(
        F.transform(_filled(_lines(body)), _key))).alias("line"))
    counted, one_each = lines, pages
    if distinct:
        # the row with the smallest key stands for its copies (and for rows equal to it)
        content = F.xxhash64(F.coalesce(F.col(body), F.lit("")))
        one_each = (pages.select("host", "r1", "r2", content.alias("content")).groupBy("host", "content")
                         .agg(F.min(F.struct("r1", "r2")).alias("r")).select("host", "r.r1", "r.r2"))
        counted = (lines.join(one_each, ["host", "r1", "r2"], "left_semi")
                        .select("host", "r1", "r2", "line").distinct())
    totals = one_each.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    boiler = (counted.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
                   .filter(F.col("n") >= min_pages).join(totals, "host")
                   .filter(F.col("n") > ratio * F.col("pages")).select("host", "line"))
    hits = lines.join(boiler, ["host", "line"]).groupBy("r1", "r2").agg(F.collect_set("line").alias("gone"))
    out = (pages.join(hits.hint("shuffle_hash"), ["r1", "r2"], "left")
                .withColumn("_lines", _lines(body))
                .withColumn("_left", F.when(F.col("gone").isNull(), F.col("_lines")).otherwise(
                    F.filter("_lines", lambda x: (F.btrim(x, F.lit(ENDS)) == "")
                             | ~F.array_contains("gone", _key(x))))))
    return out.select(
        *[F.array_join("_left", "\n").alias(c) if c == text else F.col(a).alias(c) for c, a in named.items()],
        F.size(_filled(F.col("_lines"))).cast("long").alias("n_lines"),
        (F.size("_lines") - F.size("_left")).cast("long").alias("n_dropped"))
