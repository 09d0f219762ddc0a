"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Base spans come from four fixed patterns (email, ip, card, phone), leftmost and
non-overlapping per kind, with their number checks. They seed the bootstrap:

1. *Candidates* are tokens of letters and digits with a digit, single ``- . _ /``
   inside included, tokens with a digit that one space parts taken together, at
   least ``min_length`` long and outside every base span. Candidates shaped like
   a key (``SECRET``) are seeds of a fifth kind. Seeds and candidates carry their
   left context, the two words before them in the text, whatever those hold;
   white space counts as written, and words that begin more than ``CONTEXT``
   characters before the match are cut there (a longer word gives no context).
2. A pattern is (kind, left context). A pattern's score is the mean over the
   distinct instances that it precedes: the score of a known one, ``neutral`` for
   an unknown one; with fewer than ``min_support`` known instances it scores 0.
   Known instances are the seeds (score 1) and the candidates accepted before.
3. A candidate's score for a kind is the best of the patterns that precede it.
   Candidates at ``confidence`` or more are accepted. Rounds go on until one
   accepts no new pattern; the occurrences that an accepted pattern precedes
   become spans of kind ``found_<kind>``. Seeds of the fifth kind in no accepted
   pattern are no spans.

Support counts distinct instances, so copies of one document make no pattern.
Patterns and instances are aggregated before every join: a common context or
instance is one row.

Offsets: a text is split at a pattern's matches and the lengths of the pieces
are summed by a window over the document's matches (small rows without text).
Patterns are written without backtracking over long runs.

Results: null and empty texts have no spans; the digests are then of the empty
string. Very long texts are split like others, whole. An empty table gives an
empty result. An occurrence that patterns of several kinds precede is a span of
each; equal spans count once. Rows are told apart by their content, repeated rows give equal results,
null ids are ordinary values. Other columns pass through or are replaced by
results of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, row_key

KINDS = ("email", "ip", "card", "phone")
# A run before "@" either starts where no run character precedes it or continues
# right after the previous match; possessive parts do not backtrack.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# What a text must hold to be split at the pattern at all (a card has 13 digits).
NEEDS = {
    "email": r"@[A-Za-z0-9-]",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9](?:[ -]?[0-9]){12}",
    "phone": r"\+[0-9]",
}
# Starts where no token can go on, so a run is looked through for a digit once.
_TOKEN = r"(?=(?:[A-Za-z]++[._/-])*+[A-Za-z]*+[0-9])[A-Za-z0-9]++(?:[._/-][A-Za-z0-9]++)*+"
CANDIDATE = rf"(?<![A-Za-z0-9])(?<![A-Za-z0-9][._/-]){_TOKEN}(?: {_TOKEN})*+"
# A key: one token of 20 characters or more with letters and digits.
SECRET = r"^(?=[A-Za-z_-]*[0-9])(?=[0-9_-]*[A-Za-z])[A-Za-z0-9_-]{20,}$"
SEEDS = (*KINDS, "secret")
CONTEXT = 80                # characters looked at for the two words before a match
RESULTS = ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_found", "n_spans")


def _matches(rows: DataFrame, text: str, pattern: str, needs: str) -> DataFrame:
    """Matches with code-point offsets: ``(r1, r2, s, e, hit, before)``; equal rows count once."""
    split = rows.filter(F.col(text).rlike(needs)).select("r1", "r2", F.split(text, pattern, -1).alias("gaps"),
                        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))
    each = (split.filter(F.size("hits") > 0)
                 .select("r1", "r2", F.posexplode(F.arrays_zip("gaps", "hits")).alias("at", "m"))
                 .filter(F.col("m.hits").isNotNull())
                 .select("r1", "r2", "at", F.col("m.hits").alias("hit"), F.length("m.gaps").alias("gap"),
                         F.expr(f"right(m.gaps, {CONTEXT})").alias("near")).distinct())
    by_place = Window.partitionBy("r1", "r2").orderBy("at")
    upto = by_place.rowsBetween(Window.unboundedPreceding, 0)
    # the text before a match: earlier matches (a character or more each) and gaps
    last = F.expr(f"right(hit, {CONTEXT})")
    each = each.withColumn("piece", F.concat(F.coalesce(F.lag(last).over(by_place), F.lit("")), "near"))
    before = F.array_join(F.collect_list("piece").over(by_place.rowsBetween(-CONTEXT, 0)), "")
    each = (each.withColumn("e", F.sum(F.col("gap") + F.length("hit")).over(upto))
                .withColumn("before", F.right(before, F.lit(CONTEXT))))
    return each.select("r1", "r2", (F.col("e") - F.length("hit")).alias("s"), "e", "hit", "before")


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Luhn check of a short digit string."""
    def term(i):
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, twice).otherwise(d)
    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda acc, i: acc + term(i))
    return total % 10 == 0


def _valid(kind: str) -> Column:
    hit = F.col("hit")
    if kind == "ip":
        small = F.transform(F.split(hit, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(small, lambda p: (F.length(p) <= 3) & (F.when(F.length(p) <= 3, p.cast("int")) <= 255))
    if kind == "card":
        d = _digits(hit)
        return F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(hit)).between(9, 15)
    return F.lit(True)


def base_spans(rows: DataFrame, text: str) -> DataFrame:
    """``(r1, r2, kind, s, e, hit, before)`` of the four patterns."""
    found = None
    for kind in KINDS:
        some = (_matches(rows, text, PATTERNS[kind], NEEDS[kind]).filter(_valid(kind))
                .select("r1", "r2", F.lit(kind).alias("kind"), "s", "e", "hit", "before"))
        found = some if found is None else found.unionByName(some)
    return found


def _context(before: Column) -> Column:
    """The two words before a match, in lower case with digits as 0; empty if there are not two."""
    two = F.regexp_extract(before, r"([^ \t-\r]+[ \t-\r]+[^ \t-\r]+[ \t-\r]*)$", 1)
    return F.regexp_replace(F.lower(two), "[0-9]", "0")


def _outside(candidates: DataFrame, base: DataFrame) -> DataFrame:
    """Candidates that touch no base span of their document."""
    marks = base.select("r1", "r2", "s", "e", F.lit(0).alias("side"), F.lit("").alias("hit"),
                        F.lit("").alias("before"))
    both = marks.unionByName(candidates.withColumn("side", F.lit(1)))
    w = Window.partitionBy("r1", "r2").orderBy("s", "side")
    earlier = F.max(F.when(F.col("side") == 0, F.col("e"))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    later = F.min(F.when(F.col("side") == 0, F.col("s"))).over(w.rowsBetween(0, Window.unboundedFollowing))
    return (both.withColumn("_earlier", earlier).withColumn("_later", later)
                .filter((F.col("side") == 1) & (F.coalesce("_earlier", F.lit(0)) <= F.col("s"))
                        & (F.col("_later").isNull() | (F.col("_later") >= F.col("e"))))
                .drop("_earlier", "_later", "side"))


def bootstrap(seeds: DataFrame, candidates: DataFrame, min_support: int, confidence: float,
              neutral: float) -> DataFrame:
    """Accepted patterns ``(kind, context, score)`` from seeds ``(kind, context, hit)`` and other candidates.

    The pattern-instance graph is the table of distinct (context, instance)
    edges; each round scores patterns from instances and instances from patterns.
    """
    known = (seeds.select("kind", "context", F.col("hit").alias("item")).filter("context <> ''").distinct())
    edges = checkpointed(known.unionByName(
        candidates.select(F.lit("").alias("kind"), "context", F.col("hit").alias("item"))
                  .filter("context <> ''").distinct()))
    spread = checkpointed(edges.groupBy("context").agg(F.count_distinct("item").alias("items")))
    open_edges = edges.filter("kind = ''").select("context", "item")
    fixed = edges.filter("kind <> ''").select("kind", "context", "item", F.lit(1.0).alias("score"))
    known, accepted = fixed, -1
    while True:
        patterns = (known.groupBy("kind", "context")
                         .agg(F.sum("score").alias("mass"), F.count(F.lit(1)).alias("support"))
                         .filter(F.col("support") >= min_support).join(spread, "context")
                         .select("kind", "context", ((F.col("mass") + neutral * (F.col("items") - F.col("support")))
                                                     / F.col("items")).alias("score"))
                         .filter(F.col("score") >= confidence))
        patterns = checkpointed(patterns)
        number = patterns.count()
        if number <= accepted:
            return patterns
        accepted = number
        items = open_edges.join(patterns, "context").groupBy("kind", "item").agg(F.max("score").alias("score"))
        learnt = open_edges.join(items, "item").select("kind", "context", "item", "score")
        known = checkpointed(fixed.unionByName(learnt))


def _is(kind: str):
    return lambda x: x.kind == kind


def _digest(spans: Column) -> Column:
    rank = F.transform(spans, lambda x: F.struct(
        F.array_position(F.array(*[F.lit(k) for k in [*KINDS, *[f"found_{k}" for k in SEEDS]]]), x.kind).alias("k"),
        x.s.alias("s"), x.e.alias("e"), x.kind.alias("kind")))
    return F.array_join(F.transform(F.sort_array(rank), lambda x: F.concat_ws(
        ":", x.kind, x.s.cast("string"), x.e.cast("string"))), ",")


def find_personal_data(df: DataFrame, text: str = "text", min_support: int = 3, confidence: float = 0.8,
                       min_length: int = 6, neutral: float = 0.5) -> DataFrame:
    """Spans of every row: ``(r1, r2, spans)`` with ``spans`` an array of (kind, s, e, hit).

    ``df`` carries the row key ``r1, r2``. Offsets count code points, ends exclusive.
    """
    rows = df.select("r1", "r2", F.coalesce(F.col(text), F.lit("")).alias("t"))
    base = checkpointed(base_spans(rows, "t").withColumn("context", _context(F.col("before")))
                        .drop("before"))
    tokens = _matches(rows, "t", CANDIDATE, "[0-9]").filter(F.length("hit") >= min_length)
    candidates = checkpointed(_outside(tokens, base).withColumn("context", _context(F.col("before")))
                              .drop("before"))
    shaped = F.col("hit").rlike(SECRET)
    seeds = base.select("kind", "context", "hit").unionByName(
        candidates.filter(shaped).select(F.lit("secret").alias("kind"), "context", "hit"))
    patterns = bootstrap(seeds, candidates.filter(~shaped), min_support, confidence, neutral)
    found = (candidates.join(patterns.select("kind", "context"), "context")
                       .select("r1", "r2", F.concat(F.lit("found_"), "kind").alias("kind"), "s", "e", "hit"))
    every = base.select("r1", "r2", "kind", "s", "e", "hit").unionByName(found)
    return every.groupBy("r1", "r2").agg(F.collect_list(F.struct("kind", "s", "e", "hit")).alias("spans"))


def annotate(df: DataFrame, text: str = "text", **settings) -> DataFrame:
    """The input with counts per base kind, the digest of base spans, all spans written out, and
    how many the method found (``n_found``) and there are in all (``n_spans``)."""
    df = df.drop(*RESULTS)
    named = {c: f"_c{i}" for i, c in enumerate(df.columns)}
    rows = df.select(*[F.col(c).alias(a) for c, a in named.items()], *row_key(df, *df.columns))
    spans = find_personal_data(rows, named[text], **settings)
    out = rows.join(spans, ["r1", "r2"], "left")
    every = F.coalesce("spans", F.array().cast("array<struct<kind:string,s:bigint,e:bigint,hit:string>>"))
    base = F.filter(every, lambda x: x.kind.isin(*KINDS))
    return out.select(
        *[F.col(a).alias(c) for c, a in named.items()],
        *[F.size(F.filter(every, _is(k))).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_digest(base), 256).alias("base_sha256"), _digest(every).alias("spans"),
        (F.size(every) - F.size(base)).cast("long").alias("n_found"), F.size(every).cast("long").alias("n_spans"))
