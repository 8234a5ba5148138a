"""Quality rules: thresholds from mergeable quantile sketches (operator 1).

Method.  Every document gets five measures (JVM expressions only).  For each
(language, source) a quantile sketch per measure counts log-scaled buckets,
``floor(ln(1 + v) * 50)``: relative error about 1 %, at most a few hundred
buckets, and merging two sketches is adding their counts, so the partial
aggregates of tasks, sources and languages all combine exactly and in any
order.  From each sketch comes a Tukey fence on the measure's own scale: with
the outer edges of the quartiles' buckets, ``q75 + 3 * (q75 - q25)`` (and
``q25 - 3 * (q75 - q25)`` for word length).  Where the quartiles share a
bucket, as for a rate that most documents have at 0, they say nothing of the
spread; the fence is then ``q90 + 3 * (q90 - q50)`` (and ``q10 - 3 * (q50 -
q10)``).  Sources with fewer than ``min_rows`` documents borrow the merged
sketch of their language, and below that the merged sketch of the corpus.  The
fences are joined back and a document is kept if it passes the base rules and
no measure lies outside its fence.  The only slack is a bucket's width, and one
occurrence in rates: a short document cannot show a smaller rate above 0.

Limits.  A group in which over a tenth of the documents are spoiled (a quarter,
where the quartiles differ) takes that for its own spread.

Windows of three words are compared within one document by 64-bit hash; in a
document of 100,000 words the chance of any wrong match is below 1e-9.

Cases.  Null or empty text: no words, all counts 0, ``base_failed``.  Null
language or source: a group of its own.  Repeated rows: each is judged, and
each counts in the sketch.  Empty table: empty result.  Input columns named
like a result column are replaced by it.

``as_sql`` judges by the formula of the query's SQL instead, which takes the
spread between buckets and never goes below the slack in ``MEASURES``: there,
quartiles of 0 and 6 per mille give a fence beyond 1000 per mille, and where
the quartiles coincide the slack alone decides.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetline.llm.common import attach, materialize, packed, quoted, unpacked, words

BUCKETS_PER_E = 50
FENCE = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_ROWS = 200


@dataclass(frozen=True)
class Measure:
    """``top``: by the SQL, upper fences are at least this value; ``bottom``:
    by the SQL, lower fences are at most this one (None: no lower fence);
    ``rate``: a rate's count, what one occurrence adds to it, and its whole."""
    name: str
    top: int
    bottom: int | None = None
    rate: tuple[str, int, str] | None = None


MEASURES = (
    # symbols per 1000 word characters
    Measure("symbols_pm", 100, rate=("n_symbols", 1, "word_chars")),
    # repeated lines per 1000 lines
    Measure("dup_lines_pm", 500, rate=("n_dup_lines", 1, "n_lines")),
    # words in repeated windows per 1000 words
    Measure("repeat_words_pm", 300, rate=("n_repeat_words", 6, "n_words")),
    # ten times the mean word length
    Measure("word_length_10", 120, 25),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def bucket(value: Column) -> Column:
    return F.floor(F.log(value.cast("double") + 1.0) * F.lit(float(BUCKETS_PER_E))).cast("int")


def bucket_of(value: int) -> int:
    return math.floor(math.log(value + 1) * BUCKETS_PER_E)


def edge(place: Column) -> Column:
    """Lower edge of a bucket, on the measure's scale."""
    return F.exp(place / F.lit(float(BUCKETS_PER_E))) - 1.0


def per(part: Column, whole: Column, scale: int) -> Column:
    return F.when(whole > 0, F.floor(part * scale / whole)).otherwise(F.lit(0)).cast("long")


def measured(rows: DataFrame, text: Column) -> DataFrame:
    """The base counts of ``text`` and the derived measures, as columns
    beside those of ``rows``."""
    step = rows.withColumn("_w", words(text)).withColumn("_l", F.filter(
        F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    n = F.size("_w")
    starts = F.slice("_w", F.lit(1), F.greatest(n - 2, F.lit(0)))
    step = step.withColumn("_g", F.transform(
        starts, lambda x, i: F.xxhash64(x, F.get("_w", i + 1), F.get("_w", i + 2))))
    # Most documents repeat no window; only the others sort theirs.
    step = step.withColumn("_s", F.when(
        F.size(F.array_distinct("_g")) < F.size("_g"),
        F.sort_array(F.transform("_g", lambda g, i: F.struct(g.alias("g"), i.alias("p"))))))
    repeated = F.filter("_s", lambda s, i: s["g"].eqNullSafe(F.get("_s", i - 1)["g"])
                        | s["g"].eqNullSafe(F.get("_s", i + 1)["g"]))
    covered = F.coalesce(F.size(F.array_distinct(F.flatten(F.transform(
        repeated, lambda s: F.array(s["p"], s["p"] + 1, s["p"] + 2))))), F.lit(0))
    lines = F.coalesce(F.size("_l"), F.lit(0))
    step = step.select(
        *[F.col(quoted(c)) for c in rows.columns],
        n.cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.coalesce(F.regexp_count(text, F.lit(r"[#*$%&|<>]")), F.lit(0)).cast("long").alias("n_symbols"),
        F.when(F.col("_l").isNull(), 0).otherwise(F.size("_l") - F.size(F.array_distinct("_l")))
        .cast("long").alias("n_dup_lines"),
        F.greatest(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.when(F.col("_l").isNull(), 0).otherwise(lines).cast("long").alias("n_lines"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return step.select(
        "*", failed.alias("base_failed"),
        per(F.col("n_symbols"), F.col("word_chars"), 1000).alias("symbols_pm"),
        per(F.col("n_dup_lines"), F.col("n_lines"), 1000).alias("dup_lines_pm"),
        per(F.col("n_repeat_words"), F.col("n_words"), 1000).alias("repeat_words_pm"),
        per(F.col("word_chars"), F.col("n_words"), 10).alias("word_length_10"))


def sketches(scored: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n) over documents that pass the base
    rules; adding ``n`` merges sketches."""
    entries = F.explode(F.array(*[
        F.struct(F.lit(i).alias("measure"), bucket(F.col(m.name)).alias("bucket"))
        for i, m in enumerate(MEASURES)]))
    return (scored.filter(~F.col("base_failed"))
            .select(F.col("_lang"), F.col("_source"), entries.alias("e"))
            .groupBy("_lang", "_source", "e.measure", "e.bucket")
            .agg(F.count(F.lit(1)).alias("n")))


def fences(sketch: DataFrame, keys: list[str], as_sql: bool = False) -> DataFrame:
    """Fences per group of ``keys``: one row per group, columns
    ``lo_<i>``/``hi_<i>`` per measure (values; buckets if ``as_sql``) and the
    number of documents."""
    merged = sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*keys, "measure")
    upto = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = merged.select("*", F.sum("n").over(upto).alias("cum"), F.sum("n").over(whole).alias("total"))
    quantile = lambda q: F.min(F.when(F.col("cum") * 100 >= F.col("total") * q, F.col("bucket")))
    quartiles = ranked.groupBy(*keys, "measure").agg(
        *[quantile(q).alias(f"q{q}") for q in (10, 25, 50, 75, 90)], F.max("total").alias("total"))
    if as_sql:
        spread = F.col("q75") - F.col("q25")
        top, bottom = F.col("q75") + FENCE * spread, F.col("q25") - FENCE * spread
    else:
        below, above = (lambda q: edge(F.col(q))), (lambda q: edge(F.col(q) + 1))
        apart = F.col("q25") < F.col("q75")
        spread = above("q75") - below("q25")
        top = F.when(apart, above("q75") + FENCE * spread).otherwise(
            above("q90") + FENCE * (above("q90") - below("q50")))
        bottom = F.when(apart, below("q25") - FENCE * spread).otherwise(
            below("q10") - FENCE * (above("q50") - below("q10")))
    cols = []
    for i, m in enumerate(MEASURES):
        mine = F.col("measure") == i
        hi = F.greatest(top, F.lit(bucket_of(m.top))) if as_sql else top
        cols.append(F.max(F.when(mine, hi)).alias(f"hi_{i}"))
        if m.bottom is not None:
            lo = F.least(bottom, F.lit(bucket_of(m.bottom))) if as_sql else bottom
            cols.append(F.max(F.when(mine, lo)).alias(f"lo_{i}"))
    return quartiles.groupBy(*keys).agg(F.max("total").alias("rows"), *cols)


def judge(docs: DataFrame, min_rows: int = MIN_ROWS, as_sql: bool = False) -> DataFrame:
    """All rows of ``docs`` (columns ``text``, ``lang``, ``source`` used) with
    the base counts, ``base_failed``, the measures and ``kept``."""
    rows = packed(docs)
    scored = materialize(
        measured(rows, F.col("in_text")).select(
            "*", F.col("in_lang").alias("_lang"), F.col("in_source").alias("_source")), "quality")
    sketch = materialize(sketches(scored), "quality-sketch")
    values = [f"hi_{i}" for i in range(len(MEASURES))] + [
        f"lo_{i}" for i, m in enumerate(MEASURES) if m.bottom is not None]
    level = lambda frame, tag: frame.withColumnsRenamed(
        {c: f"{tag}_{c}" for c in ["rows", *values]})
    own = level(fences(sketch, ["_lang", "_source"], as_sql), "s")
    by_lang = level(fences(sketch, ["_lang"], as_sql), "l").withColumnRenamed("_lang", "_lang_l")
    corpus = level(fences(sketch.withColumn("_all", F.lit(1)), ["_all"], as_sql), "c")
    table = (own.join(by_lang, F.col("_lang").eqNullSafe(F.col("_lang_l")), "left")
             .withColumn("_all", F.lit(1)).join(corpus, "_all"))
    pick = [F.when(F.col("s_rows") >= min_rows, F.col(f"s_{v}"))
            .when(F.col("l_rows") >= min_rows, F.col(f"l_{v}"))
            .otherwise(F.col(f"c_{v}")).alias(f"_f_{v}") for v in values]
    table = materialize(table.select("_lang", "_source", *pick), "quality-fences")
    judged = attach(scored, table, ["_lang", "_source"], F.xxhash64("n_words", "word_chars"))
    inside = F.lit(True)
    for i, m in enumerate(MEASURES):
        v = top = bucket(F.col(m.name)) if as_sql else F.col(m.name)
        if m.rate and not as_sql:
            count, one, whole = m.rate
            top = per(F.col(count) - one, F.col(whole), 1000)
        inside = inside & (top <= F.col(f"_f_hi_{i}"))
        if m.bottom is not None:
            inside = inside & (v >= F.col(f"_f_lo_{i}"))
    new = [*COUNTS, "n_lines", "base_failed", *[m.name for m in MEASURES], "kept"]
    return (judged.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))
            .select(*unpacked(docs.columns, new)))
