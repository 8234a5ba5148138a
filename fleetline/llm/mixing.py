"""Mixing sources by a time-varying curriculum (operator 7).

Method.  Targets: the sources, ordered by code point with null last, weigh
``weights`` in turn and share ``demand`` times all words; a target stops at
``repeat_cap`` times its source's words and the excess is shared again by
weight (closed form of the water-filling: sort by cap per weight, take the
first level that its source does not reach).  Whole copies: every document is
taken ``floor(target / size)`` times, and the documents of a prefix, in hash
order, once more, up to the target (the last one if half of it fits).

Curriculum.  A schedule says how a source's weight moves over training time
[0, 1], as equally spaced knots joined by straight lines.  Its integral is the
cumulative demand, a piecewise quadratic that is inverted in closed form: a
copy whose middle word is at fraction ``q`` of its source's stream trains at
the time ``t`` with ``integral(0..t) = q * integral(0..1)``.  ``schedule``
range-sorts the copies by that time.

Scale.  Running sums never put a source into one task: hash order is cut into
buckets of about ``BUCKET_ROWS`` rows, their sums are carried over on the
bucket table, and only a bucket's rows are windowed.  Nothing is drawn at
random, so reruns agree.  The table with one row per source is ordered in one
task; it holds no documents.

Cases.  Null or empty text: size 0, taken 0, no copy.  Null source: a source
of its own, last.  Repeated rows are separate documents with neighbouring
places.  Empty table: empty result.  Input columns named like a result column
are replaced by it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetline.llm.common import attach, materialize, packed, unpacked

WEIGHTS = (3.0, 1.0, 2.0)
#: Knots of the sources' schedules, in turn: fading out, even, fading in.
SCHEDULES = ((1.5, 1.0, 0.5), (1.0, 1.0, 1.0), (0.5, 1.0, 1.5))
DEMAND = 1.5
REPEAT_CAP = 2
BUCKET_ROWS = 2_000
NEW = ["size", "source_size", "target", "copies", "taken", "position"]


def sized(docs: DataFrame) -> DataFrame:
    order = F.md5(F.coalesce(F.col("in_doc_id").cast("string"), F.lit("")))
    return packed(docs).select(
        "*", F.col("in_source").alias("source"), F.col("in_doc_id").alias("_id"),
        F.coalesce(F.regexp_count(F.col("in_text"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
        .cast("long").alias("size"), order.alias("_order"))


def targets(sources: DataFrame, weights: Sequence[float], demand: float, cap: int) -> DataFrame:
    """(source, n, source_size, turn, target) from (source, n, source_size)."""
    ranked = sources.withColumn("turn", F.row_number().over(
        Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          F.pmod("turn", F.lit(len(weights))).cast("int") + 1)
    ranked = ranked.withColumn("_weight", weight).withColumn(
        "_level", F.col("source_size") * cap / F.col("_weight"))
    by_level = Window.orderBy("_level", "turn")
    whole = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    full = F.coalesce(F.sum("source_size").over(by_level.rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)) * cap
    rest = F.sum("_weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(whole) * demand - full) / rest
    ranked = ranked.withColumn("_try", level)
    found = F.min(F.when(F.col("_try") <= F.col("_level"), F.struct("_level", "turn", "_try"))).over(whole)
    return ranked.withColumn("_found", found).select(
        "source", "n", "source_size", "turn",
        F.least((F.col("source_size") * cap).cast("double"),
                F.coalesce(F.col("_found._try") * F.col("_weight"), F.lit(float("inf")))).alias("target"))


def inverted(q: Column, knots: Sequence[float]) -> Column:
    """Time at which a schedule has used the fraction ``q`` of its integral."""
    step = 1.0 / (len(knots) - 1)
    area = [(a + b) / 2 * step for a, b in zip(knots, knots[1:])]
    total, done, out = sum(area), 0.0, None
    for i, part in enumerate(area):
        a, b = knots[i], knots[i + 1]
        need = F.greatest(q * F.lit(total) - F.lit(done), F.lit(0.0))
        # a*x + (b-a)/(2*step)*x^2 = need, in the form that holds for b = a.
        root = F.sqrt(F.greatest(F.lit(a * a) + F.lit(2 * (b - a) / step) * need, F.lit(0.0)))
        x = F.when(root + a > 0, 2 * need / (root + a)).otherwise(F.lit(0.0))
        at = F.lit(i * step) + F.least(x, F.lit(step))
        out = F.when(q * F.lit(total) <= F.lit(done + part), at) if out is None else (
            out.when(q * F.lit(total) <= F.lit(done + part), at))
        done += part
    return out.otherwise(F.lit(1.0))


def _placed(docs: DataFrame, weights, schedules, demand, cap, bucket_rows) -> DataFrame:
    rows = sized(docs)
    keys = materialize(rows.select("source", "size", "_order"), "mix-sizes")
    sources = materialize(keys.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size")), "mix-sources")
    plan = materialize(targets(sources, weights, demand, cap), "mix-targets")
    share = F.conv(F.substring("_order", 1, 12), 16, 10).cast("double") / float(16 ** 12)
    bucket = F.floor(share * F.ceil(F.col("n") / bucket_rows)).cast("long")
    salt = F.xxhash64("_order")
    in_buckets = attach(keys, plan.select("source", "n"), ["source"], salt).withColumn("_bucket", bucket)
    sums = in_buckets.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum"))
    carried = sums.select("source", "_bucket", F.coalesce(F.sum("_sum").over(
        Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_carry"))
    carried = materialize(carried, "mix-buckets")
    placed = attach(rows, plan, ["source"], salt).withColumn("_bucket", bucket)
    inside = Window.partitionBy("source", "_bucket").orderBy("_order", "_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    placed = placed.withColumn("_upto", F.sum("size").over(inside))
    placed = attach(placed, carried, ["source", "_bucket"], salt)
    before = F.col("_carry") + F.col("_upto") - F.col("size")
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    placed = placed.withColumn("_before", before).withColumn("_times", F.least(times, F.lit(cap)).cast("long"))
    wanted = F.col("target") - F.col("_times") * F.col("source_size")
    extra = (F.col("_times") < cap) & (F.col("_before") + F.col("size") / 2 <= wanted)
    copies = F.when(F.col("size") > 0, F.col("_times") + extra.cast("long")).otherwise(F.lit(0))
    return placed.withColumn("copies", copies.cast("long")).withColumn(
        "taken", (F.col("copies") * F.col("size")).cast("long"))


def position(copy: Column, schedules) -> Column:
    """Training time of a document's ``copy``-th copy (from 0)."""
    middle = copy * F.col("source_size") + F.col("_before") + F.col("size") / 2
    q = F.least(middle / F.col("target"), F.lit(1.0))
    turn = F.pmod("turn", F.lit(len(schedules)))
    at = F.coalesce(*[F.when(turn == i, inverted(q, knots)) for i, knots in enumerate(schedules)])
    return F.when(F.col("copies") > copy, at)


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, schedules=SCHEDULES,
        demand: float = DEMAND, cap: int = REPEAT_CAP, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """All rows of ``docs`` (``doc_id``, ``text``, ``source`` used) with size,
    source_size, target, copies, taken and the first copy's position."""
    placed = _placed(docs, weights, schedules, demand, cap, bucket_rows)
    return placed.withColumn("position", position(F.lit(0), schedules)).select(
        *unpacked(docs.columns, NEW))


def _stream(placed: DataFrame, schedules) -> DataFrame:
    """A row per copy with its ``copy`` number and position, and one with
    neither for a document that the mix leaves out."""
    numbers = F.when(F.col("copies") > 0, F.sequence(F.lit(0), F.col("copies").cast("int") - 1))
    copies = placed.withColumn("copy", F.explode_outer(numbers))
    return copies.withColumn("position", position(F.col("copy"), schedules))


def schedule(docs: DataFrame, weights: Sequence[float] = WEIGHTS, schedules=SCHEDULES,
             demand: float = DEMAND, cap: int = REPEAT_CAP, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The training stream: a row per copy, range-sorted by its position."""
    copies = _stream(_placed(docs, weights, schedules, demand, cap, bucket_rows).filter("copies > 0"), schedules)
    return (copies.select(*unpacked(docs.columns, [*NEW, "copy"]))
            .repartitionByRange("position", "doc_id", "copy")
            .sortWithinPartitions("position", "doc_id", "copy"))


def training_order(docs: DataFrame, weights: Sequence[float] = WEIGHTS, schedules=SCHEDULES,
                   demand: float = DEMAND, cap: int = REPEAT_CAP, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The training stream without texts: every copy (its document's numbers,
    ``copy``, ``position``), range-sorted by position, and after them the
    documents that the mix leaves out (null copy and position)."""
    placed = _placed(docs, weights, schedules, demand, cap, bucket_rows).select(
        F.col("_id").alias("doc_id"), "size", "source_size", "target", "copies", "turn", "_before")
    stream = materialize(_stream(placed, schedules), "mix-stream")       # read twice: for the ranges, to sort
    return materialize(stream.withColumn("_last", F.col("position").isNull())
                       .repartitionByRange("_last", "position", "doc_id", "copy")
                       .sortWithinPartitions("_last", "position", "doc_id", "copy"), "mix-order")


def folded(stream: DataFrame) -> DataFrame:
    """A row per document of :func:`training_order`, from its copies there: the
    words it takes, the first copy's position and all positions.

    ``turn`` and ``_before``, its words' place in the source's stream, name a
    document that has words; those without are counted, as equal rows are alike."""
    keys = ["turn", "_before", "doc_id", "size", "source_size", "target"]
    per = stream.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(F.col("copy").isNotNull(), F.col("size"))), F.lit(0)).cast("long").alias("taken"),
        F.min("position").alias("position"), F.array_sort(F.collect_list("position")).alias("positions"),
        F.when(F.col("size") > 0, 1).otherwise(F.count(F.lit(1))).cast("int").alias("_rows"))
    return per.withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("_rows")))).drop("_rows", "_row")
