"""Order-dependent operators that stay parallel under key skew.

Spark's window functions put every row of a ``PARTITION BY`` key into one
task.  When a key can hold a large share of the data (one device, one source
partition), the operators here split the key by an order-monotone *chunk*
column, compute a per-chunk summary with a partial aggregation, carry the
summaries across chunks on the (small) chunk table, and finish inside each
chunk.  The result is the same as the single-window form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


def dense_sequence(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                   chunk: Column, out: str, start: int = 0) -> DataFrame:
    """``row_number() - 1 + start`` within ``keys`` ordered by ``order``.

    ``chunk`` must be non-decreasing along ``order`` inside a key (for example
    a time bucket of the first order column).  Rows are numbered inside each
    ``(key, chunk)`` and offset by the row count of the earlier chunks.
    """
    keys = list(keys)
    with_chunk = df.withColumn("_chunk", chunk)
    counts = with_chunk.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = counts.select(*keys, "_chunk",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*_cols(order))
    numbered = with_chunk.withColumn("_local", F.row_number().over(inside))
    return (numbered.join(starts, [*keys, "_chunk"])
            .withColumn(out, (F.col("_start") + F.col("_local") - 1 + start).cast("bigint"))
            .drop("_chunk", "_start", "_local"))


def running_max_before(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                       chunk: Column, value: Column, out: str) -> DataFrame:
    """Maximum of ``value`` over the rows *before* each row (exclusive prefix).

    ``value`` may be a struct, which makes this a running arg-max.  Equal to
    ``max(value) OVER (PARTITION BY keys ORDER BY order ROWS BETWEEN UNBOUNDED
    PRECEDING AND 1 PRECEDING)`` but a hot key is spread over its chunks.
    """
    keys = list(keys)
    staged = df.withColumn("_chunk", chunk).withColumn("_v", value)
    per_chunk = staged.groupBy(*keys, "_chunk").agg(F.max("_v").alias("_chunk_max"))
    earlier_chunks = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    carried = per_chunk.select(*keys, "_chunk",
                               F.max("_chunk_max").over(earlier_chunks).alias("_carry"))
    earlier_rows = Window.partitionBy(*keys, "_chunk").orderBy(*_cols(order)).rowsBetween(
        Window.unboundedPreceding, -1)
    local = staged.withColumn("_local", F.max("_v").over(earlier_rows))
    return (local.join(carried, [*keys, "_chunk"])
            .withColumn(out, F.greatest("_carry", "_local"))
            .drop("_chunk", "_v", "_carry", "_local"))


def running_sums(df: DataFrame, keys: Sequence[str], position: str, chunk_width: int,
                 values: dict[str, Column]) -> DataFrame:
    """Sums of ``values`` over the rows at or before each row's ``position``.

    ``values`` maps output columns to summed columns; ``position`` is an
    integer column, rows of equal position see each other.  Equal to
    ``sum(v) OVER (PARTITION BY keys ORDER BY position RANGE UNBOUNDED
    PRECEDING)``, nulls as 0, but a hot key is spread over its position chunks.
    The frame only grows, so the work is linear.  Give decimals or integers: both sides
    of the split are then exact.
    """
    keys = list(keys)
    staged = df.withColumn("_chunk", F.floor(F.col(position) / F.lit(chunk_width))) \
        .withColumns({f"_v_{n}": c for n, c in values.items()})
    per_chunk = staged.groupBy(*keys, "_chunk").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in values])
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_chunk.select(*keys, "_chunk", *[F.sum(f"_t_{n}").over(earlier).alias(f"_c_{n}") for n in values])
    upto = Window.partitionBy(*keys, "_chunk").orderBy(position).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = staged.select("*", *[F.sum(f"_v_{n}").over(upto).alias(f"_l_{n}") for n in values])
    return (local.join(carried, [*keys, "_chunk"])
            .withColumns({n: F.coalesce(F.col(f"_c_{n}"), F.lit(0)) + F.coalesce(F.col(f"_l_{n}"), F.lit(0))
                          for n in values})
            .drop("_chunk", *[f"_{p}_{n}" for p in "vlc" for n in values]))


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
                    salt: Column, rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..k per key by ``order`` (descending etc. in ``order``).

    A first pass keeps the top ``k`` of every ``(key, salt)`` sub-group, so no
    task sees more than one salt slice of a hot key; the second pass ranks
    at most ``k * salts`` rows per key.  ``order`` must be a total order
    (include a unique tie-breaker) for the result to be deterministic.
    """
    keys = list(keys)
    first = Window.partitionBy(*keys, salt).orderBy(*order)
    reduced = (df.withColumn("_r", F.row_number().over(first))
               .filter(F.col("_r") <= k).drop("_r"))
    final = Window.partitionBy(*keys).orderBy(*order)
    return (reduced.withColumn(rank_col, F.row_number().over(final))
            .filter(F.col(rank_col) <= k))


def later_in_band(rows: DataFrame, point: Column, keys: Sequence[str], id_col: str, order: Sequence[str],
                  position: str, width: int, values: dict[str, Column]) -> DataFrame:
    """Per row: sums of ``values`` over the points (rows where ``point`` holds)
    that come *later* in ``order`` and whose ``position`` lies in
    ``[p - width, p]``; rows without such a point may be left out.

    Two-dimensional dominance sums by merge levels.  Rows are grouped by
    (key, bucket of ``width`` positions); a point joins its own and the next
    bucket's group, so a band never leaves a group.  Members of a group are
    ranked by ``order``.  At level l the group is cut into blocks of 2^l ranks:
    two members lie in neighbouring blocks of one pair at exactly one level,
    the later one on the right.  So on every level the points of the right
    block are summed along ``position`` up to each query of the left block,
    once up to ``p`` and once up to just before ``p - width``.  n members of
    groups that have a point cost n log n rows however disordered they are,
    where a join of later with earlier rows costs up to n^2.  A group is one
    key's rows of two buckets: what a task sorts does not grow with the span
    of the data.  ``rows`` is read once; values must be decimals or integers.
    """
    keys, order, group = list(keys), list(order), [*keys, "_bucket"]
    bucket = F.floor(F.col(position) / F.lit(width)).cast("bigint")
    members = rows.select(
        *keys, id_col, *order, F.col(position).alias("_at"), F.coalesce(point, F.lit(False)).alias("_point"),
        bucket.alias("_own"), *[c.alias(f"_p_{n}") for n, c in values.items()]) \
        .withColumn("_bucket", F.explode(F.when(F.col("_point"), F.array("_own", F.col("_own") + 1))
                                         .otherwise(F.array("_own"))))
    whole, arrived = Window.partitionBy(*group), F.struct(*order)
    ranked = members.select(
        "*", (F.row_number().over(whole.orderBy(*order)) - 1).cast("bigint").alias("_rank"),
        F.count(F.lit(1)).over(whole).alias("_n"), F.min(F.when(F.col("_point"), F.col("_at"))).over(whole).alias("_from"),
        F.max(F.when(F.col("_point"), arrived)).over(whole).alias("_last"))
    asks = (F.col("_bucket") == F.col("_own")) & (F.col("_at") >= F.col("_from")) & (arrived < F.col("_last"))
    levels = F.sequence(F.lit(0), F.ceil(F.log2("_n")).cast("int") - 1)
    leveled = ranked.withColumn("_query", asks).filter("_n > 1 and (_point or _query)") \
        .withColumn("_level", F.explode(levels))
    right = F.expr("getbit(_rank, _level)") == 1
    entry = lambda sign, at: F.struct(F.lit(sign).alias("_sign"), at.alias("_where"))
    entries = F.when(right & F.col("_point"), F.array(entry(0, F.col("_at")))) \
        .when(~right & F.col("_query"), F.array(entry(1, F.col("_at")), entry(-1, F.col("_at") - width - 1)))
    placed = leveled.withColumn("_pair", F.expr("shiftright(_rank, _level + 1)")) \
        .withColumn("_e", F.explode(entries)).select("*", "_e.*")
    upto = Window.partitionBy(*group, "_level", "_pair").orderBy("_where").rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    sums = placed.select(id_col, "_sign", *[
        F.sum(F.when(F.col("_sign") == 0, F.col(f"_p_{n}"))).over(upto).alias(f"_s_{n}") for n in values])
    return sums.filter("_sign <> 0").groupBy(id_col).agg(
        *[F.sum(F.when(F.col("_sign") == 1, F.col(f"_s_{n}")).otherwise(-F.col(f"_s_{n}"))).alias(n) for n in values])
