"""Distributed running sums and ranks (no single-task window over the data).

A plain ``Window.orderBy(x)`` without ``partitionBy`` moves every row to one
task. The primitives here instead:

1. reduce the input to one row per distinct order value (grouped aggregate,
   map-side partial aggregation, so a hot value collapses early);
2. cut the order into ``n_buckets`` ranges whose edges come from one
   ``percentile_approx`` pass over the distinct values (a bounded array, the
   only thing the driver receives). The bucket is a pure function of the
   value, so recomputation after an executor loss lands rows in the same
   bucket, and equal values always share a bucket;
3. total each bucket (at most ``n_buckets`` rows), prefix-sum those totals
   on that small table and broadcast it back (its size is bounded by the
   bucket count, not by the data);
4. finish with a window *partitioned by bucket*.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 1024
INF = float("inf")


def quantile_edges(df: DataFrame, col: str, n_buckets: int,
                   accuracy: int = 10000) -> list[float]:
    """Approximate quantile edges of ``col`` (driver receives at most
    ``n_buckets - 1`` doubles)."""
    if n_buckets <= 1:
        return []
    fracs = [i / n_buckets for i in range(1, n_buckets)]
    row = df.select(F.percentile_approx(F.col(col).cast("double"), fracs, accuracy)
                    .alias("e")).first()
    edges = row["e"] if row is not None and row["e"] is not None else []
    return sorted({float(e) for e in edges if e is not None})


def add_bucket(df: DataFrame, col: str, edges: list[float], out: str = "bucket") -> DataFrame:
    """Range bucket of ``col`` by literal edges (binary search, JVM side)."""
    inner = [e for e in edges if e not in (-INF, INF)]
    if not inner:
        return df.withColumn(out, F.lit(0))
    splits = [-INF] + inner + [INF]
    tmp = f"__{out}_in"
    bucketizer = Bucketizer(splits=splits, inputCol=tmp, outputCol=out, handleInvalid="keep")
    return (bucketizer.transform(df.withColumn(tmp, F.col(col).cast("double")))
            .withColumn(out, F.col(out).cast("int")).drop(tmp))


def running_totals(per_value: DataFrame, order_col: str, sum_cols: list[str],
                   descending: bool = True, n_buckets: int = DEFAULT_BUCKETS,
                   prefix: str = "cum_", edges: list[float] | None = None) -> DataFrame:
    """Inclusive running sums of ``sum_cols`` over ``per_value`` ordered by
    ``order_col`` (one row per distinct ``order_col`` expected), plus the
    grand totals as ``total_<col>``.

    Adds ``cum_<col>`` for each column and ``row_index`` (0-based position in
    the order).

    ``edges`` may come from the rows before grouping (a sketch aggregate with
    no shuffle): row-weighted edges put at most about n / n_buckets rows, and
    so at most that many distinct values, in each bucket.
    """
    if edges is None:
        edges = quantile_edges(per_value, order_col, n_buckets)
    b = add_bucket(per_value, order_col, edges)
    totals = b.groupBy("bucket").agg(F.count(F.lit(1)).alias("__rows"),
                                     *[F.sum(c).alias(f"__t_{c}") for c in sum_cols])
    # Prefix over the small bucket table (at most n_buckets rows).
    border = F.desc("bucket") if descending else F.asc("bucket")
    before = Window.orderBy(border).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(border).rowsBetween(Window.unboundedPreceding,
                                                    Window.unboundedFollowing)
    offsets = totals.select(
        "bucket",
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__off_rows"),
        *[F.coalesce(F.sum(f"__t_{c}").over(before), F.lit(0)).alias(f"__off_{c}")
          for c in sum_cols],
        *[F.sum(f"__t_{c}").over(everything).alias(f"total_{c}") for c in sum_cols],
    )
    vorder = F.desc(order_col) if descending else F.asc(order_col)
    within = Window.partitionBy("bucket").orderBy(vorder).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    joined = b.join(F.broadcast(offsets), "bucket")
    return joined.select(
        *per_value.columns, "bucket",
        (F.col("__off_rows") + F.row_number().over(Window.partitionBy("bucket").orderBy(vorder))
         - 1).alias("row_index"),
        *[(F.col(f"__off_{c}") + F.sum(c).over(within)).alias(f"{prefix}{c}") for c in sum_cols],
        *[F.col(f"total_{c}") for c in sum_cols],
    )


def next_row(ordered: DataFrame, cols: list[str], index_col: str = "row_index",
             prefix: str = "next_", bucket_col: str = "bucket") -> DataFrame:
    """Attach the following row's ``cols``. Inside a bucket it is the window's
    ``lead``; a bucket's last row gets the first row of the next bucket from a
    table with one row per bucket (at most ``n_buckets`` rows, broadcast)."""
    here = F.struct(*[F.col(c).alias(c) for c in cols])
    firsts = ordered.groupBy(bucket_col).agg(F.min(index_col).alias("__at"),
                                             F.min_by(here, F.col(index_col)).alias("__first"))
    carry = firsts.select(bucket_col, F.lead("__first").over(Window.orderBy("__at")).alias("__carry"))
    following = F.lead(here).over(Window.partitionBy(bucket_col).orderBy(index_col))
    return (ordered.join(F.broadcast(carry), bucket_col)
            .withColumn("__next", F.coalesce(following, F.col("__carry")))
            .select(*ordered.columns, *[F.col(f"__next.{c}").alias(f"{prefix}{c}") for c in cols]))


def order_statistics(ranked: DataFrame, col: str, probs: list[float]) -> list[float | None]:
    """Quantiles with linear interpolation between order statistics (the
    'linear' rule of the common numeric libraries) from a running-count table:
    one row per distinct ``col`` with ``n``, ``cum_n`` and ``total_n``. One
    pass finds all ranks; two values per probability reach the driver."""
    if not probs:
        return []
    total, wanted = F.col("total_n"), []
    for i, q in enumerate(probs):
        low = F.floor((total - 1) * F.lit(float(q)))
        wanted += [F.struct(F.lit(2 * i).alias("i"), low.alias("rank")),
                   F.struct(F.lit(2 * i + 1).alias("i"), F.least(low + 1, total - 1).alias("rank"))]
    inside = F.filter(F.array(*wanted), lambda w: (w["rank"] >= F.col("cum_n") - F.col("n")) & (w["rank"] < F.col("cum_n")))
    found = ranked.select(F.col(col).cast("double").alias("v"), "total_n", F.explode(inside).alias("w")).select(
        "v", "total_n", "w.i").collect()
    if not found:
        return [None for _ in probs]
    value, n, out = {r["i"]: r["v"] for r in found}, found[0]["total_n"], []
    for i, q in enumerate(probs):
        a, b, t = value[2 * i], value[2 * i + 1], (n - 1) * q % 1
        out.append(a + (b - a) * t if t < 0.5 else b - (b - a) * (1 - t))
    return out


def count_less_than(x: Column, edges: list[float]) -> Column:
    """Number of literal edges strictly below ``x`` (a left-sided search)."""
    out = F.lit(0)
    for e in edges:
        out = out + (x > F.lit(float(e))).cast("int")
    return out
