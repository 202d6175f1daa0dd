"""Splitting S1-S3: features/target, repeatable stratified holdout, folds.

The order inside each class is ``md5('<id>:<seed>')`` then the id: a pure
function of the row, so the split does not depend on partitioning, task
order or recomputation after an executor loss (``randomSplit`` and
``sampleBy`` do, and ``sampleBy`` is not exact).

Ranks are computed without a class-wide window, by radix refinement. The order
is written as one text of hexadecimal digits (md5 key, then whether there is
an id, then a hash of the row). Rows are counted by class and the first
digits; a range with more rows than one rank task may hold is opened: its
rows are counted again by more digits, from the first digit in which they
differ. That goes on until no range is too full, which for ids without
repetition is at once. Ranges never overlap, so the running sum of their
counts gives each its offset, and the final ``row_number`` runs in a window
partitioned by (class, range). A class, or an id, that holds most rows is
therefore spread over many tasks; only rows equal in every column, which no
order tells apart, share a range of any size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quaybook.config import CV_FOLDS, SEED, TEST_SIZE
from quaybook.plans.stages import write_stage

RADIX_DIGITS = 3  # hexadecimal digits that a range is opened by
DEFAULT_MAX_BUCKET_ROWS = 2_000_000  # rows one rank task may hold


def features_and_target(df: DataFrame, target: str = "no_show",
                        label: str = "label") -> DataFrame:
    """Keep every feature column and carry the target as an integer
    ``label`` column (no separate vector object)."""
    return df.withColumn(label, F.col(target).cast("int")).drop(target)


def order_key(id_col: str, seed: int = SEED):
    """md5 of ``<id>:<seed>``; a null id counts as an empty one."""
    return F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f":{seed}")))


def class_quotas(counts: DataFrame, label: str, test_size: float) -> DataFrame:
    """Per class of (label, __n): class_rows, total_rows and test_quota. The
    quotas are largest-remainder shares of ``ceil(test_size * n)`` rows, so
    they add up to it; equal remainders go to the smaller label. In decimals,
    because n_test x class_rows overflows 64-bit integers past ~3e9 rows."""
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    classes = (counts.groupBy(label).agg(F.sum("__n").alias("class_rows"))
               .withColumn("total_rows", F.sum("class_rows").over(whole))
               .withColumn("__test", F.ceil(F.lit(float(test_size)) * F.col("total_rows")).cast("decimal(19,0)")))
    classes = classes.withColumn("__share", F.col("__test") * F.col("class_rows").cast("decimal(19,0)"))
    classes = (classes.withColumn("__rest", F.expr("__share % cast(total_rows AS decimal(19,0))"))
               .withColumn("__floor", F.expr("__share div cast(total_rows AS decimal(19,0))").cast("long")))
    by_rest = Window.orderBy(F.desc("__rest"), label)  # one row per class
    left = F.col("__test").cast("long") - F.sum("__floor").over(whole)
    return classes.withColumn("test_quota", F.col("__floor") + (F.row_number().over(by_rest) <= left).cast("long")).select(
        label, "class_rows", "total_rows", "test_quota")


def with_order(df: DataFrame, label: str, id_col: str, seed: int = SEED) -> DataFrame:
    """Adds the order within a class as ``__order`` (hexadecimal digits), the
    class as ``__label`` (a struct, which compares null-safely) and the first
    range of each row as ``__range``."""
    # The last tie-breaker: rows that share an id still get a fixed order, so
    # a recomputed task ranks them the same way. Its sign bit is turned, so
    # that the digits sort as the signed hash does.
    row_hash = F.xxhash64(*[F.col(c) for c in df.columns]).bitwiseXOR(F.lit(-(1 << 63)))
    return df.withColumns({
        "__label": F.struct(F.col(label).alias("v")),
        "__order": F.concat(order_key(id_col, seed), F.col(id_col).isNotNull().cast("int").cast("string"),
                            F.lower(F.lpad(F.hex(row_hash), 16, "0"))),
    }).withColumn("__range", F.substring("__order", 1, RADIX_DIGITS))


def _digits_in_common(a, b):
    """How many first characters two texts share."""
    places = F.sequence(F.lit(1), F.length(a))
    return F.coalesce(F.array_min(F.filter(places, lambda i: F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1)))) - 1,
                      F.length(a))


def key_ranges(ordered: DataFrame, max_bucket_rows: int = DEFAULT_MAX_BUCKET_ROWS) -> tuple[DataFrame, DataFrame]:
    """(the rows with their final ``__range``, (__label, __range, __n) of all
    ranges). Opened ranges are few: at most rows / max_bucket_rows in a round."""
    done, rows, todo = None, ordered, ordered
    while True:
        counts = write_stage(todo.groupBy("__label", "__range").agg(
            F.count(F.lit(1)).alias("__n"), F.min("__order").alias("__lo"), F.max("__order").alias("__hi")), "ranges")
        too_full = (F.col("__n") > max_bucket_rows) & (F.col("__lo") != F.col("__hi"))
        kept = counts.where(~too_full).select("__label", "__range", "__n")
        done = kept if done is None else done.unionByName(kept)
        opened = counts.where(too_full)
        if opened.isEmpty():
            return rows, done
        opened = write_stage(opened.select("__label", "__range", (_digits_in_common(
            F.col("__lo"), F.col("__hi")) + RADIX_DIGITS).alias("__digits")), "opened-ranges")
        finer = F.when(F.col("__digits").isNull(), F.col("__range")).otherwise(
            F.expr("substring(__order, 1, __digits)"))

        def narrowed(df: DataFrame, how: str, opened=opened, finer=finer) -> DataFrame:
            return df.join(opened, ["__label", "__range"], how).withColumn("__range", finer).drop("__digits")

        rows, todo = narrowed(rows, "left"), narrowed(todo, "inner")


def rank_in_class(df: DataFrame, label: str, id_col: str, seed: int = SEED,
                  max_bucket_rows: int = DEFAULT_MAX_BUCKET_ROWS, test_size: float = TEST_SIZE) -> DataFrame:
    """Adds ``rank_in_class`` (1-based), ``class_rows``, ``total_rows`` and
    ``test_quota``. Rows with a null label are a class of their own, and null
    ids are ranked like any other id, so no row is lost.

    Order within a class: md5 key, then id, then a hash of the whole row.
    """
    rows, ranges = key_ranges(with_order(df, label, id_col, seed), max_bucket_rows)
    earlier = Window.partitionBy("__label").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per class and range: at most 4,096 a class unless ranges were opened.
    offsets = write_stage(ranges.withColumn("__offset", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
                          .join(class_quotas(ranges, "__label", test_size), "__label").drop("__n"), "offsets")
    # Spark broadcasts it if its size allows (many classes may not).
    within = Window.partitionBy("__label", "__range").orderBy("__order")
    ranked = rows.join(offsets, ["__label", "__range"]).withColumn(
        "rank_in_class", F.col("__offset") + F.row_number().over(within))
    return ranked.select(*df.columns, "class_rows", "total_rows", "test_quota", "rank_in_class")


def stratified_split(df: DataFrame, label: str = "label", id_col: str = "booking_id",
                     test_size: float = TEST_SIZE, seed: int = SEED,
                     folds: int = CV_FOLDS, max_bucket_rows: int = DEFAULT_MAX_BUCKET_ROWS) -> DataFrame:
    """S2 (+S3): adds ``is_test`` and, for training rows, ``fold``.

    Exactly ``ceil(test_size * n)`` rows are test rows, spread over classes by
    largest-remainder shares (``class_quotas``). Within a class the
    first ``quota`` rows of the key order are test rows; the training rows
    that follow are dealt round-robin into ``folds`` folds, so fold sizes
    differ by at most one per class.
    """
    ranked = rank_in_class(df, label, id_col, seed, max_bucket_rows, test_size)
    r = F.col("rank_in_class")
    return (ranked
            .withColumn("is_test", r <= F.col("test_quota"))
            .withColumn("fold", F.when(~F.col("is_test"),
                                       ((r - F.col("test_quota") - 1) % folds).cast("int")))
            .drop("class_rows", "total_rows"))


def train_test(split: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two sides of a split frame."""
    return split.where(~F.col("is_test")), split.where(F.col("is_test"))


def assign_folds(df: DataFrame, label: str = "label", id_col: str = "booking_id",
                 folds: int = CV_FOLDS, seed: int = SEED) -> DataFrame:
    """S3: stratified, shuffled k-fold ids for the rows given:
    ``(rank_in_class - 1) % folds``."""
    ranked = rank_in_class(df, label, id_col, seed)
    return (ranked.withColumn("fold", ((F.col("rank_in_class") - 1) % folds).cast("int"))
            .drop("class_rows", "total_rows", "test_quota"))
