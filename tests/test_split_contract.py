"""The split's size contract and its treatment of null ids and labels; text
numerics of CSV sources."""
import math
import os

import pytest
from pyspark.sql import functions as F

from quaybook.operators import clean as C
from quaybook.operators import split as S
from quaybook.sources.bookings import RAW_SCHEMA, read_raw_bookings


def test_quotas_are_largest_remainder_shares(spark):
    cases = [(a, b) for a in range(1, 40, 3) for b in range(a, 60, 7)] + [(2, 6), (1, 1, 1), (3, 3, 5), (7, 11, 13, 2), (100, 250, 40, 9, 1)]
    for sizes in cases[::25] + cases[-5:]:
        counts = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "label int, __n long")
        rows = S.class_quotas(counts, "label", 0.2).collect()
        total = sum(sizes)
        assert sum(r.test_quota for r in rows) == math.ceil(0.2 * total)
        assert all(abs(r.test_quota - math.ceil(0.2 * total) * r.class_rows / total) < 1 for r in rows)


@pytest.mark.parametrize("most", [2_000_000, 3])
def test_null_ids_and_labels_are_kept(spark, most):
    rows = [(None if i % 10 == 0 else i, None if i % 7 == 0 else i % 3, i) for i in range(100)]
    df = spark.createDataFrame(rows, "booking_id long, label int, x int")
    out = S.stratified_split(df, max_bucket_rows=most).collect()
    assert sorted(r.x for r in out) == list(range(100)) and sum(r.is_test for r in out) == 20
    assert all((r.fold is None) == r.is_test for r in out)
    assert S.assign_folds(df).where(F.col("fold").isNull()).count() == 0


def test_csv_keeps_unparsed_text(spark, scratch):
    path = os.path.join(scratch, "raw.csv")
    names = [f.name for f in RAW_SCHEMA.fields]
    with open(path, "w") as f:
        f.write(",".join(names) + "\n")
        f.write(",".join({"booking_id": "b7", "no_show": "abc", "arrival_day": "abc", "num_children": "two"}.get(n, "1") for n in names) + "\n")
    df = read_raw_bookings(spark, path, fmt="csv")
    assert df.first().arrival_day == "abc"
    rejects = {r.column_name: r.rejected_count for r in C.numeric_parse_rejects(df).collect()}
    assert [rejects[c] for c in ("booking_id", "no_show", "arrival_day", "num_children")] == [1, 1, 1, 1]


@pytest.mark.parametrize("most", [1, 7, 1000])
def test_ranks_are_those_of_one_window(spark, most):
    """One id on a third of the rows, null ids and labels, repeated rows."""
    rows = [(i % 400, i % 2, i) for i in range(400)] + [(7, i % 3, i) for i in range(200)] + [(None, None, i) for i in range(20)]
    df = spark.createDataFrame(rows + rows[:5], "booking_id long, label int, x int")
    plain = (f"row_number() OVER (PARTITION BY label ORDER BY md5(concat(coalesce(cast(booking_id AS string), ''), ':42')), "
             "booking_id, xxhash64(booking_id, label, x))")
    want = sorted(map(repr, df.selectExpr("booking_id", "label", "x", f"{plain} AS rank_in_class").collect()))
    ranked = S.rank_in_class(df, "label", "booking_id", max_bucket_rows=most)
    assert sorted(map(repr, ranked.select("booking_id", "label", "x", "rank_in_class").collect())) == want


def test_only_full_ranges_are_opened(spark):
    df = spark.createDataFrame([(i, 0, i) for i in range(500)] + [(9, 0, i) for i in range(500)], "booking_id long, label int, x int")
    leaves = S.key_ranges(S.with_order(df, "label", "booking_id"), 400)[1]
    found = {len(r["__range"]): r["__n"] for r in leaves.groupBy("__range").agg(F.sum("__n").alias("__n")).collect()}
    assert max(found) > 32 and leaves.agg(F.sum("__n")).first()[0] == 1000
    assert leaves.agg(F.max("__n")).first()[0] <= 400
    assert leaves.where(F.length("__range") > 3).agg(F.sum("__n")).first()[0] <= 520
