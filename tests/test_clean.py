from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaybook.operators import clean as C
from quaybook.plans.queries import cleaned_until, raw
from conftest import SF001, SF01


def test_raw_fixture_rows(spark):
    assert raw(spark, SF001).count() == 1538
    assert raw(spark, SF01).count() == 15375


def test_chain_golden_counts(spark):
    for sf, want in ((SF001, (1500, 1498, 1483)), (SF01, (15000, 14984, 14835))):
        got = tuple(cleaned_until(spark, sf, s).count() for s in ("c1", "c2", "c3"))
        assert got == want


def test_c3_qualifying_columns_and_rate(spark):
    prof = C.missing_profile(cleaned_until(spark, SF01, "c2"))
    assert [r.column_name for r in prof.where("qualifies").collect()] == ["country"]
    rate = C.clean(raw(spark, SF01)).agg(F.avg("no_show")).first()[0]
    assert round(rate, 6) == 0.305561


def test_c3_edges(spark):
    schema = "a int, b string"
    none = spark.createDataFrame([(i, "x") for i in range(20)], schema)
    assert C.drop_rows_with_low_missingness(none).count() == 20
    five_pct = spark.createDataFrame([(i, None if i == 0 else "x") for i in range(20)], schema)
    assert C.drop_rows_with_low_missingness(five_pct).count() == 20
    four_pct = spark.createDataFrame([(i, None if i == 0 else "x") for i in range(25)], schema)
    assert C.drop_rows_with_low_missingness(four_pct).count() == 24
    empty = spark.createDataFrame([], schema)
    assert C.drop_rows_with_low_missingness(empty).count() == 0


def test_c4_words(spark):
    df = spark.createDataFrame([("One",), (" one ",), (None,), ("TWO",), ("3",)], "num_adults string")
    got = [r[0] for r in C.adult_words_to_digits(df).collect()]
    assert got == ["1", " one ", None, "2", "3"]


def test_c5_numeric_text(spark):
    vals = ["1.0", " 5 ", "+7", "1e2", "1d", "nan", "", "1,000", "0x1A", "1.5", "inf"]
    df = spark.createDataFrame([(v,) for v in vals], "num_adults string")
    got = [r[0] for r in C.parse_numeric_columns(df).collect()]
    assert got == [1, 5, 7, 100, None, None, None, None, None, None, None]
    rej = {r.column_name: r.rejected_count for r in C.numeric_parse_rejects(df).collect()}
    assert rej == {"num_adults": 7}


def test_c5_double_column(spark):
    df = spark.createDataFrame([(1.0,), (2.5,), (float("nan"),), (None,), (float("inf"),)],
                               "arrival_day double")
    assert [r[0] for r in C.parse_numeric_columns(df).collect()] == [1, None, None, None, None]


def test_c6_months(spark):
    df = spark.createDataFrame([("  jAnuary ",), ("march\t",), (None,), ("MAY-x",)],
                               "arrival_month string")
    got = [r[0] for r in C.standardize_months(df).collect()]
    assert got == ["January", "March", None, "May-X"]


def test_c7_days(spark):
    rows = [("February", 29), ("February", 30), ("April", 31), ("May", 0), ("May", -1),
            ("Unknown", 40), (None, 5), ("Unknown", 0), ("Unknown", -1)]
    df = spark.createDataFrame(rows, "arrival_month string, arrival_day bigint")
    got = [r[1] for r in C.null_invalid_days(df).collect()]
    assert got == [29, None, None, None, None, 40, 5, None, None]


def test_c7_skips_month_without_day(spark):
    df = spark.createDataFrame([("May", 40)], "booking_month string, booking_day2 bigint")
    assert C.null_invalid_days(df).collect()[0][1] == 40


def test_clean_types(spark):
    df = C.clean(raw(spark, SF001))
    types = {f.name: f.dataType for f in df.schema.fields}
    for c in ("booking_id", "no_show", "arrival_day", "checkout_day", "num_adults", "num_children"):
        assert isinstance(types[c], T.LongType)
