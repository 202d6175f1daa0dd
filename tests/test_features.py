import datetime as dt

from pyspark.sql import functions as F

from quaybook.functions.calendar import reference_date
from quaybook.operators import features as FE
from quaybook.plans.queries import featured
from conftest import SF001, SF01


def test_f1_price_parse(spark):
    vals = ["SGD$ 492.98", " USD$5 ", "sgd$ 5", "SGD$5.", "EUR$5", "SGD$-1", None]
    df = spark.createDataFrame([(v,) for v in vals], "price string")
    got = [(r.price_currency, r.price_amount) for r in FE.parse_price(df).collect()]
    assert got == [("SGD", 492.98), ("USD", 5.0)] + [(None, None)] * 5


def test_f2_conversion(spark):
    df = spark.createDataFrame([("USD", 100.0), ("SGD", 100.0), (None, None)],
                               "price_currency string, price_amount double")
    assert [r[0] for r in FE.price_in_sgd(df).select("price_amount_sgd").collect()] == [135.0, 100.0, None]


def test_f3_dates(spark):
    df = spark.createDataFrame([("February", 30), ("Unknown", 3), ("December", 31)],
                               "arrival_month string, arrival_day bigint")
    got = [r[0] for r in df.select(reference_date(F.col("arrival_month"), F.col("arrival_day"))).collect()]
    assert got == [None, None, dt.date(2024, 12, 31)]


def test_f4_f5(spark):
    df = spark.createDataFrame(
        [("December", 31, "January", 1, "November", ),
         ("May", 3, "May", 3, "May"),
         ("January", 5, "January", 3, "February")],
        "arrival_month string, arrival_day bigint, checkout_month string, checkout_day bigint, booking_month string")
    out = FE.add_month_gap(FE.add_stay_length(df)).collect()
    assert [r.stay_length_nights for r in out] == [1, 0, 364]
    assert [r.booking_to_arrival_month_gap for r in out] == [1, 0, 11]


def test_f5_wrap(spark):
    df = spark.createDataFrame([("Nov" + "ember", "February")], "booking_month string, arrival_month string")
    assert FE.add_month_gap(df).first().booking_to_arrival_month_gap == 3


def test_f6_f9_zero_and_null(spark):
    df = spark.createDataFrame([(100.0, 0, 0, 2), (100.0, 2, None, 0), (100.0, 1, 1, 4)],
                               "price_amount_sgd double, num_adults bigint, num_children bigint, stay_length_nights int")
    out = (FE.add_price_per_guest_night(FE.add_price_per_night(FE.add_price_per_guest(
        FE.add_total_guests(df)))).collect())
    assert [r.total_guests for r in out] == [0, None, 2]
    assert [r.price_per_guest for r in out] == [None, None, 50.0]
    assert [r.price_per_night for r in out] == [50.0, None, 25.0]
    assert [r.price_per_guest_per_night for r in out] == [None, None, 12.5]


GOLDEN = {
    SF001: {"price_amount_sgd": (126, 836128.865), "stay_length_nights": (39, 4163),
            "booking_to_arrival_month_gap": (8, 2801), "total_guests": (0, 4555),
            "price_per_guest": (126, 355262.1635), "price_per_night": (363, 295467.1636),
            "price_per_guest_per_night": (363, 122476.4595)},
    SF01: {"price_amount_sgd": (1263, 8390258.4555), "stay_length_nights": (358, 42053),
           "booking_to_arrival_month_gap": (74, 29313), "total_guests": (0, 45562),
           "price_per_guest": (1263, 3545834.713), "price_per_night": (3664, 2865779.8822),
           "price_per_guest_per_night": (3664, 1208277.9433)},
}


def test_feature_golden_sums(spark):
    for sf, want in GOLDEN.items():
        df = featured(spark, sf)
        aggs = []
        for c in want:
            aggs += [F.count_if(F.col(c).isNull()).alias(c + "_n"), F.sum(c).alias(c + "_s")]
        row = df.agg(*aggs).first()
        for c, (n, s) in want.items():
            assert row[c + "_n"] == n, c
            assert abs(row[c + "_s"] - s) < 1e-3, c


def test_features_are_one_projection(spark):
    plan = featured(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # no shuffle after the stage boundary
