from quaybook.operators import quality as Q
from quaybook.plans.queries import cleaned, raw
from conftest import SF01


def _by_id(results):
    return {r.check_id: r for r in results.collect()}


def test_suite_has_69_checks():
    suite = Q.build_suite()
    assert len(suite) == 69
    kinds = [k.kind for k in suite]
    assert kinds.count("not_null") == 15 and kinds.count("type") == 15


def test_raw_golden_counts(spark):
    res = _by_id(Q.run_suite(raw(spark, SF01)))
    suite = {k.check_id: k for k in Q.build_suite()}

    def find(kind, column, cond=None):
        for i, k in suite.items():
            if k.kind == kind and k.column == column and (cond is None or k.condition == cond):
                return res[i]
        raise KeyError
    assert res[2].unexpected_count == 750          # compound unique
    assert res[3].unexpected_count == 750          # booking_id unique
    assert find("not_null", "no_show").unexpected_count == 17
    assert find("not_null", "country").unexpected_count == 153
    assert find("not_null", "room").unexpected_count == 2625
    assert find("not_null", "price").unexpected_count == 1250
    assert find("in_set", "booking_month").unexpected_count == 9016
    assert find("in_set", "arrival_month").unexpected_count == 9016
    assert find("in_set", "checkout_month").unexpected_count == 9390
    assert find("regex", "price").unexpected_count == 28
    assert find("between", "num_adults").unexpected_count == 6590
    jan = find("between", "checkout_day", ("checkout_month", "January"))
    assert jan.unexpected_count == 3 and jan.success is False
    assert res[1].success is True
    assert res[20].success is False and res[20].examples == "double"


def test_clean_suite_passes_types(spark):
    res = _by_id(Q.run_suite(cleaned(spark, SF01)))
    assert all(res[i].success for i in range(19, 34))
    assert res[2].unexpected_count == 0 and res[3].unexpected_count == 0


def test_v3_nulls_ignored(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "booking_id bigint")
    suite = [k for k in Q.build_suite() if k.kind == "unique"]
    r = Q.run_suite(df, suite).first()
    assert r.unexpected_count == 2 and r.examples == "1"


def test_v9_strict_vs_f1_lax(spark):
    from quaybook.operators.features import parse_price
    df = spark.createDataFrame([(" SGD$ 5 ",)], "price string")
    suite = [k for k in Q.build_suite() if k.kind == "regex"]
    assert Q.run_suite(df, suite).first().success is False
    assert parse_price(df).first().price_currency == "SGD"


def test_v16_empty_report_has_five_columns(spark):
    df = spark.createDataFrame([(1,)], "booking_id bigint")
    suite = [k for k in Q.build_suite() if k.kind in ("unique",)]
    rep = Q.failures(Q.run_suite(df, suite))
    assert rep.count() == 0
    assert tuple(rep.columns) == Q.REPORT_COLUMNS


def test_examples_are_bounded(spark):
    df = spark.range(0, 500).selectExpr("cast(id as string) as branch")
    suite = [k for k in Q.build_suite() if k.kind == "in_set" and k.column == "branch"]
    r = Q.run_suite(df, suite).first()
    assert r.unexpected_count == 500
    assert len(r.examples.split("; ")) == 20
