"""Data-quality checks V1-V16.

A suite is a list of :class:`Check` values (V10). :func:`run_suite` (V11)
compiles it into:

* one aggregate pass for every row-level check (not-null, in-set, between,
  conditional between, regex), with map-side partial aggregation, so the
  exchange carries one partial row per task;
* one grouped count for each uniqueness check (V2, V3), again with partial
  aggregation, so a hot duplicate key collapses before the shuffle;
* one examples pass: violating ``(check, value)`` pairs are de-duplicated by
  a grouped aggregate and cut to the first 20 values per check by a ranked
  window that Spark plans as a per-partition group limit before the shuffle,
  so no check ever sends an unbounded group to one task;
* schema checks (V1, V5) read ``df.schema`` and run no job.

The result has one row per check; :func:`failures` (V12) and
:func:`failure_report` (V16) select from it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaybook.config import (BOOKING_COLUMNS, BRANCHES, COUNTRIES, DAYS_IN_MONTH,
                             FIRST_TIME_VALUES, GUEST_COUNT_RANGE, INTEGER_COLUMNS,
                             MAX_EXAMPLES, MONTH_NAMES, PLATFORMS, PRICE_CHECK_REGEX,
                             ROOMS, STRING_COLUMNS, TARGET_VALUES)

# The check type names of the original suite.
COLUMNS_MATCH_ORDERED_LIST = "expect_table_columns_to_match_ordered_list"
COMPOUND_COLUMNS_UNIQUE = "expect_compound_columns_to_be_unique"
COLUMN_VALUES_UNIQUE = "expect_column_values_to_be_unique"
COLUMN_VALUES_NOT_NULL = "expect_column_values_to_not_be_null"
COLUMN_VALUES_OF_TYPE = "expect_column_values_to_be_of_type"
COLUMN_VALUES_IN_SET = "expect_column_values_to_be_in_set"
COLUMN_VALUES_BETWEEN = "expect_column_values_to_be_between"
COLUMN_VALUES_MATCH_REGEX = "expect_column_values_to_match_regex"

# Declared type names -> Spark types they accept.
TYPE_NAMES = {"int64": "bigint", "str": "string", "float64": "double"}

REPORT_COLUMNS = ("expectation_type", "affected_field", "unexpected_count",
                  "unexpected_percent", "examples")


@dataclass(frozen=True)
class Check:
    """One constraint. ``kind`` selects how it compiles."""

    check_id: int
    kind: str
    expectation_type: str
    column: str | None = None
    column_list: tuple[str, ...] | None = None
    values: tuple = ()
    min_value: float | None = None
    max_value: float | None = None
    condition: tuple[str, str] | None = None  # (column, required value)
    regex: str | None = None
    type_name: str | None = None
    extra: dict = field(default_factory=dict)


def build_suite(columns=BOOKING_COLUMNS) -> list[Check]:
    """The 69-check booking suite, in its original order."""
    specs: list[dict] = [
        dict(kind="columns", expectation_type=COLUMNS_MATCH_ORDERED_LIST,
             column_list=tuple(columns)),
        dict(kind="compound_unique", expectation_type=COMPOUND_COLUMNS_UNIQUE,
             column_list=tuple(columns)),
        dict(kind="unique", expectation_type=COLUMN_VALUES_UNIQUE, column="booking_id"),
    ]
    specs += [dict(kind="not_null", expectation_type=COLUMN_VALUES_NOT_NULL, column=c)
              for c in columns]
    specs += [dict(kind="type", expectation_type=COLUMN_VALUES_OF_TYPE, column=c,
                   type_name="int64") for c in INTEGER_COLUMNS]
    specs += [dict(kind="type", expectation_type=COLUMN_VALUES_OF_TYPE, column=c,
                   type_name="str") for c in STRING_COLUMNS]
    specs.append(dict(kind="in_set", expectation_type=COLUMN_VALUES_IN_SET,
                      column="no_show", values=TARGET_VALUES))
    lo, hi = GUEST_COUNT_RANGE
    specs += [dict(kind="between", expectation_type=COLUMN_VALUES_BETWEEN, column=c,
                   min_value=lo, max_value=hi) for c in ("num_adults", "num_children")]
    for month, days in zip(MONTH_NAMES, DAYS_IN_MONTH):
        for prefix in ("arrival", "checkout"):
            specs.append(dict(kind="between", expectation_type=COLUMN_VALUES_BETWEEN,
                              column=f"{prefix}_day", min_value=1, max_value=days,
                              condition=(f"{prefix}_month", month)))
    for c, allowed in (("branch", BRANCHES), ("booking_month", MONTH_NAMES),
                       ("arrival_month", MONTH_NAMES), ("checkout_month", MONTH_NAMES),
                       ("country", COUNTRIES), ("first_time", FIRST_TIME_VALUES),
                       ("room", ROOMS), ("platform", PLATFORMS)):
        specs.append(dict(kind="in_set", expectation_type=COLUMN_VALUES_IN_SET,
                          column=c, values=allowed))
    specs.append(dict(kind="regex", expectation_type=COLUMN_VALUES_MATCH_REGEX,
                      column="price", regex=PRICE_CHECK_REGEX))
    return [Check(check_id=i, **s) for i, s in enumerate(specs, 1)]


def table_suite(columns, key: str | None = None) -> list[Check]:
    """A suite for any table: column order, full-row uniqueness, key
    uniqueness (when a key is named) and not-null for every column."""
    specs: list[dict] = [
        dict(kind="columns", expectation_type=COLUMNS_MATCH_ORDERED_LIST, column_list=tuple(columns)),
        dict(kind="compound_unique", expectation_type=COMPOUND_COLUMNS_UNIQUE,
             column_list=tuple(columns)),
    ]
    if key is not None:
        specs.append(dict(kind="unique", expectation_type=COLUMN_VALUES_UNIQUE, column=key))
    specs += [dict(kind="not_null", expectation_type=COLUMN_VALUES_NOT_NULL, column=c)
              for c in columns]
    return [Check(check_id=i, **s) for i, s in enumerate(specs, 1)]


# --- compile -------------------------------------------------------------------
# Each row-level check compiles to Spark SQL expression text, turned into a
# Column with one ``F.expr`` call: the plan is the same as with the Column
# API, but building a 69-check suite takes a few dozen driver-to-JVM calls
# instead of tens of thousands.
_NUMBER_TEXT = r"^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$"
_OUTER_WS = r"^\\s+|\\s+$"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(float(v)) + "D"


def _number_sql(col: str, dtype: T.DataType) -> str:
    """Numeric value of a column; text goes through the strict parse."""
    if not isinstance(dtype, T.StringType):
        return f"CAST({col} AS DOUBLE)"
    t = f"regexp_replace({col}, '{_OUTER_WS}', '')"
    d = f"try_cast({t} AS DOUBLE)"
    return (f"(CASE WHEN {t} RLIKE '{_NUMBER_TEXT}' AND NOT isnan({d}) "
            f"AND abs({d}) != double('inf') THEN {d} END)")


def _row_rule_sql(check: Check, types: dict) -> tuple[str, str | None, str]:
    """(unexpected, domain or None for all rows, example value) as SQL text
    for a row-level check. Unexpected is never NULL."""
    c = _q(check.column)
    if check.kind == "not_null":
        return f"{c} IS NULL", None, "CAST(NULL AS STRING)"
    value = f"CAST({c} AS STRING)"
    if check.kind == "in_set":
        if isinstance(types[check.column], T.StringType):
            vals = ", ".join(_lit(str(v)) for v in check.values)
            ok = f"{c} IN ({vals})"
        else:
            vals = ", ".join(_lit(float(v)) for v in check.values)
            ok = f"CAST({c} AS DOUBLE) IN ({vals})"
        return f"{c} IS NOT NULL AND NOT coalesce({ok}, false)", None, value
    if check.kind == "between":
        x = _number_sql(c, types[check.column])
        ok = f"coalesce({x} BETWEEN {check.min_value} AND {check.max_value}, false)"
        bad = f"{c} IS NOT NULL AND NOT {ok}"
        if check.condition is None:
            return bad, None, value
        cond_col, cond_val = check.condition
        domain = f"coalesce({_q(cond_col)} = {_lit(cond_val)}, false)"
        return f"{domain} AND {bad}", domain, value
    if check.kind == "regex":
        ok = f"coalesce(CAST({c} AS STRING) RLIKE {_lit(check.regex)}, false)"
        return f"{c} IS NOT NULL AND NOT {ok}", None, value
    raise ValueError(check.kind)


def _row_rule(check: Check, types: dict) -> tuple[Column, Column | None, Column]:
    unexpected, domain, value = _row_rule_sql(check, types)
    return F.expr(unexpected), (F.expr(domain) if domain else None), F.expr(value)


ROW_KINDS = ("not_null", "in_set", "between", "regex")


def _dup_members(df: DataFrame, cols: list[str], skip_nulls: bool) -> DataFrame:
    """Rows that belong to a group of equal keys with more than one member."""
    src = df.select(*cols)
    if skip_nulls:
        src = src.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))
    return src.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _examples(df: DataFrame, checks: list[Check], types: dict) -> DataFrame:
    """(check_id, examples): up to MAX_EXAMPLES distinct violating values per
    check, ordered by value text and joined with '; '."""
    row_checks = [k for k in checks if k.kind in ROW_KINDS and k.kind != "not_null"
                  and k.column in types]
    pairs = []
    for k in row_checks:
        unexpected, _, value = _row_rule_sql(k, types)
        pairs.append(f"CASE WHEN {unexpected} THEN named_struct('check_id', {k.check_id}, "
                     f"'value', {value}) END")
    parts = []
    if pairs:
        violations = F.expr(f"filter(array({', '.join(pairs)}), x -> x IS NOT NULL)")
        parts.append(df.select(F.explode(violations).alias("p")).select("p.check_id", "p.value"))
    for k in checks:
        if k.kind == "unique" and k.column in types:
            parts.append(_dup_members(df, [k.column], True)
                         .select(F.lit(k.check_id).alias("check_id"),
                                 F.col(k.column).cast("string").alias("value")))
    if not parts:
        return df.sparkSession.createDataFrame([], "check_id int, examples string")
    pairs_df = reduce(DataFrame.unionByName, parts)
    distinct_pairs = pairs_df.distinct()
    rank = F.row_number().over(Window.partitionBy("check_id").orderBy("value"))
    first = distinct_pairs.withColumn("rk", rank).where(F.col("rk") <= MAX_EXAMPLES)
    return (first.groupBy("check_id")
            .agg(F.array_join(F.array_sort(F.collect_list("value")), "; ").alias("examples")))


def _field_sql(check: Check) -> str:
    """V13 in the report's SQL: what the check is about, 'table' if no column."""
    names = [check.column] if check.column else list(check.column_list or ())
    return f"coalesce(nullif(array_join(array({', '.join(map(_lit, names))}), ', '), ''), 'table')"


def run_suite(df: DataFrame, checks: list[Check] | None = None,
              with_examples: bool = True) -> DataFrame:
    """One row per check with success, element_count, unexpected_count,
    unexpected_percent (V14) and examples (V15)."""
    checks = checks if checks is not None else build_suite()
    types = {f.name: f.dataType for f in df.schema.fields}
    # Every row-level check is one count_if of a single global aggregate.
    aggs = ["count(1) AS __rows"]
    for k in checks:
        if k.kind in ROW_KINDS and k.column in types:
            unexpected, domain, _ = _row_rule_sql(k, types)
            aggs.append(f"count_if({unexpected}) AS __u{k.check_id}")
            if domain is not None:
                aggs.append(f"count_if({domain}) AS __e{k.check_id}")
    stats = df.selectExpr(*aggs)
    for k in checks:
        if k.kind in ("unique", "compound_unique"):
            cols = list(k.column_list or (k.column,))
            if all(c in types for c in cols):
                dup = _dup_members(df, cols, skip_nulls=k.kind == "unique")
                stats = stats.withColumn(f"__u{k.check_id}", dup.selectExpr(
                    "CAST(coalesce(sum(n), 0) AS BIGINT)").scalar())

    entries = []
    for k in checks:
        element = unexpected = percent = "NULL"
        note = "''"
        if k.kind == "columns":
            success = str(list(df.columns) == list(k.column_list)).lower()
        elif k.kind == "type":
            want = TYPE_NAMES.get(k.type_name, k.type_name)
            have = types[k.column].simpleString() if k.column in types else None
            success = str(have == want).lower()
            if have != want:
                note = _lit(have or "missing column")
        elif k.column is not None and k.column not in types:
            success = "false"
            note = _lit("missing column")
        else:
            unexpected = f"__u{k.check_id}"
            has_domain = k.kind == "between" and k.condition is not None
            element = f"__e{k.check_id}" if has_domain else "__rows"
            success = f"{unexpected} = 0"
            if k.kind != "not_null":
                percent = f"try_divide(100.0D * {unexpected}, {element})"
        entries.append(
            f"named_struct('check_id', {k.check_id}, "
            f"'expectation_type', {_lit(k.expectation_type)}, "
            f"'affected_field', {_field_sql(k)}, 'success', {success}, "
            f"'element_count', CAST({element} AS BIGINT), "
            f"'unexpected_count', CAST({unexpected} AS BIGINT), "
            f"'unexpected_percent', CAST({percent} AS DOUBLE), 'note', {note})")
    results = stats.selectExpr(f"inline(array({', '.join(entries)}))")
    if not with_examples:
        return results.withColumnRenamed("note", "examples")
    ex = _examples(df, checks, types)
    # At most one example row per check: a broadcast side bounded by the suite size.
    return (results.join(F.broadcast(ex), "check_id", "left")
            .selectExpr("check_id", "expectation_type", "affected_field", "success",
                        "element_count", "unexpected_count", "unexpected_percent",
                        "CASE WHEN note != '' THEN note ELSE coalesce(examples, '') END AS examples"))


def failures(results: DataFrame) -> DataFrame:
    """Failed checks only, as report rows (V16 columns)."""
    return failure_report(results.where(~F.col("success")))


def failure_report(rows: DataFrame) -> DataFrame:
    """The fixed five-column report, also when empty."""
    return rows.select(*REPORT_COLUMNS)


def columns_match(df: DataFrame, expected=BOOKING_COLUMNS) -> bool:
    """V1 as a plain predicate (no job)."""
    return list(df.columns) == list(expected)
