"""DuckDB SQL that states each operator's result independently of the Spark
code. Used by ``__spark_entry__.oracle_sql`` and the tests.

Only the raw booking derivation is shared text (it is the input, not an
operator). Everything else is written here as plain SQL over the given
tables.
"""

from __future__ import annotations

from quaybook.config import (BOOKING_COLUMNS, DAYS_IN_MONTH, MISSING_DROP_THRESHOLD,
                             MONTH_NAMES, PRICE_PARSE_REGEX)
from quaybook.sources.bookings import raw_bookings_sql

_STRIP = r"'^\s+|\s+$'"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, {_STRIP}, '', 'g')"


def _case(key: str, pairs) -> str:
    whens = " ".join(f"WHEN {k} THEN {v}" for k, v in pairs)
    return f"(CASE {key} {whens} END)"


def month_num(x: str) -> str:
    return _case(x, ((f"'{m}'", i) for i, m in enumerate(MONTH_NAMES, 1)))


def month_num_loose(x: str) -> str:
    return _case(f"lower({_strip(x)})",
                 ((f"'{m.lower()}'", i) for i, m in enumerate(MONTH_NAMES, 1)))


def dim(num: str) -> str:
    return _case(num, ((i, d) for i, d in enumerate(DAYS_IN_MONTH, 1)))


def doy(month: str, day: str) -> str:
    before, acc = [], 0
    for d in DAYS_IN_MONTH:
        before.append(acc)
        acc += d
    num = month_num(month)
    b = _case(num, ((i, v) for i, v in enumerate(before, 1)))
    return f"(CASE WHEN {day} >= 1 AND {day} <= {dim(num)} THEN {b} + {day} END)"


def _numeric_text(x: str) -> str:
    t = _strip(x)
    guard = r"'^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$'"
    return f"(CASE WHEN regexp_matches({t}, {guard}) THEN TRY_CAST({t} AS DOUBLE) END)"


def _to_long_from_double(d: str) -> str:
    return (f"(CASE WHEN {d} IS NOT NULL AND NOT isnan({d}) AND NOT isinf({d}) "
            f"AND {d} = floor({d}) THEN CAST({d} AS BIGINT) END)")


def _title(x: str) -> str:
    t = _strip(x)
    return f"(upper(substr({t}, 1, 1)) || lower(substr({t}, 2)))"


# --- cleaning chain as CTEs ---------------------------------------------------
def clean_ctes() -> str:
    cols = BOOKING_COLUMNS
    null_counts = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS n_{c}" for c in cols)
    flags = ", ".join(
        f"coalesce(CAST(n_{c} AS DOUBLE) / NULLIF(n, 0) > 0 AND "
        f"CAST(n_{c} AS DOUBLE) / NULLIF(n, 0) < {MISSING_DROP_THRESHOLD}, false) AS q_{c}"
        for c in cols)
    drop_any = " OR ".join(f"((SELECT q_{c} FROM c3_flags) AND {c} IS NULL)" for c in cols)
    c5 = []
    for c in cols:
        if c == "booking_id":
            c5.append(f"CAST({c} AS BIGINT) AS {c}")
        elif c == "num_adults":
            c5.append(f"{_to_long_from_double(_numeric_text(c))} AS {c}")
        elif c in ("no_show", "arrival_day", "checkout_day", "num_children"):
            c5.append(f"{_to_long_from_double(c)} AS {c}")
        else:
            c5.append(c)
    c6 = [f"{_title(c)} AS {c}" if c.endswith("_month") else c for c in cols]
    c7 = []
    for c in cols:
        if c in ("arrival_day", "checkout_day"):
            m = c.replace("_day", "_month")
            c7.append(f"CASE WHEN NOT ({c} >= 1 AND {c} <= {dim(month_num_loose(m))}) "
                      f"THEN NULL ELSE {c} END AS {c}")
        else:
            c7.append(c)
    return f"""
raw AS (SELECT * FROM ({raw_bookings_sql()})),
c1 AS (SELECT DISTINCT * FROM raw),
c2 AS (SELECT * FROM c1 WHERE no_show IS NOT NULL),
c3_stats AS (SELECT count(*) AS n, {null_counts} FROM c2),
c3_flags AS (SELECT {flags} FROM c3_stats),
c3 AS (SELECT * FROM c2 WHERE NOT ({drop_any})),
c4 AS (SELECT * REPLACE (CASE WHEN lower(num_adults) = 'one' THEN '1'
                              WHEN lower(num_adults) = 'two' THEN '2'
                              ELSE lower(num_adults) END AS num_adults) FROM c3),
c5 AS (SELECT {", ".join(c5)} FROM c4),
c6 AS (SELECT {", ".join(c6)} FROM c5),
c7 AS (SELECT {", ".join(c7)} FROM c6)"""


def missing_profile_sql(source: str, cols, ctes: str = "") -> str:
    """C3a over any relation; ``ctes`` may define ``source``."""
    parts = []
    for i, c in enumerate(cols):
        parts.append(
            f"SELECT n AS row_count, {i} AS position, '{c}' AS column_name, "
            f"CAST(n_{i} AS BIGINT) AS missing_count, "
            f"CAST(n_{i} AS DOUBLE) / NULLIF(n, 0) AS missing_rate, "
            f"coalesce(CAST(n_{i} AS DOUBLE) / NULLIF(n, 0) > 0 AND "
            f"CAST(n_{i} AS DOUBLE) / NULLIF(n, 0) < {MISSING_DROP_THRESHOLD}, false) AS qualifies "
            f"FROM s")
    counts = ", ".join(f"count(*) FILTER (WHERE \"{c}\" IS NULL) AS n_{i}" for i, c in enumerate(cols))
    head = f"WITH {ctes + ',' if ctes else ''} s AS (SELECT count(*) AS n, {counts} FROM {source}) "
    return head + " UNION ALL ".join(parts)


def features_cte(src: str = "c7") -> str:
    re = PRICE_PARSE_REGEX.replace("'", "''")
    return f"""
f1 AS (SELECT *, NULLIF(regexp_extract(price, '{re}', 1), '') AS price_currency,
              TRY_CAST(NULLIF(regexp_extract(price, '{re}', 2), '') AS DOUBLE) AS price_amount
       FROM {src}),
f2 AS (SELECT *, CASE price_currency WHEN 'SGD' THEN price_amount
                 WHEN 'USD' THEN price_amount * CAST(1.35 AS DOUBLE) END AS price_amount_sgd
       FROM f1),
f4 AS (SELECT *, CAST(CASE WHEN s < 0 THEN s + 366 ELSE s END AS INTEGER) AS stay_length_nights
       FROM (SELECT *, {doy('checkout_month', 'checkout_day')} - {doy('arrival_month', 'arrival_day')} AS s
             FROM f2)),
f5 AS (SELECT *, CAST(CASE WHEN g < 0 THEN g + 12 ELSE g END AS INTEGER) AS booking_to_arrival_month_gap
       FROM (SELECT *, {month_num('arrival_month')} - {month_num('booking_month')} AS g FROM f4)),
f6 AS (SELECT *, CAST(num_adults + num_children AS BIGINT) AS total_guests FROM f5),
f9 AS (SELECT *,
         price_amount_sgd / CASE WHEN total_guests > 0 THEN total_guests END AS price_per_guest,
         price_amount_sgd / CASE WHEN stay_length_nights > 0 THEN stay_length_nights END AS price_per_night,
         price_amount_sgd / ((CASE WHEN total_guests > 0 THEN total_guests END)
                             * (CASE WHEN stay_length_nights > 0 THEN stay_length_nights END))
           AS price_per_guest_per_night
       FROM f6),
features AS (SELECT * EXCLUDE (s, g) FROM f9)"""


FEATURE_COLUMNS = (
    "price_currency", "price_amount", "price_amount_sgd", "stay_length_nights",
    "booking_to_arrival_month_gap", "total_guests", "price_per_guest",
    "price_per_night", "price_per_guest_per_night",
)


def with_chain(select: str, features: bool = False) -> str:
    ctes = clean_ctes() + ("," + features_cte() if features else "")
    return f"WITH {ctes}\n{select}"


def _doy_date(month: str, day: str) -> str:
    return f"CAST(DATE '2024-01-01' + CAST({doy(month, day)} - 1 AS INTEGER) AS DATE)"


def _feature_sql(*cols: str) -> str:
    return with_chain(f"SELECT booking_id, {', '.join(cols)} FROM features", features=True)


def _c5_rejects() -> str:
    parts = [
        "SELECT 'booking_id' AS column_name, CAST(0 AS BIGINT) AS rejected_count",
    ]
    for c in ("no_show", "arrival_day", "checkout_day", "num_adults", "num_children"):
        parsed = _to_long_from_double(_numeric_text(c) if c == "num_adults" else c)
        parts.append(f"SELECT '{c}', CAST(count(*) FILTER (WHERE {c} IS NOT NULL AND {parsed} IS NULL) AS BIGINT) FROM c4")
    return with_chain(" UNION ALL ".join(parts))


def oracle_queries() -> dict[str, str]:
    q = {
        "branch_summary": with_chain(
            "SELECT branch, CAST(count(*) AS BIGINT) AS bookings, "
            "round(avg(price_amount_sgd), 6) AS mean_price_sgd, "
            "round(avg(no_show), 6) AS no_show_rate FROM features GROUP BY branch",
            features=True),
        "i1_raw_bookings": raw_bookings_sql(),
        "c3a_missing_profile": missing_profile_sql("c2", BOOKING_COLUMNS, clean_ctes()),
        "c5_parse_rejects": _c5_rejects(),
        "f1_price_parse": _feature_sql("price", "price_currency", "price_amount"),
        "f2_price_sgd": _feature_sql("price_currency", "price_amount", "price_amount_sgd"),
        "f3_reference_dates": with_chain(
            f"SELECT booking_id, {_doy_date('arrival_month', 'arrival_day')} AS arrival_date, "
            f"{_doy_date('checkout_month', 'checkout_day')} AS checkout_date FROM c7"),
        "f4_stay_nights": _feature_sql("stay_length_nights"),
        "f5_month_gap": _feature_sql("booking_to_arrival_month_gap"),
        "f6_total_guests": _feature_sql("total_guests"),
        "f7_price_per_guest": _feature_sql("price_per_guest"),
        "f8_price_per_night": _feature_sql("price_per_night"),
        "f9_price_guest_night": _feature_sql("price_per_guest_per_night"),
        "feature_table": with_chain("SELECT * FROM features", features=True),
    }
    q.update(quality_queries())
    q.update(split_metric_queries())
    q.update(experiment_queries())
    q.update(model_prep_queries())
    q.update(given_table_queries())
    q.update(check_kind_queries())
    for step, name in (("c1", "c1_distinct"), ("c2", "c2_target_present"),
                       ("c3", "c3_low_missing_drop"), ("c4", "c4_adult_words"),
                       ("c5", "c5_numeric_parse"), ("c6", "c6_month_standardise"),
                       ("c7", "c7_invalid_day")):
        q[name] = with_chain(f"SELECT * FROM {step}")
    return q


# --- quality suite -------------------------------------------------------------
def _sql_lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(float(v)) if isinstance(v, float) else str(v)


def suite_sql(t: str, types: dict, ctes: str, suite=None) -> str:
    """A check suite (default: the 69 booking checks) over relation ``t``
    (types: column -> Spark type name)."""
    from quaybook.operators.quality import TYPE_NAMES, build_suite

    def row(k, success, element, unexpected, percent, examples):
        return (f"SELECT {k.check_id} AS check_id, {_sql_lit(k.expectation_type)} AS expectation_type, "
                f"{_sql_lit(k.column or ', '.join(k.column_list or ['table']))} AS affected_field, {success} AS success, "
                f"CAST({element} AS BIGINT) AS element_count, CAST({unexpected} AS BIGINT) AS unexpected_count, "
                f"CAST({percent} AS DOUBLE) AS unexpected_percent, {examples} AS examples")

    def examples(cond, col):
        return (f"(SELECT coalesce(string_agg(v, '; ' ORDER BY v), '') FROM "
                f"(SELECT DISTINCT CAST({col} AS VARCHAR) AS v FROM {t} WHERE {cond} ORDER BY v LIMIT 20))")

    parts = []
    n = f"(SELECT count(*) FROM {t})"
    for k in (suite if suite is not None else build_suite()):
        c = k.column
        if k.kind == "columns":
            parts.append(row(k, "TRUE", "NULL", "NULL", "NULL", "''"))
        elif k.kind == "compound_unique":
            cols = ", ".join(k.column_list)
            u = f"(SELECT coalesce(sum(m), 0) FROM (SELECT count(*) AS m FROM {t} GROUP BY {cols} HAVING count(*) > 1))"
            parts.append(row(k, f"{u} = 0", n, u, f"100.0::DOUBLE * {u} / {n}", "''"))
        elif k.kind == "unique":
            dup = f"(SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
            u = f"(SELECT coalesce(sum(m), 0) FROM (SELECT count(*) AS m FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1))"
            parts.append(row(k, f"{u} = 0", n, u, f"100.0::DOUBLE * {u} / {n}",
                             examples(f"{c} IN {dup}", c)))
        elif k.kind == "type":
            want = TYPE_NAMES[k.type_name]
            have = types[c]
            parts.append(row(k, "TRUE" if have == want else "FALSE", "NULL", "NULL", "NULL",
                             "''" if have == want else _sql_lit(have)))
        else:
            if k.kind == "not_null":
                bad = f"{c} IS NULL"
            elif k.kind == "in_set":
                vals = ", ".join(_sql_lit(v) for v in k.values)
                bad = f"{c} IS NOT NULL AND NOT coalesce({c} IN ({vals}), false)"
            elif k.kind == "between":
                x = _numeric_text(c) if types[c] == "string" else f"CAST({c} AS DOUBLE)"
                bad = f"{c} IS NOT NULL AND NOT coalesce({x} BETWEEN {k.min_value} AND {k.max_value}, false)"
            elif k.kind == "regex":
                bad = f"{c} IS NOT NULL AND NOT coalesce(regexp_matches({c}, {_sql_lit(k.regex)}), false)"
            dom = "TRUE"
            if k.condition is not None:
                dom = f"coalesce({k.condition[0]} = {_sql_lit(k.condition[1])}, false)"
            u = f"(SELECT count(*) FROM {t} WHERE ({dom}) AND ({bad}))"
            e = f"(SELECT count(*) FROM {t} WHERE {dom})"
            pct = "NULL" if k.kind == "not_null" else f"100.0::DOUBLE * {u} / NULLIF({e}, 0)"
            ex = "''" if k.kind == "not_null" else examples(f"({dom}) AND ({bad})", c)
            parts.append(row(k, f"{u} = 0", e, u, pct, ex))
    return (f"WITH {ctes}\n" if ctes else "") + "\nUNION ALL\n".join(parts)


RAW_TYPES = {"booking_id": "bigint", "no_show": "double", "arrival_day": "double",
             "checkout_day": "double", "num_children": "double", "num_adults": "string"}
CLEAN_TYPES = {c: "bigint" for c in ("booking_id", "no_show", "arrival_day", "checkout_day",
                                     "num_children", "num_adults")}


def _types(known: dict) -> dict:
    return {c: known.get(c, "string") for c in BOOKING_COLUMNS}


def quality_queries() -> dict[str, str]:
    fail_cols = "expectation_type, affected_field, unexpected_count, unexpected_percent, examples"
    raw_suite = suite_sql("raw", _types(RAW_TYPES), clean_ctes())
    clean_suite = suite_sql("c7", _types(CLEAN_TYPES), clean_ctes())
    return {
        "v11_suite_raw": raw_suite,
        "v11_suite_clean": clean_suite,
        "v12_failures_raw": f"SELECT {fail_cols} FROM ({raw_suite}) WHERE NOT success",
        "v12_failures_clean": f"SELECT {fail_cols} FROM ({clean_suite}) WHERE NOT success",
    }


# --- split, metrics, curves ------------------------------------------------------
def _scored_ctes() -> str:
    return clean_ctes() + """,
scored AS (SELECT booking_id, CAST(no_show AS INTEGER) AS label,
                  ((booking_id * 7919) % 1000 + 200 * no_show) / 1200 AS score FROM c3)"""


def _docs_ctes() -> str:
    return """
scored AS (SELECT l.doc_id, l.quality AS label, CAST(d.n_chars AS DOUBLE) AS score
           FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def _score_table_ctes(base: str) -> str:
    return base + """,
st AS (SELECT score, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg
       FROM scored WHERE score IS NOT NULL AND label IS NOT NULL GROUP BY score),
rt AS (SELECT score, pos, neg,
              row_number() OVER (ORDER BY score DESC) - 1 AS row_index,
              sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
              sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
              sum(pos) OVER () AS P, sum(neg) OVER () AS N
       FROM st)"""


_AUC = ("round(CAST(sum(pos * (N - fp + 0.5::DOUBLE * neg)) AS DOUBLE) / "
        "(CAST(max(P) AS DOUBLE) * max(N)), 10)")
_AP = "round(sum(pos * (CAST(tp AS DOUBLE) / (tp + fp))) / max(P), 10)"


def _roc_sql(ctes: str) -> str:
    return f"""WITH {ctes},
nx AS (SELECT *, lead(pos) OVER (ORDER BY score DESC) AS np,
                 lead(neg) OVER (ORDER BY score DESC) AS nn FROM rt),
roc AS (
  SELECT CAST(-1 AS BIGINT) AS point, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr,
         'inf'::DOUBLE AS threshold FROM rt WHERE row_index = 0
  UNION ALL
  SELECT CAST(row_index AS BIGINT), CAST(fp AS DOUBLE) / NULLIF(N, 0),
         CAST(tp AS DOUBLE) / NULLIF(P, 0), score
  FROM nx WHERE row_index = 0 OR np IS NULL OR pos <> np OR neg <> nn)"""


def _pr_sql(ctes: str) -> str:
    return f"""WITH {ctes},
pr AS (
  SELECT CAST(row_index AS BIGINT) AS point,
         coalesce(CAST(tp AS DOUBLE) / NULLIF(P, 0), 1.0::DOUBLE) AS recall,
         coalesce(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), 0.0::DOUBLE) AS precision,
         score AS threshold FROM rt
  UNION ALL
  SELECT CAST(-1 AS BIGINT), 0.0::DOUBLE, 1.0::DOUBLE, CAST(NULL AS DOUBLE) FROM rt WHERE row_index = 0)"""


def _split_ctes() -> str:
    return clean_ctes() + "," + features_cte() + """,
lab AS (SELECT *, CAST(no_show AS INTEGER) AS label FROM features),
rk AS (SELECT booking_id, label,
              row_number() OVER (PARTITION BY label
                                 ORDER BY md5(CAST(booking_id AS VARCHAR) || ':42'), booking_id)
                AS rank_in_class,
              count(*) OVER (PARTITION BY label) AS nc, count(*) OVER () AS n
       FROM lab),
cl AS (SELECT DISTINCT label, nc, n, CAST(ceil(0.2::DOUBLE * n) AS HUGEINT) AS t FROM rk),
fl AS (SELECT label, t, t * nc // n AS whole, t * nc % n AS rest FROM cl),
qu AS (SELECT label, CAST(whole + CASE WHEN row_number() OVER (ORDER BY rest DESC, label)
                                  <= t - sum(whole) OVER () THEN 1 ELSE 0 END AS BIGINT) AS quota FROM fl),
sp AS (SELECT rk.*, qu.quota FROM rk JOIN qu USING (label))"""


def _line_ctes() -> str:
    return """
scored AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label,
                  CAST(l_extendedprice AS DOUBLE) / (CAST(l_extendedprice AS DOUBLE) + CAST(o_totalprice AS DOUBLE)) AS score
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _calibration_sql(ctes: str) -> str:
    probs = ", ".join(str(i / 25) for i in range(26))
    return f"""WITH {ctes},
edges AS (SELECT quantile_cont(score, [{probs}]) AS e FROM scored),
inner_edges AS (SELECT unnest(e[2:25]) AS edge FROM edges),
binned AS (SELECT s.*, (SELECT count(*) FROM inner_edges WHERE edge < s.score) AS bin FROM scored s)
SELECT CAST(bin AS INTEGER) AS bin, count(*) AS n, round(avg(score), 10) AS mean_predicted,
       round(avg(CAST(label AS DOUBLE)), 10) AS observed_rate
FROM binned GROUP BY bin"""


def split_metric_queries() -> dict[str, str]:
    sc = _score_table_ctes(_scored_ctes())
    docs = _score_table_ctes(_docs_ctes())
    lines = _score_table_ctes(_line_ctes())
    p = 0.5
    metric_sql = f"""WITH {sc},
rows_m AS (
  SELECT round(avg(power(score - label, 2)), 10) AS test_brier_score,
         round(-avg(label * ln(least(greatest(score, 2.220446049250313e-16), 1 - 2.220446049250313e-16))
               + (1 - label) * ln(1 - least(greatest(score, 2.220446049250313e-16), 1 - 2.220446049250313e-16))), 10)
           AS test_log_loss,
         round(avg(CASE WHEN (score > {p}) = (label = 1) THEN 1.0 ELSE 0.0 END)::DOUBLE, 10) AS test_accuracy,
         count(*) FILTER (WHERE score > {p} AND label = 1) AS tp,
         count(*) FILTER (WHERE score > {p} AND label = 0) AS fp,
         count(*) FILTER (WHERE score <= {p} AND label = 1) AS fn
  FROM scored),
rank_m AS (SELECT {_AUC} AS test_roc_auc, {_AP} AS test_average_precision FROM rt)
SELECT (SELECT test_roc_auc FROM rank_m) AS test_roc_auc,
       (SELECT test_average_precision FROM rank_m) AS test_average_precision,
       test_brier_score, test_log_loss, test_accuracy,
       round(coalesce(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), 0.0), 10) AS test_precision,
       round(coalesce(CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), 0.0), 10) AS test_recall,
       round(coalesce(CAST(2 * tp AS DOUBLE) / NULLIF(2 * tp + fp + fn, 0), 0.0), 10) AS test_f1
FROM rows_m"""
    return {
        "s2_split": f"WITH {_split_ctes()}\nSELECT booking_id, label, rank_in_class, "
                    "rank_in_class <= quota AS is_test FROM sp",
        "s3_folds": f"WITH {_split_ctes()}\nSELECT booking_id, "
                    "CAST((rank_in_class - quota - 1) % 5 AS INTEGER) AS fold "
                    "FROM sp WHERE rank_in_class > quota",
        "s3_folds_all_rows": f"WITH {_split_ctes()}\nSELECT booking_id, label, "
                             "CAST((rank_in_class - 1) % 5 AS INTEGER) AS fold FROM sp",
        "e1_predict_class": f"WITH {_scored_ctes()}\nSELECT booking_id, label, score, "
                            f"CAST(score > {p} AS INTEGER) AS prediction FROM scored",
        "e3_auc": f"WITH {sc}\nSELECT {_AUC} AS roc_auc FROM rt",
        "e4_avg_precision": f"WITH {sc}\nSELECT {_AP} AS average_precision FROM rt",
        "e11_metrics": metric_sql,
        "e_confusion_counts": f"""WITH {_scored_ctes()}
SELECT count(*) FILTER (WHERE score > {p} AND label = 1) AS tp,
       count(*) FILTER (WHERE score > {p} AND label = 0) AS fp,
       count(*) FILTER (WHERE score <= {p} AND label = 1) AS fn,
       count(*) FILTER (WHERE score <= {p} AND label = 0) AS tn FROM scored""",
        "r10_roc": _roc_sql(sc) + "\nSELECT * FROM roc",
        "r11_roc_guide": _roc_sql(sc) + "\nSELECT fpr, tpr, threshold FROM roc "
                                        "ORDER BY abs(tpr - 0.6), point LIMIT 1",
        "r12_pr": _pr_sql(sc) + "\nSELECT * FROM pr",
        "r13_pr_guide": _pr_sql(sc) + "\nSELECT recall, precision, threshold FROM pr "
                                      "ORDER BY abs(recall - 0.6), coalesce(threshold, 'inf'::DOUBLE) LIMIT 1",
        "r14_calibration": _calibration_sql(_scored_ctes()),
        "r14_calibration_line_share": _calibration_sql(_line_ctes()),
        "e3_auc_line_share": f"WITH {lines}\nSELECT {_AUC} AS roc_auc FROM rt",
        "r10_roc_line_share": _roc_sql(lines) + "\nSELECT * FROM roc",
        "e3_auc_doc_length_quality": f"WITH {docs}\nSELECT {_AUC} AS roc_auc FROM rt",
        "r10_roc_doc_length_quality": _roc_sql(docs) + "\nSELECT * FROM roc",
    }


def model_prep_queries() -> dict[str, str]:
    from quaybook.config import CATEGORICAL_FEATURES, NUMERIC_FEATURES
    prepared = ", ".join(
        [f"coalesce(CAST({c} AS VARCHAR), 'missing') AS {c}__cat" for c in CATEGORICAL_FEATURES]
        + [f"CAST({c} AS DOUBLE) AS {c}__num, CAST({c} IS NULL AS DOUBLE) AS {c}__missing" for c in NUMERIC_FEATURES])
    train = f"WITH {_split_ctes()},\ntr AS (SELECT lab.* FROM lab JOIN sp USING (booking_id) WHERE sp.rank_in_class > sp.quota)"
    cat_parts = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, coalesce(CAST({c} AS VARCHAR), 'missing') AS category FROM tr"
        for c in CATEGORICAL_FEATURES)
    feats = with_chain("SELECT * FROM features", features=True)
    return {
        "s1_features_target": with_chain("SELECT * EXCLUDE (no_show), CAST(no_show AS INTEGER) AS label FROM features", features=True),
        "p1_p2_prepared": with_chain(f"SELECT booking_id, {prepared} FROM features", features=True),
        "i5_features_round_trip": feats,
        "i2_cleaned_round_trip": with_chain("SELECT * FROM c7"),
        "m6_class_weights": f"""{train}
SELECT label AS class, count(*) AS rows,
       CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)) AS weight
FROM tr GROUP BY label""",
        "p3_category_index": f"""{train},
cats AS (SELECT DISTINCT feature, category FROM ({cat_parts}))
SELECT feature, category,
       CAST(row_number() OVER (PARTITION BY feature ORDER BY category) - 1 AS INTEGER) AS category_index
FROM cats""",
        "r3_dataset_summary": f"""WITH f AS ({feats})
SELECT 'rows' AS item, CAST(count(*) AS VARCHAR) AS value FROM f
UNION ALL SELECT 'columns', CAST((SELECT count(*) FROM (DESCRIBE SELECT * FROM f)) AS VARCHAR)
UNION ALL SELECT 'target column', 'no_show'""",
        "r8_target_distribution": f"""WITH f AS ({feats})
SELECT 'Show' AS booking_outcome, count(*) FILTER (WHERE no_show = 0) AS bookings FROM f
UNION ALL SELECT 'No-show', count(*) FILTER (WHERE no_show = 1) FROM f""",
    }


EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")


def given_table_queries() -> dict[str, str]:
    from quaybook.operators.quality import table_suite
    return {
        "c3a_missing_profile_events": missing_profile_sql("events", EVENT_COLUMNS),
        "v11_suite_events": suite_sql("events", {}, "", table_suite(EVENT_COLUMNS, "event_id")),
    }


def check_kind_queries() -> dict[str, str]:
    from quaybook.operators.quality import build_suite
    from quaybook.plans.queries import CHECK_KIND_QUERIES
    return {name: suite_sql("raw", _types(RAW_TYPES), clean_ctes(),
                            [k for k in build_suite() if k.kind in kinds])
            for name, kinds in CHECK_KIND_QUERIES.items()}


def _isotonic_sql(ctes: str) -> str:
    """The min-max formula: at each score the largest, over starts at or
    before it, of the smallest mean label up to any end at or after it."""
    return f"""WITH {ctes},
per AS (SELECT score AS x, sum(label) AS p, count(*) AS n FROM scored WHERE score IS NOT NULL AND label IS NOT NULL GROUP BY score),
pt AS (SELECT x, p, n, row_number() OVER (ORDER BY x) AS i, sum(p) OVER (ORDER BY x) AS cp, sum(n) OVER (ORDER BY x) AS cn FROM per),
m AS (SELECT a.i AS j, b.i AS k, CAST(b.cp - a.cp + a.p AS DOUBLE) / (b.cn - a.cn + a.n) AS v FROM pt a JOIN pt b ON b.i >= a.i),
f AS (SELECT j, k AS i, min(v) OVER (PARTITION BY j ORDER BY k DESC ROWS UNBOUNDED PRECEDING) AS v FROM m),
g AS (SELECT i, round(max(v), 9) AS calibrated FROM f GROUP BY i)
SELECT min(x) AS lo, max(x) AS hi, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(p) AS BIGINT) AS positives, calibrated
FROM g JOIN pt USING (i) GROUP BY calibrated"""


def _cv_ctes() -> str:
    splits = ", ".join(f"max(CASE WHEN fold = {i} THEN {kind}_score END) AS split{i}_{kind}_score"
                       for kind in ("test", "train") for i in range(5))
    mean = " + ".join(f"max(CASE WHEN fold = {i} THEN {{0}}_score END)" for i in range(5))
    return f"""
o AS (SELECT o_orderkey % 24 AS c, o_custkey % 5 AS fold, CAST(floor(o_totalprice) AS BIGINT) AS p FROM orders),
base AS (SELECT c, fold, avg(p % 1000) / 1000 AS test_score, avg(p % 900) / 900 AS train_score, avg(p % 7) AS fit_time
         FROM o GROUP BY c, fold),
long_scores AS (SELECT * FROM base UNION ALL SELECT c + 24, fold, test_score, train_score, fit_time FROM base WHERE c < 3),
agg AS (SELECT CAST(c AS INTEGER) AS candidate_id, {splits},
          ({mean.format('test')}) / 5 AS mean_test_score, stddev_pop(test_score) AS std_test_score,
          ({mean.format('train')}) / 5 AS mean_train_score, stddev_pop(train_score) AS std_train_score, avg(fit_time) AS mean_fit_time
        FROM long_scores GROUP BY c),
cv AS (SELECT *, 'candidate_' || candidate_id AS candidate, 'preprocessor_v1' AS preprocessor,
         CASE candidate_id % 3 WHEN 0 THEN 'RandomForestClassifier' WHEN 1 THEN 'LGBMClassifier' ELSE 'XGBClassifier' END AS model_type,
         CAST(100 * (1 + candidate_id % 3) AS VARCHAR) AS n_estimators, CAST(candidate_id % 5 AS VARCHAR) AS max_depth,
         CASE WHEN candidate_id % 3 = 0 THEN NULL WHEN candidate_id % 2 = 0 THEN '0.05' ELSE '0.1' END AS learning_rate,
         CAST((SELECT count(*) + 1 FROM agg AS b WHERE b.mean_test_score > agg.mean_test_score) AS INTEGER) AS rank_test_score
       FROM agg),
lab AS (SELECT *, preprocessor || ' + ' || CASE candidate_id % 3 WHEN 0 THEN 'RandomForest' WHEN 1 THEN 'LightGBM' ELSE 'XGBoost' END
         || ': ' || CASE WHEN learning_rate IS NULL THEN '' ELSE 'learning_rate=' || learning_rate || ', ' END
         || 'max_depth=' || max_depth || ', n_estimators=' || n_estimators AS candidate_pipeline FROM cv),
best AS (SELECT * FROM cv ORDER BY mean_test_score DESC, candidate_id LIMIT 1)"""


def experiment_queries() -> dict[str, str]:
    cv = f"WITH {_cv_ctes()}\n"
    scores = [f"split{i}_{kind}_score" for kind in ("test", "train") for i in range(5)] + [
        "mean_test_score", "std_test_score", "mean_train_score", "std_train_score", "mean_fit_time"]
    rounded = ", ".join(f"round({c}, 9) AS {c}" for c in scores)
    settings = ("SELECT candidate_id, 'best__preprocess' AS key, preprocessor AS value FROM {t} "
                "UNION ALL SELECT candidate_id, 'best__model', model_type FROM {t} "
                "UNION ALL SELECT candidate_id, 'best__model__n_estimators', n_estimators FROM {t} "
                "UNION ALL SELECT candidate_id, 'best__model__max_depth', max_depth FROM {t} "
                "UNION ALL SELECT candidate_id, 'best__model__learning_rate', learning_rate FROM {t} WHERE learning_rate IS NOT NULL")
    return {
        "k2_isotonic": _isotonic_sql(_scored_ctes()),
        "k2_isotonic_doc_length": _isotonic_sql(_docs_ctes()),
        "m8_cv_results": f"{cv}SELECT candidate_id, candidate, preprocessor, model_type, {rounded}, rank_test_score FROM cv",
        "k1_best": f"{cv}SELECT candidate_id, candidate, round(mean_test_score, 9) AS mean_test_score FROM best",
        "r1_latest_run": """
WITH recent AS (SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_orderkey, CAST(o_orderdate AS DATE) AS d
  FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC LIMIT 50)
SELECT run_id, 'FINISHED' AS status, CAST(d AS VARCHAR) AS start_day FROM recent
WHERE o_orderkey % 3 <> 0 AND o_orderkey IN (SELECT l_orderkey FROM lineitem) ORDER BY d DESC, run_id DESC LIMIT 1""",
        "r2_cv_of_run": f"""{cv}SELECT 'second' AS run_id, candidate_id, rank_test_score, learning_rate AS param_model__learning_rate,
  max_depth AS param_model__max_depth, n_estimators AS param_model__n_estimators, model_type AS param_model
FROM cv WHERE candidate_id % 3 <> 0""",
        "l2_best_parameters": cv + settings.format(t="cv"),
        "l5_stringify": f"{cv}SELECT candidate_id, 'rank' AS key, CAST(rank_test_score AS VARCHAR) AS value FROM cv "
                        "UNION ALL SELECT candidate_id, 'id', CAST(candidate_id AS VARCHAR) FROM cv",
        "r5_candidate_label": f"{cv}SELECT candidate_id, candidate_pipeline FROM lab",
        "r6_candidate_ranking": f"{cv}SELECT rank_test_score, printf('%.3f', mean_test_score) AS mean_test_score, candidate_pipeline FROM lab",
        "r7_selected_pipeline": f"""{cv}SELECT 'preprocessor' AS component, 'selected preprocessor' AS detail, preprocessor AS value FROM best
UNION ALL SELECT 'model', 'selected model', model_type FROM best
UNION ALL SELECT 'hyperparameter', substr(key, 14), value FROM ({settings.format(t='best')}) WHERE starts_with(key, 'best__model__')""",
        "r9_cv_bars": f"{cv}SELECT 'Rank ' || rank_test_score AS rank_label, rank_test_score, round(mean_test_score, 9) AS mean_test_score FROM cv",
    }
