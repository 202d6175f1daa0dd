"""Cleaning operators C1-C7 and the missing-rate profile C3a.

The fixed order is C1, C2, C3, C4, C5, C6, C7 (:func:`clean`): C3's rates are
measured after C1 and C2, and C7 needs C5's integers.

Scale notes: C1 is the only shuffle (a hash aggregate over all columns with
map-side partial aggregation, so even a hot duplicate collapses before the
exchange). C3's statistics are one pass over its input written as a stage, with
a few bytes per task shuffled. Everything else is a row-local projection
fused into one code-generated stage.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaybook.config import DEFAULT, BookingConfig
from quaybook.functions.calendar import days_in_month, month_number_loose
from quaybook.functions.text import strip_ws, title_case, to_nullable_long
from quaybook.plans.stages import write_stage


# C1 ---------------------------------------------------------------------------
def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Exact duplicates over all columns; NULL equals NULL."""
    return df.distinct()


# C2 ---------------------------------------------------------------------------
def drop_missing_target(df: DataFrame, cfg: BookingConfig = DEFAULT) -> DataFrame:
    """Keep rows whose target is present."""
    return df.where(F.col(cfg.target_col).isNotNull())


# C3a ----------------------------------------------------------------------------
def _null_stats(df: DataFrame) -> DataFrame:
    """One row: total rows and the NULL count of every column (one pass)."""
    return df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def _qualifies(nulls: Column, rows: Column, threshold: float) -> Column:
    rate = F.try_divide(nulls.cast("double"), rows)
    return F.coalesce((rate > 0) & (rate < threshold), F.lit(False))


def missing_profile(df: DataFrame, cfg: BookingConfig = DEFAULT) -> DataFrame:
    """One row per column: missing count, rate, whether C3 drops on it."""
    stats = _null_stats(df)
    rows = F.col("__rows")
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"),
                 F.col(c).alias("missing_count"),
                 F.try_divide(F.col(c).cast("double"), rows).alias("missing_rate"),
                 _qualifies(F.col(c), rows, cfg.missing_drop_threshold).alias("qualifies"))
        for i, c in enumerate(df.columns)
    ]
    return stats.select(rows.alias("row_count"), F.inline(F.array(*entries)))


# C3 -----------------------------------------------------------------------------
def drop_rows_with_low_missingness(df: DataFrame,
                                   cfg: BookingConfig = DEFAULT) -> DataFrame:
    """For columns with 0 < missing rate < threshold (both strict), drop
    rows that are NULL in any of them; other columns keep their NULLs.

    The input is written as a stage and its NULLs are counted from that, so
    what led to it, the all-column shuffle of C1 above all, runs once; the
    kept columns' filters then reach the scan of the stage. The driver sees
    one row of counts. An empty table gives no qualifying column and an empty
    result. (Counting in the writing pass by ``observe`` would leave a session
    in which Spark ML models can't be sent to tasks.)
    """
    staged = write_stage(df, "before_c3")
    n, *nulls = _null_stats(staged).first()
    low = [c for c, missing in zip(df.columns, nulls, strict=True) if n and 0 < missing / n < cfg.missing_drop_threshold]
    return staged.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in low], F.lit(True)))


# C4 -----------------------------------------------------------------------------
def adult_words_to_digits(df: DataFrame, cfg: BookingConfig = DEFAULT) -> DataFrame:
    """C4: lower-case the adult count text and map whole words to digits
    ('one' -> '1', 'two' -> '2'); no trim; NULL stays NULL."""
    c = cfg.adults_col
    if not isinstance(df.schema[c].dataType, T.StringType):
        return df
    low = F.lower(F.col(c))
    mapped = None
    for word, digit in cfg.adult_words.items():
        mapped = (F.when(low == word, F.lit(digit)) if mapped is None
                  else mapped.when(low == word, F.lit(digit)))
    return df.withColumn(c, low if mapped is None else mapped.otherwise(low))


# C5 -----------------------------------------------------------------------------
def parse_numeric_columns(df: DataFrame, cfg: BookingConfig = DEFAULT) -> DataFrame:
    """Numeric columns to nullable bigint; unparseable, fractional or
    infinite values become NULL instead of failing the job."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: to_nullable_long(F.col(c), types[c])
                           for c in cfg.integer_cols if c in types})


def numeric_parse_rejects(df: DataFrame, cfg: BookingConfig = DEFAULT) -> DataFrame:
    """Count, per numeric column, values present before C5 and NULL after it
    (the cases the original parse raises on or silently nulls)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = [c for c in cfg.integer_cols if c in types]
    aggs = [F.count_if(F.col(c).isNotNull() & to_nullable_long(F.col(c), types[c]).isNull())
            .alias(c) for c in cols]
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("rejected_count"))
               for c in cols]
    return df.agg(*aggs).select(F.inline(F.array(*entries)))


# C6 -----------------------------------------------------------------------------
def month_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if f.name.endswith("_month") and isinstance(f.dataType, T.StringType)]


def standardize_months(df: DataFrame) -> DataFrame:
    """Every string column named ``*_month``: strip whitespace, title case."""
    return df.withColumns({c: title_case(strip_ws(F.col(c))) for c in month_columns(df)})


# C7 -----------------------------------------------------------------------------
def null_invalid_days(df: DataFrame) -> DataFrame:
    """For each ``X_month`` with an ``X_day`` partner, NULL the day when it
    is below 1, or when the month is a known name and the day exceeds that
    month's length in the reference year. An unknown or NULL month keeps a
    day >= 1 (three-valued logic on the missing upper bound does exactly that).
    """
    updates = {}
    for m in [c for c in df.columns if c.endswith("_month")]:
        d = m[: -len("_month")] + "_day"
        if d not in df.columns:
            continue
        day = F.col(d)
        max_day = days_in_month(month_number_loose(F.col(m).cast("string")))
        updates[d] = F.when(~((day >= 1) & (day <= max_day)), None).otherwise(day)
    return df.withColumns(updates) if updates else df


# Chain --------------------------------------------------------------------------
def clean(df: DataFrame, cfg: BookingConfig = DEFAULT) -> DataFrame:
    """C1 -> C2 -> C3 -> C4 -> C5 -> C6 -> C7."""
    return (df.transform(drop_duplicate_rows)
              .transform(drop_missing_target, cfg)
              .transform(drop_rows_with_low_missingness, cfg)
              .transform(adult_words_to_digits, cfg)
              .transform(parse_numeric_columns, cfg)
              .transform(standardize_months)
              .transform(null_invalid_days))
