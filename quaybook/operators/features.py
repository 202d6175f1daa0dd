"""Feature operators F1-F9: row-local projections, no shuffle.

:func:`add_features` applies all nine in one ``withColumns`` chain that
Catalyst collapses into a single projection inside one code-generated stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaybook.config import (DAYS_IN_REFERENCE_YEAR, DEFAULT, MONTHS_PER_YEAR,
                             PRICE_PARSE_REGEX, BookingConfig)
from quaybook.functions.calendar import (day_of_reference_year, month_number,
                                         reference_date)


def _positive(c: Column) -> Column:
    return F.when(c > 0, c)


def parse_price(df: DataFrame, cfg: BookingConfig = DEFAULT) -> DataFrame:
    """F1: ``price_currency`` and ``price_amount`` from text like 'SGD$ 492.98'.
    Outer whitespace allowed; any other text gives NULL for both."""
    p = F.col(cfg.price_col).cast("string")
    cur = F.nullif(F.regexp_extract(p, PRICE_PARSE_REGEX, 1), F.lit(""))
    amt = F.nullif(F.regexp_extract(p, PRICE_PARSE_REGEX, 2), F.lit(""))
    return df.withColumns({"price_currency": cur,
                           "price_amount": amt.try_cast("double")})


def price_in_sgd(df: DataFrame, cfg: BookingConfig = DEFAULT) -> DataFrame:
    """SGD amount; USD converted at the fixed rate; other currencies NULL."""
    cur, amt = F.col("price_currency"), F.col("price_amount")
    return df.withColumn("price_amount_sgd",
                         F.when(cur == "SGD", amt)
                          .when(cur == "USD", amt * F.lit(float(cfg.usd_to_sgd))))


def add_reference_dates(df: DataFrame, cfg: BookingConfig = DEFAULT) -> DataFrame:
    """arrival and checkout as dates in the reference year (NULL when the
    month name is not exact or the day does not exist)."""
    return df.withColumns({
        "arrival_date": reference_date(F.col(cfg.arrival_month_col), F.col(cfg.arrival_day_col)),
        "checkout_date": reference_date(F.col(cfg.checkout_month_col), F.col(cfg.checkout_day_col)),
    })


def _stay_nights(cfg: BookingConfig) -> Column:
    arrive = day_of_reference_year(month_number(F.col(cfg.arrival_month_col)),
                                   F.col(cfg.arrival_day_col))
    leave = day_of_reference_year(month_number(F.col(cfg.checkout_month_col)),
                                  F.col(cfg.checkout_day_col))
    n = leave - arrive
    return F.when(n < 0, n + DAYS_IN_REFERENCE_YEAR).otherwise(n).cast("int")


def add_stay_length(df: DataFrame, cfg: BookingConfig = DEFAULT) -> DataFrame:
    """checkout minus arrival in days; a negative stay wraps the year."""
    return df.withColumn("stay_length_nights", _stay_nights(cfg))


def add_month_gap(df: DataFrame, cfg: BookingConfig = DEFAULT) -> DataFrame:
    """arrival month minus booking month, wrapped into 0..11."""
    gap = (month_number(F.col(cfg.arrival_month_col))
           - month_number(F.col(cfg.booking_month_col)))
    return df.withColumn("booking_to_arrival_month_gap",
                         F.when(gap < 0, gap + MONTHS_PER_YEAR).otherwise(gap).cast("int"))


def add_total_guests(df: DataFrame, cfg: BookingConfig = DEFAULT) -> DataFrame:
    """adults + children; NULL if either is NULL."""
    return df.withColumn("total_guests",
                         (F.col(cfg.adults_col) + F.col(cfg.children_col)).cast("bigint"))


def add_price_per_guest(df: DataFrame) -> DataFrame:
    """SGD price / guests; NULL unless guests > 0."""
    return df.withColumn("price_per_guest",
                         F.col("price_amount_sgd") / _positive(F.col("total_guests")))


def add_price_per_night(df: DataFrame) -> DataFrame:
    """F8: SGD price / nights; NULL unless nights > 0."""
    return df.withColumn("price_per_night",
                         F.col("price_amount_sgd") / _positive(F.col("stay_length_nights")))


def add_price_per_guest_night(df: DataFrame) -> DataFrame:
    """SGD price / (guests x nights); both must be > 0."""
    guest_nights = _positive(F.col("total_guests")) * _positive(F.col("stay_length_nights"))
    return df.withColumn("price_per_guest_per_night", F.col("price_amount_sgd") / guest_nights)


FEATURE_COLUMNS = (
    "price_currency", "price_amount", "price_amount_sgd", "stay_length_nights",
    "booking_to_arrival_month_gap", "total_guests", "price_per_guest",
    "price_per_night", "price_per_guest_per_night",
)


def add_features(df: DataFrame, cfg: BookingConfig = DEFAULT) -> DataFrame:
    """F1, F2, F4-F9 in the original order (F3 is transient there)."""
    return (df.transform(parse_price, cfg)
              .transform(price_in_sgd, cfg)
              .transform(add_stay_length, cfg)
              .transform(add_month_gap, cfg)
              .transform(add_total_guests, cfg)
              .transform(add_price_per_guest)
              .transform(add_price_per_night)
              .transform(add_price_per_guest_night))
