"""Raw booking source.

Two ways in:

* :func:`read_raw_bookings` reads a stored booking table (parquet, csv or a
  JDBC table split on ``booking_id`` ranges) with the declared schema, never an
  inferred one.
* :func:`derive_raw_bookings` derives a messy booking table from the given
  ``orders`` and ``customer`` tables. The derivation is one SQL text that runs
  unchanged in Spark SQL and DuckDB, so the oracle sees identical raw rows.
  It uses only integer arithmetic, CASE, ``||``, ``lower``, ``upper``, ``lpad``,
  ``floor`` and casts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quaybook.config import MONTH_NAMES
from quaybook.sources.tables import read_table, spread

RAW_SCHEMA = T.StructType([
    T.StructField("booking_id", T.LongType()),
    T.StructField("no_show", T.DoubleType()),
    T.StructField("branch", T.StringType()),
    T.StructField("booking_month", T.StringType()),
    T.StructField("arrival_month", T.StringType()),
    T.StructField("arrival_day", T.DoubleType()),
    T.StructField("checkout_month", T.StringType()),
    T.StructField("checkout_day", T.DoubleType()),
    T.StructField("country", T.StringType()),
    T.StructField("first_time", T.StringType()),
    T.StructField("room", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("platform", T.StringType()),
    T.StructField("num_adults", T.StringType()),
    T.StructField("num_children", T.DoubleType()),
])


#: Text formats: every column stays text until C5 parses the numbers, so that
#: the checks see what can't be parsed and ``numeric_parse_rejects`` counts it.
TEXT_SCHEMA = T.StructType([T.StructField(f.name, T.StringType()) for f in RAW_SCHEMA.fields])


def _month_table(alias: str) -> str:
    """A 12-row inline table (idx, name): month names by 0-based index."""
    rows = ", ".join(f"({i}, '{m}')" for i, m in enumerate(MONTH_NAMES))
    return f"(VALUES {rows}) AS {alias}(idx, name)"


def _messy_month(m: str, j: int) -> str:
    return (f"(CASE WHEN k % 409 = {j} THEN 'Unknown' "
            f"WHEN k % 5 = {j} THEN lower({m}) "
            f"WHEN k % 5 = {(j + 1) % 5} THEN upper({m}) "
            f"WHEN k % 5 = {(j + 2) % 5} THEN ' ' || {m} || ' ' "
            f"ELSE {m} END)")


def raw_bookings_sql(orders: str = "orders", customer: str = "customer") -> str:
    """The booking derivation as SQL text over two table references."""
    return f"""
WITH base AS (
  SELECT o.o_orderkey AS k,
         CAST(floor(o.o_totalprice) AS BIGINT) AS p,
         c.c_nationkey AS n,
         o.o_orderpriority AS prio
  FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
),
h1 AS (
  SELECT k, p, n, prio,
         (k * 7) % 12 AS bm,
         ((k * 7) + (p % 5)) % 12 AS am,
         1 + ((k * 13) + p) % 31 AS ad,
         (p % 97) % 6 AS nn
  FROM base
),
h2 AS (
  SELECT k, p, n, prio, bm, am, ad,
         CASE WHEN ad + nn > 28 THEN (am + 1) % 12 ELSE am END AS cm,
         CASE WHEN ad + nn > 28 THEN ad + nn - 28 ELSE ad + nn END AS cd
  FROM h1
),
h3 AS (
  SELECT h2.k, h2.p, h2.n, h2.prio, h2.ad, h2.cd,
         mb.name AS bm_name, ma.name AS am_name, mc.name AS cm_name
  FROM h2
  JOIN {_month_table('mb')} ON mb.idx = h2.bm
  JOIN {_month_table('ma')} ON ma.idx = h2.am
  JOIN {_month_table('mc')} ON mc.idx = h2.cm
),
bookings AS (
  SELECT
    k AS booking_id,
    CASE WHEN k % 997 = 5 THEN NULL
         WHEN (p % 10) + (CASE WHEN n % 7 < 3 THEN 4 ELSE 0 END)
              + (CASE WHEN p % 1000 > 600 THEN 3 ELSE 0 END) > 9 THEN 1.0e0
         ELSE 0.0e0 END AS no_show,
    CASE WHEN p % 2 = 0 THEN 'Changi' ELSE 'Orchard' END AS branch,
    {_messy_month('bm_name', 1)} AS booking_month,
    {_messy_month('am_name', 2)} AS arrival_month,
    CAST(ad AS DOUBLE) AS arrival_day,
    {_messy_month('cm_name', 3)} AS checkout_month,
    CAST(CASE WHEN k % 211 = 9 THEN -cd ELSE cd END AS DOUBLE) AS checkout_day,
    CASE WHEN k % 101 = 3 THEN NULL
         ELSE (CASE n % 7 WHEN 0 THEN 'Australia' WHEN 1 THEN 'China'
               WHEN 2 THEN 'India' WHEN 3 THEN 'Indonesia' WHEN 4 THEN 'Japan'
               WHEN 5 THEN 'Malaysia' ELSE 'Singapore' END) END AS country,
    CASE WHEN p % 3 = 0 THEN 'Yes' ELSE 'No' END AS first_time,
    CASE WHEN k % 6 = 4 THEN NULL
         ELSE (CASE p % 4 WHEN 0 THEN 'Single' WHEN 1 THEN 'Queen'
               WHEN 2 THEN 'King' ELSE 'President Suite' END) END AS room,
    CASE WHEN k % 12 = 7 THEN NULL
         WHEN k % 503 = 8 THEN 'EUR$ 10.00'
         ELSE (CASE WHEN k % 3 = 0 THEN 'USD' ELSE 'SGD' END) || '$ '
              || CAST(50 + p % 1000 AS STRING) || '.'
              || lpad(CAST(p % 100 AS STRING), 2, '0') END AS price,
    CASE prio WHEN '1-URGENT' THEN 'Phone' WHEN '2-HIGH' THEN 'Agent'
              WHEN '3-MEDIUM' THEN 'Email' ELSE 'Website' END AS platform,
    CASE k % 7 WHEN 0 THEN 'one' WHEN 1 THEN 'Two' WHEN 2 THEN '1'
               WHEN 3 THEN '2' WHEN 4 THEN 'TWO' WHEN 5 THEN '1'
               ELSE '2' END AS num_adults,
    CAST(k % 4 AS DOUBLE) AS num_children
  FROM h3
)
SELECT * FROM bookings
UNION ALL
SELECT * FROM bookings WHERE booking_id % 40 = 0
"""


def derive_raw_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw, messy bookings derived from ``orders`` joined to ``customer``.

    At scale this is a shuffle join on the customer key; AQE turns it into a
    broadcast join only when the customer side is measured small, and splits a
    hot customer key with its skew-join handling.
    """
    orders = spread(read_table(spark, sf_dir, "orders")
                    .select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"))
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return spark.sql(raw_bookings_sql("{orders}", "{customer}"),
                     orders=orders, customer=customer)


def read_raw_bookings(spark: SparkSession, path: str, fmt: str = "parquet",
                      **options) -> DataFrame:
    """Read a stored raw booking table with the declared schema.

    For a relational source pass ``fmt='jdbc'`` with ``url``/``dbtable`` and the
    partitioning options (``partitionColumn='booking_id'``, ``lowerBound``,
    ``upperBound``, ``numPartitions``) so the read is split across tasks.
    """
    if fmt == "jdbc":
        options = {"table": options.pop("dbtable", path), "num_partitions": int(options.pop("numPartitions", 8)), **options}
        return read_raw_bookings_jdbc(spark, options.pop("url"), options.pop("table"), options.pop("num_partitions"),
                                      properties=options)
    reader = spark.read.options(**options)
    if fmt == "csv":
        reader = reader.option("header", "true")
        return reader.schema(TEXT_SCHEMA).format(fmt).load(path)
    return reader.schema(RAW_SCHEMA).format(fmt).load(path)


def read_raw_bookings_jdbc(spark: SparkSession, url: str, table: str,
                           num_partitions: int, properties: dict | None = None,
                           id_col: str = "booking_id") -> DataFrame:
    """I1 from a relational database: the read is split into
    ``num_partitions`` ranges of ``id_col``, each fetched by its own task.
    The bounds come from a MIN/MAX query that runs inside the database, and
    the columns are cast to the declared raw schema (never inferred)."""
    props = dict(properties or {})
    bounds = spark.read.jdbc(
        url, f"(SELECT MIN({id_col}) AS lo, MAX({id_col}) AS hi FROM {table}) AS b",
        properties=props).first()
    if bounds is None or bounds["lo"] is None:
        df = spark.read.jdbc(url, table, properties=props)
    else:
        df = spark.read.jdbc(url, table, column=id_col, lowerBound=int(bounds["lo"]),
                             upperBound=int(bounds["hi"]) + 1,
                             numPartitions=num_partitions, properties=props)
    return df.select(*[df[f.name].try_cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields])
