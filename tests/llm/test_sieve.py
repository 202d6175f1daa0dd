"""Parting by a list: every row on the right side, and whole texts at rest."""
import re

import pytest
from pyspark.sql import functions as F

from quaybook.llm import decontaminate, minhash, sieve


def test_every_row_on_one_side(spark):
    rows = [(None if i % 50 == 0 else i, f"t{i % 700}") for i in range(3000)] * 2
    listed = {(i, f"t{i % 700}") for i in range(0, 3000, 7)} | {(None, "t50"), (9999, "t1")}
    df = spark.createDataFrame(rows, "doc_id long, key string")
    there = spark.createDataFrame(list(listed), df.schema)
    clear, rest = (sorted(map(tuple, x.collect()), key=str) for x in sieve.parted(df, ["doc_id", "key"], there))
    assert sorted(clear + rest, key=str) == sorted(rows, key=str)
    assert not set(clear) & listed and {r for r in rows if r in listed} <= set(rest)
    assert len([r for r in rest if r not in listed]) < 0.1 * len(rows)


def test_too_few_bits_and_nothing_listed(spark):
    df = spark.range(100_000).withColumnRenamed("id", "doc_id")
    clear, rest = sieve.parted(df, ["doc_id"], df.where("doc_id % 2 = 0"), most=sieve.BLOCK)
    assert clear.where("doc_id % 2 = 0").isEmpty() and clear.count() + rest.count() == 100_000
    clear, rest = sieve.parted(df, ["doc_id"], df.limit(0))
    assert clear.count() == 100_000 and rest.isEmpty()


def scans_at_rest(df):
    """How many scans of a text have no shuffle above them in the plan."""
    above, found = [], 0
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = re.match(r"[\s:+\-]*", line).end()
        above = [(d, x) for d, x in above if d < depth] + [(depth, line[depth:])]
        if re.search(r"FileScan parquet \[.*\btext#", line):
            found += not any(re.match(r"Exchange hashpartitioning", x) for _, x in above)
    return found


@pytest.fixture
def no_broadcast(spark):
    """As with lists too long for it."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_texts_that_stay_are_not_shuffled(spark, tmp_path, no_broadcast):
    texts = [" ".join(f"w{j}x{i % 97 if i < 200 else i}" for j in range(60)) for i in range(230)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(5, texts[5])] * 3, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    items = spark.createDataFrame([("a", texts[3]), ("b", texts[210])], "item_id string, text string")
    for kept in (minhash.keep_one_each(docs), decontaminate.clean_documents(docs, items)):
        assert scans_at_rest(kept) == 1
        assert kept.columns == docs.columns
    once = sorted(r.doc_id for r in minhash.keep_one_each(docs).collect())
    brute = docs.groupBy("text").agg(F.min("doc_id").alias("doc_id"))
    assert once == sorted(r.doc_id for r in brute.collect())
    clean = sorted(r.doc_id for r in decontaminate.clean_documents(docs, items).collect())
    assert clean == sorted(r.doc_id for r in docs.collect() if r.text not in (texts[3], texts[210]))
