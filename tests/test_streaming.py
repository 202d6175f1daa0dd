import os
import shutil

from quaybook.plans.queries import featured, raw
from quaybook.sources.bookings import RAW_SCHEMA
from quaybook.streaming import bookings as ST
from conftest import SF001


def test_stream_features_equal_batch(spark, scratch):
    src = os.path.join(scratch, "in")
    base = raw(spark, SF001).distinct()
    base.write.parquet(src)
    stream = ST.read_booking_stream(spark, src)
    q = ST.start_feature_sink(ST.row_local_features(stream), os.path.join(scratch, "out"),
                              os.path.join(scratch, "ck"), available_now=True)
    q.awaitTermination(300)
    got = spark.read.parquet(os.path.join(scratch, "out"))
    want = ST.row_local_features(base)
    assert got.count() == want.count() == 1498
    cols = ["booking_id", "price_amount_sgd", "stay_length_nights", "total_guests"]
    assert got.select(cols).exceptAll(want.select(cols)).count() == 0


def test_stream_quality_per_batch(spark, scratch):
    src = os.path.join(scratch, "in")
    raw(spark, SF001).write.parquet(src)
    q = ST.start_quality_sink(ST.read_booking_stream(spark, src), os.path.join(scratch, "q"),
                              os.path.join(scratch, "ck"), available_now=True)
    q.awaitTermination(300)
    res = spark.read.parquet(os.path.join(scratch, "q"))
    assert res.count() == 69
    assert res.where("check_id = 2").first().unexpected_count == 0  # C1 ran first


def test_a_batch_that_runs_again_counts_once(spark, scratch):
    src, out, ck = (os.path.join(scratch, x) for x in ("in", "q", "ck"))
    halves = raw(spark, SF001).randomSplit([0.5, 0.5], seed=3)
    for half in halves:  # a batch for each file
        half.coalesce(1).write.mode("append").parquet(src)

    def run(checkpoint):
        stream = ST.read_booking_stream(spark, src, max_files_per_trigger=1)
        ST.start_quality_sink(stream, out, checkpoint, available_now=True).awaitTermination(300)
        return {(r.batch_id, r.check_id): r.element_count for r in spark.read.parquet(out).collect()}, spark.read.parquet(out).count()

    first, n = run(ck)
    assert n == len(first) == 2 * 69
    # Lost after the write and before the second batch was marked as done.
    again = os.path.join(scratch, "ck2")
    shutil.copytree(ck, again, ignore=lambda d, names: [x for x in names if x in ("1", ".1.crc")] if d.endswith("commits") else [])
    assert run(again) == (first, n)


def test_csv_stream_keeps_text(spark, scratch):
    src = os.path.join(scratch, "in")
    rows = raw(spark, SF001).limit(5).selectExpr("* EXCEPT (arrival_day)", "'abc' AS arrival_day").select(RAW_SCHEMA.names)
    rows.write.option("header", True).csv(src)
    stream = ST.read_booking_stream(spark, src, "csv")
    q = stream.writeStream.format("parquet").option("path", os.path.join(scratch, "out")).option(
        "checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start()
    q.awaitTermination(300)
    back = spark.read.parquet(os.path.join(scratch, "out"))
    assert back.count() == 5 and {r.arrival_day for r in back.collect()} == {"abc"}
