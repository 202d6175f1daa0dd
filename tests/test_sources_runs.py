import os

from pyspark.sql import functions as F

from quaybook.operators import runs as L
from quaybook.plans.queries import raw
from quaybook.operators import clean as C
from quaybook.sources.bookings import RAW_SCHEMA, TEXT_SCHEMA, read_raw_bookings
from quaybook.sources.tables import spread
from conftest import SF001


def test_read_raw_with_declared_schema(spark, scratch):
    src = raw(spark, SF001)
    src.write.parquet(os.path.join(scratch, "p"))
    (src.write.option("header", True).option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False).csv(os.path.join(scratch, "c")))
    for fmt, sub, schema in (("parquet", "p", RAW_SCHEMA), ("csv", "c", TEXT_SCHEMA)):
        back = read_raw_bookings(spark, os.path.join(scratch, sub), fmt)
        assert back.schema == schema
        assert back.count() == 1538
        typed = back.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields])
        assert typed.exceptAll(src).count() == 0
    # From text or typed, cleaning ends with the same rows.
    assert C.clean(back).exceptAll(C.clean(src)).count() == 0


def test_spread_only_when_too_few_partitions(spark):
    one = spark.range(100).coalesce(1)
    assert spread(one, 4).rdd.getNumPartitions() == 4
    many = spark.range(100).repartition(16)
    assert spread(many, 4).rdd.getNumPartitions() == 16


def test_best_parameter_maps(spark):
    df = spark.createDataFrame([({"model__n_estimators": 300.0, "model__learning_rate": 0.05},)],
                               "m map<string,double>")
    out = df.select(L.format_best_parameters(F.col("m")).alias("f")).first().f
    assert out == {"best__model__n_estimators": "300.0", "best__model__learning_rate": "0.05"}
    s = df.select(L.stringify_mapping(F.col("m")).alias("s")).first().s
    assert s["model__learning_rate"] == "0.05"


def test_cv_table_param_columns(spark):
    cv = spark.createDataFrame(
        [(0, "RandomForestClassifier", {"max_depth": None, "n_estimators": "100"}),
         (1, "XGBClassifier", {"max_depth": "3", "learning_rate": "0.1"})],
        "candidate_id int, model_type string, params map<string,string>")
    t = L.cv_results_table(cv)
    assert {"param_model__max_depth", "param_model__n_estimators",
            "param_model__learning_rate", "param_model"} <= set(t.columns)
    row = t.where("candidate_id = 0").first()
    assert row.param_model__learning_rate is None and row.param_model__n_estimators == "100"


def test_chain_runner_writes_every_stage(spark, scratch):
    from quaybook.plans.run import run_chain
    out = run_chain(spark, os.path.join(scratch, "run"), given_dir=SF001, with_model=False)
    assert spark.read.parquet(out["features"]).count() == 1483
    res = spark.read.json(os.path.join(scratch, "run", "validation", "raw_results"))
    assert res.count() == 69
    fail = spark.read.option("header", True).csv(
        os.path.join(scratch, "run", "validation", "cleaned_failures"))
    assert fail.count() >= 1
