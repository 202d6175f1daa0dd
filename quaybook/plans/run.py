"""Run the whole booking chain and persist every output, the way the
original's stage scripts do, as plain function chaining:

ingest -> clean -> validate raw and cleaned (JSON results + CSV failures)
-> features (parquet) -> experiment (run log, model, summary) -> report data.

    python -m quaybook.plans.run --given /root/testdata/sf0.01 --out /shared/run1
    python -m quaybook.plans.run --raw /data/bookings.parquet --out /shared/run1
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from quaybook.config import DEFAULT
from quaybook.operators import clean as C
from quaybook.operators import features as FE
from quaybook.operators import models as MD
from quaybook.operators import quality as Q
from quaybook.plans.stages import write_stage
from quaybook.sources import sinks
from quaybook.sources.bookings import derive_raw_bookings, read_raw_bookings


def run_chain(spark: SparkSession, out: str, raw_path: str | None = None,
              given_dir: str | None = None, fmt: str = "parquet",
              grid: list[dict] | None = None, with_model: bool = True,
              parallelism: int = 1) -> dict:
    """Runs every stage and writes its outputs under ``out``."""
    if raw_path:
        raw = read_raw_bookings(spark, raw_path, fmt)
    elif given_dir:
        raw = derive_raw_bookings(spark, given_dir)
    else:
        raise ValueError("give raw_path or given_dir")
    raw = write_stage(raw, "raw")
    cleaned = write_stage(C.clean(raw, DEFAULT), "cleaned")
    sinks.write_parquet(cleaned, os.path.join(out, "cleaned"))
    for name, table in (("raw", raw), ("cleaned", cleaned)):
        results = Q.run_suite(table)
        sinks.write_json(results, os.path.join(out, "validation", f"{name}_results"))
        sinks.write_csv(Q.failures(results), os.path.join(out, "validation", f"{name}_failures"))
    features = FE.add_features(sinks.read_parquet(spark, os.path.join(out, "cleaned")), DEFAULT)
    sinks.write_parquet(features, os.path.join(out, "features"))
    outputs = {"cleaned": os.path.join(out, "cleaned"), "features": os.path.join(out, "features")}
    if with_model:
        from quaybook.plans.experiment import LARGE_REPORTS, report_data, run_experiment
        feats = sinks.read_parquet(spark, os.path.join(out, "features"))
        result = run_experiment(feats, os.path.join(out, "experiment"), grid=grid,
                                parallelism=parallelism)
        for name, df in report_data(feats, os.path.join(out, "experiment")).items():
            sinks.write_json(df, os.path.join(out, "report", name), one_file=name not in LARGE_REPORTS)
        outputs.update(run_id=result["run_id"], metrics=result["metrics"])
    return outputs


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--raw", help="stored raw booking table")
    src.add_argument("--given", help="folder of the given tables (derive bookings)")
    ap.add_argument("--format", default="parquet", choices=("parquet", "csv"))
    ap.add_argument("--out", required=True, help="output folder (shared on a cluster)")
    ap.add_argument("--settings-per-family", type=int, default=0,
                    help="search only the first N settings of each model family (0 = all 96)")
    ap.add_argument("--no-model", action="store_true", help="stop after the feature table")
    ap.add_argument("--parallelism", type=int, default=1)
    args = ap.parse_args(argv)
    from quaybook.session import ensure_checkpoint_dir
    spark = SparkSession.builder.appName("quaybook").getOrCreate()
    ensure_checkpoint_dir(spark)
    grid = MD.candidate_grid()
    if args.settings_per_family:
        seen: dict[str, int] = {}
        picked = []
        for g in grid:
            seen[g["candidate"]] = seen.get(g["candidate"], 0) + 1
            if seen[g["candidate"]] <= args.settings_per_family:
                picked.append(g)
        grid = picked
    print(run_chain(spark, args.out, args.raw, args.given, args.format, grid,
                    not args.no_model, args.parallelism))


if __name__ == "__main__":
    main()
