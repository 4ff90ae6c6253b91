"""Run one step or the whole day from a configuration file.

    spark-submit -m millwright <step> --config pipeline.yaml --dimension dim_product=/path

Steps: ingest, quality, downtime, check, publish, run. A failure ends the
process with a non-zero status. `publish` also refreshes the indicators. `day` lands
what is new of today's files and recomputes only what that touches, in tables
of its own, partitioned by `--unit`.
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence

from pyspark.sql import SparkSession

from millwright.params import Params
from millwright.plans import daily, pipeline
from millwright.schemas import INGESTED_AT
from millwright.sources import read_parquet
from millwright.workspace import open_session

STEPS = ("ingest", "quality", "downtime", "check", "publish", "run", "day")

log = logging.getLogger("millwright")


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="millwright")
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("--config", required=True, help="YAML file with the layer paths and thresholds")
    parser.add_argument("--dimension", action="append", default=[], metavar="TABLE=PARQUET",
                        help="a dimension table, e.g. dim_product=/path; may be repeated")
    parser.add_argument("--late-reference", default=INGESTED_AT,
                        help="column that inspection times are compared with")
    parser.add_argument("--accept-row-counts", action="store_true",
                        help="check: take row counts as they are into the history")
    parser.add_argument("--unit", default="day", help="day: the period of a partition, such as day or month")
    parser.add_argument("--infer", action="store_true", help="take CSV types from the files")
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    args = _arguments(argv)
    params = Params.from_yaml(args.config)
    spark = spark or open_session(f"millwright-{args.step}")
    dimensions = {
        name: read_parquet(spark, path) for name, path in (d.split("=", 1) for d in args.dimension)
    }
    ingested, published = [], {}
    if args.step == "ingest":
        ingested = pipeline.ingest_raw(spark, params, infer=args.infer)
    elif args.step == "quality":
        pipeline.build_quality(spark, params, args.late_reference)
    elif args.step == "downtime":
        pipeline.build_downtime(spark, params)
    elif args.step == "check":
        pipeline.check(spark, params, dimensions=dimensions, accept_row_counts=args.accept_row_counts)
    elif args.step == "publish":
        pipeline.require_dimensions(dimensions)
        pipeline.require_passed_gate(spark, params)
        published = pipeline.publish_all(spark, params, dimensions)
    elif args.step == "day":
        pipeline.require_dimensions(dimensions)
        landed, refreshed = daily.run_day(spark, params, dimensions["dim_product"], unit=args.unit, infer=args.infer)
        for d in landed:
            log.info("%s: %d rows read, %d new, in %d periods", d.dataset, d.rows_read, d.rows_new, len(d.periods))
        for table, periods in refreshed.items():
            log.info("%s: %d periods recomputed", table, len(periods))
    else:
        run = pipeline.run_pipeline(
            spark, params, dimensions, late_reference=args.late_reference, infer=args.infer,
            accept_row_counts=args.accept_row_counts,
        )
        ingested, published = run.ingested, run.published
    for i in ingested:
        log.info("%s: %d rows read, %d dropped", i.dataset, i.rows_read, i.rows_dropped)
    for p in published.values():
        log.info("%s: %d rows at %s", p.table, p.rows, p.location)
    log.info("%s finished", args.step)


if __name__ == "__main__":
    main()
