"""Command line: ``spark-submit -m marlstone <layer> ...`` or ``python -m marlstone <layer> ...``."""

from __future__ import annotations

import argparse
import sys
from datetime import date, datetime, timezone

from marlstone.entities import ENTITIES
from marlstone.plans.bronze_job import run_bronze
from marlstone.plans.documents_job import flatten_documents, report_documents
from marlstone.plans.gold_job import AGGREGATES, run_gold
from marlstone.plans.outcomes import exit_status, run_each
from marlstone.plans.session import build_session
from marlstone.plans.silver_job import run_silver
from marlstone.plans.silver_update import run_updates
from marlstone.plans.warehouse import build_warehouse, check_warehouse, require_checks


def _month(text: str) -> tuple[int, int]:
    first = date.fromisoformat(f"{text}-01")
    return first.year, first.month


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="marlstone", description=__doc__)
    top.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE", help="Spark setting")
    layers = top.add_subparsers(dest="layer", required=True)

    bronze = layers.add_parser("bronze", help="raw JSON to validated Parquet")
    bronze.add_argument("--source-base", required=True, help="folder or object-store prefix of the raw files")
    bronze.add_argument("--bronze-base", required=True)
    bronze.add_argument("--entities", nargs="+", choices=list(ENTITIES))
    bronze.add_argument("--batch-id", help="give one to replay a batch; random by default")
    bronze.add_argument("--layout", choices=["lines", "document"], default="lines")
    bronze.add_argument("--as-of", type=date.fromisoformat, help="reference day of the late flag")

    silver = layers.add_parser("silver", help="bronze batches to clean tables")
    silver.add_argument("--bronze-base", required=True)
    silver.add_argument("--silver-base", required=True)
    silver.add_argument("--entities", nargs="+", choices=list(ENTITIES))
    silver.add_argument("--null-threshold", type=float, help="one limit, in percent, for all columns")
    silver.add_argument("--run-id", help="repeating a finished run changes nothing")
    silver.add_argument("--incremental", action="store_true", help="read only new batches and rewrite only what they change")

    gold = layers.add_parser("gold", help="silver tables to aggregates")
    gold.add_argument("--silver-base", required=True)
    gold.add_argument("--gold-base", required=True)
    gold.add_argument("--csv-dir")
    gold.add_argument("--aggregates", nargs="+", choices=list(AGGREGATES))
    gold.add_argument("--as-of", type=date.fromisoformat)
    gold.add_argument(
        "--months", nargs=2, type=_month, metavar="YYYY-MM", help="refresh only the months from the first to the second"
    )

    gold.add_argument("--incremental", action="store_true", help="replace only the months that incremental silver runs changed")

    warehouse = layers.add_parser("warehouse", help="sample CSV files to marts")
    warehouse.add_argument("--samples-path", required=True)
    warehouse.add_argument("--warehouse", required=True)
    warehouse.add_argument("--batch-id", required=True)
    warehouse.add_argument("--as-of", type=date.fromisoformat)
    warehouse.add_argument("--no-checks", action="store_true", help="build the models without checking them")

    documents = layers.add_parser("documents", help="nested order documents to two reports")
    documents.add_argument("--source-base", required=True)
    documents.add_argument("--silver-base", required=True)
    documents.add_argument("--gold-base", required=True)
    documents.add_argument("--layout", choices=["lines", "document"], default="lines")
    return top


def main(arguments: list[str] | None = None) -> int:
    args = parser().parse_args(arguments)
    spark = build_session(f"marlstone-{args.layer}", dict(c.split("=", 1) for c in args.conf))
    if args.layer == "bronze":
        outcomes = run_bronze(
            spark,
            args.source_base,
            args.bronze_base,
            args.entities,
            args.batch_id,
            layout=args.layout,
            as_of=args.as_of,
        )
    elif args.layer == "silver" and args.incremental:
        outcomes = run_updates(spark, args.bronze_base, args.silver_base, args.entities, args.null_threshold)
    elif args.layer == "silver":
        outcomes = run_silver(
            spark, args.bronze_base, args.silver_base, args.entities, args.null_threshold, run_id=args.run_id
        )
    elif args.layer == "gold":
        outcomes = run_gold(
            spark,
            args.silver_base,
            args.gold_base,
            args.csv_dir,
            args.aggregates,
            incremental=args.incremental,
            as_of=args.as_of,
            months=args.months,
        )
    elif args.layer == "warehouse":
        at = datetime.now(timezone.utc)
        models: dict = {}

        def build(_: str) -> list[str]:
            models.update(build_warehouse(spark, args.samples_path, args.warehouse, args.batch_id, at, args.as_of))
            return sorted(models)

        outcomes = run_each(["warehouse"], build)
        if models and not args.no_checks:
            outcomes += run_each(["checks"], lambda _: require_checks(check_warehouse(models, args.warehouse, args.batch_id)))
    else:
        steps = {
            "flatten": lambda: flatten_documents(spark, args.source_base, args.silver_base, args.layout),
            "report": lambda: report_documents(spark, args.silver_base, args.gold_base),
        }
        outcomes = run_each(steps, lambda step: sorted(steps[step]()))
    for outcome in outcomes:
        print(f"{outcome.name}: {'ok' if outcome.ok else 'FAILED'} {outcome.detail}")
    return exit_status(outcomes)


if __name__ == "__main__":
    sys.exit(main())
