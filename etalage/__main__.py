"""``spark-submit`` or ``python -m etalage``: the daily run, or one stage of it, from CSV files into a warehouse."""

from __future__ import annotations

import argparse
import sys
from functools import partial

from pyspark.sql import SparkSession

from etalage import contracts as K
from etalage.plans.daily import ArrivalOrder
from etalage.plans.stages import STAGES, FailedLoad, MissingStage, StagedRun
from etalage.sources.extraction import FailedExtraction
from etalage.sources.files import read_csv_contract


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """0, or 1 where a source or a load failed, or a stage lacks one that it reads."""
    options = _parser().parse_args(arguments)
    spark = spark or SparkSession.builder.appName(f"etalage {options.run_id}").getOrCreate()
    order = ArrivalOrder(options.client_order.split(","), options.transaction_order.split(","))
    run = StagedRun(spark, options.root, options.run_id, options.as_of, order, options.min, options.max, options.pause)
    stages = None if options.stage == "all" else [options.stage]
    sources = {name: partial(read_csv_contract, spark, f"{options.raw}/{name}.csv", contract)
               for name, contract in K.CSV_CONTRACTS.items()}
    try:
        # A stage that is asked for by name is done again; "all" goes on after the last complete one.
        summary = run.run(sources, stages, again=options.again or stages is not None)
    except (FailedExtraction, FailedLoad, MissingStage) as error:
        print(f"{type(error).__name__}: {error}", file=sys.stderr)
        return 1
    for r in summary.orderBy("etape", "nom_table").collect():  # one row per table
        print(f"{r['etape']:<10} {r['nom_table']:<24} {r['nb_lignes']:>14,} {r['statut'] or ''}")
    return 0


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="etalage", description=__doc__)
    parser.add_argument("--stage", choices=["all", *STAGES], default="all")
    parser.add_argument("--raw", required=True, help="folder with clients.csv, transactions.csv, produits.csv, magasins.csv")
    parser.add_argument("--root", required=True, help="folder of the warehouse")
    parser.add_argument("--run-id", required=True, help="name of the run; the same name goes on with it")
    parser.add_argument("--as-of", required=True, help="day of the run, yyyy-mm-dd")
    parser.add_argument("--min", type=float, default=K.AMOUNT_MIN, help="least amount accepted")
    parser.add_argument("--max", type=float, default=K.AMOUNT_MAX, help="greatest amount accepted")
    parser.add_argument("--client-order", default="date_inscription", help="columns that say which row of a client is last")
    parser.add_argument("--transaction-order", default="date_transaction,produit_id,magasin_id,montant_total_xaf,quantite",
                        help="columns that say which row of a transaction is last")
    parser.add_argument("--pause", type=float, default=K.EXTRACTION_PAUSE_SECONDS,
                        help="seconds before a source that failed is read again")
    parser.add_argument("--again", action="store_true", help="do complete stages again")
    return parser


if __name__ == "__main__":
    sys.exit(main())
