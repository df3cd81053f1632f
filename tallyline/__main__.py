"""Run the daily billing job: ``python -m tallyline --help``.

Inputs come either from a folder holding one parquet dataset per domain
table (``leads``, ``terms_sheet``, ``invoice``, ``invoice_line``, ``receipt``,
``receipt_line``, ``partner``, ``contract``, ``organization``, ``individual``,
``deposit_correction``, ``pm_correction``) with rules from a JSON file, or
from the driver's test tables (``--driver-data``, synthetic rules).
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import sys


def _rules_from_json(path: str):
    from .rules import RuleSet, SplitRule

    with open(path, encoding="utf-8") as f:
        raw = json.load(f)
    splits = tuple(SplitRule(**r) for r in raw.pop("split_rules", []))

    def tup(v):
        return tuple(tup(x) for x in v) if isinstance(v, list) else v

    return RuleSet(split_rules=splits, **{k: tup(v) for k, v in raw.items()})


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="tallyline", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--input-dir", help="folder with one parquet dataset per domain table")
    src.add_argument("--landing", help="JSON list of landed entity sets (see plans/ingest.py); loaded into --database, then reported from there")
    src.add_argument("--driver-data", help="driver test tables folder, e.g. /root/testdata/sf0.01")
    ap.add_argument("--sheet", help="CSV file or folder of the payment-terms sheet (with --landing)")
    ap.add_argument("--rules", help="RuleSet as JSON (with --input-dir or --landing)")
    ap.add_argument("--as-of", default=_dt.date.today().isoformat(), help="run date (YYYY-MM-DD)")
    ap.add_argument("--run-ts", default=None, help="run timestamp for alert gating (YYYY-MM-DDTHH:MM:SS)")
    ap.add_argument("--database", default="tallyline", help="catalog database to write the tables into")
    ap.add_argument("--audit-log", default=None, help="path for the JSON-lines invoice log")
    ap.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    a = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from .plans.pipeline import INPUT_TABLES, Inputs, driver_inputs
    from .plans.run import run_daily
    from .rules import RuleSet
    from .session import ensure_checkpoint_dir
    from .sources import driver

    b = SparkSession.builder.appName("tallyline-daily")
    if a.master:
        b = b.master(a.master)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    as_of = _dt.date.fromisoformat(a.as_of)
    run_ts = _dt.datetime.fromisoformat(a.run_ts) if a.run_ts else _dt.datetime.now()
    if a.driver_data:
        rules = driver.driver_rules()
        inputs = driver_inputs(spark, a.driver_data, rules)
    elif a.landing:
        from .plans.ingest import ingest_all, landings_from_json, table_inputs

        rules = _rules_from_json(a.rules) if a.rules else RuleSet()
        with open(a.landing, encoding="utf-8") as f:
            ingest_all(spark, landings_from_json(f.read()), a.database, a.sheet)
        inputs = table_inputs(spark, a.database)
    else:
        rules = _rules_from_json(a.rules) if a.rules else RuleSet()
        inputs = Inputs({t: (lambda t=t: spark.read.parquet(f"{a.input_dir}/{t}")) for t in INPUT_TABLES})
    written = run_daily(spark, inputs, rules, as_of, run_ts, a.database, a.audit_log)
    print(json.dumps(written, ensure_ascii=False))
    return 0


if __name__ == "__main__":
    sys.exit(main())
