"""Commands over a ledger folder; what they print are small aggregates.

python -m quillstone.cli list-banks
python -m quillstone.cli report LEDGER --years 2015-2025 [--types A1,F1] [--banks us,ecb] [--csv DIR]
python -m quillstone.cli inventory LEDGER
python -m quillstone.cli validate LEDGER
python -m quillstone.cli reindex LEDGER RAW
python -m quillstone.cli recover LEDGER FAILURES CAPTURES
python -m quillstone.cli dates LEDGER INDEX
python -m quillstone.cli chunk DOCUMENTS OUT
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quillstone import dims, schema
from quillstone.functions import text
from quillstone.operators import coverage, discovery, rag, recovery
from quillstone.session import ship
from quillstone.sources import ledger


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quillstone", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = p.add_subparsers(dest="command", required=True)
    commands.add_parser("list-banks")
    report = commands.add_parser("report")
    report.add_argument("ledger")
    report.add_argument("--years", type=discovery.parse_years, required=True)
    report.add_argument("--types")
    report.add_argument("--banks")
    report.add_argument("--csv")
    for name, places in {"inventory": ["ledger"], "validate": ["ledger"], "reindex": ["ledger", "raw"], "recover": ["ledger", "failures", "captures"], "dates": ["ledger", "index"], "chunk": ["documents", "out"]}.items():
        c = commands.add_parser(name)
        for x in places:
            c.add_argument(x)
    return p


def run(spark: SparkSession, argv: list[str]) -> int:
    a = _parser().parse_args(argv)
    ship(spark)
    if a.command == "list-banks":
        dims.banks(spark).orderBy("bank_code").show(100, truncate=False)
    elif a.command == "report":
        scope = discovery.parse_scope(a.types, [r.doc_type for r in dims.doc_types(spark).collect()])
        banks = dims.banks(spark)
        banks = banks.where(F.col("bank_code").isin(a.banks.split(","))) if a.banks else banks
        types = dims.supported_types(spark).where(F.col("doc_type").isin(scope))
        held = ledger.read_ledger(spark, a.ledger, a.banks.split(",") if a.banks else None)
        matrix = coverage.completeness(held, coverage.grid(spark, banks, types, a.years), dims.expected(spark))
        if a.csv:
            ledger.write_report(matrix, a.csv, ["bank_code", "doc_type", "year"])
        coverage.summary(matrix).orderBy("status").show()
    elif a.command == "inventory":
        print(coverage.inventory_markdown(ledger.read_ledger(spark, a.ledger), dims.banks(spark)))
    elif a.command == "validate":
        torn = ledger.require_whole(spark, a.ledger).collect()
        for r in torn:
            print(f"{r.file}:{r.line}: torn at byte {r.offset}")
        return int(bool(torn))
    elif a.command == "reindex":
        held = ledger.read_ledger(spark, a.ledger)
        lacking = ledger.stored_files(spark, a.raw).join(held.select("doc_id"), "doc_id", "left_anti").orderBy("path")
        n = 0
        for r in lacking.toLocalIterator():
            print(r.doc_id, r.path)
            n += 1
        print(f"{n} stored files that the ledger lacks")
    elif a.command == "recover":
        failures = spark.read.schema(schema.FAILURES).json(a.failures).withColumn("pos", F.monotonically_increasing_id())
        captures = spark.read.schema("original string, stamp string").json(a.captures)
        rows = ledger.inventory(failures)
        fresh = rows.select("pdf_url", F.lit(None).cast("array<string>").alias("candidates"))
        out = recovery.classify_failures(rows, ledger.read_ledger(spark, a.ledger), captures, fresh)
        coverage.action_counts(out, "bank_code", "action", list(recovery.ACTIONS)).orderBy("bank_code").show(100)
    elif a.command == "dates":
        held = text.on_distinct(ledger.read_ledger(spark, a.ledger), "title", text.normalize_title, "title_norm").withColumn("seq", F.monotonically_increasing_id())
        index = ledger.last_lines(spark.read.schema(schema.DATE_INDEX).json(a.index).withColumn("pos", F.monotonically_increasing_id()), "key", "pos")
        none = spark.createDataFrame([], "original string, stamp string, doc_id string, body binary")
        found = recovery.recover_dates(held, index, none, none, apply_only=True)
        found.groupBy("date_source").agg(F.count(F.lit(1)).alias("n")).orderBy("date_source").show()
    elif a.command == "chunk":
        rag.chunked(spark.read.parquet(a.documents)).write.mode("errorifexists").parquet(a.out)
    return 0


def main() -> int:
    import sys

    spark = SparkSession.builder.appName("quillstone").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    return run(spark, sys.argv[1:])


if __name__ == "__main__":
    raise SystemExit(main())

