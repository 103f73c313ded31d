"""Coverage: expected against held, inventories, completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_counts(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("bank_code", "doc_type", F.coalesce("year", F.lit(0)).alias("year")).agg(F.count(F.lit(1)).cast("int").alias("downloaded"))


def status(expected: Column, got: Column) -> Column:
    """ok, partial, missing or unknown; more than zero of zero expected is partial."""
    return (
        F.when(expected.isNull(), F.when(got > 0, "ok").otherwise("unknown"))
        .when((expected > 0) & (got >= expected), "ok")
        .when(got == 0, F.when(expected > 0, "missing").otherwise("unknown"))
        .otherwise("partial")
    )


def completeness(ledger: DataFrame, grid: DataFrame, expected: DataFrame) -> DataFrame:
    """The matrix over ``grid`` (bank_code, doc_type, year): expected, downloaded,
    ratio (half to even, null if nothing is expected) and status."""
    out = grid.join(expected, ["bank_code", "doc_type"], "left").join(held_counts(ledger), ["bank_code", "doc_type", "year"], "left")
    got = F.coalesce("downloaded", F.lit(0))
    ratio = F.when(F.col("expected") > 0, F.bround(got / F.col("expected"), 2))
    return out.select("bank_code", "doc_type", "year", "expected", got.alias("downloaded"), ratio.alias("ratio"), status(F.col("expected"), got).alias("status"))


def grid(spark, banks: DataFrame, types: DataFrame, years: list[int]) -> DataFrame:
    """Every publisher, each of its supported types in scope, every year."""
    y = spark.createDataFrame([(v,) for v in years], "year int")
    return types.join(banks.select("bank_code"), "bank_code", "left_semi").select("bank_code", "doc_type").crossJoin(F.broadcast(y))


def summary(matrix: DataFrame) -> DataFrame:
    return matrix.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def crosstab(rows: DataFrame, by: str, across: str, values: list[str]) -> DataFrame:
    """Counts by a column, across the stated values of another, zero-filled."""
    return rows.groupBy(by).agg(*[F.count_if(F.col(across) == v).alias(v) for v in values], F.count(F.lit(1)).alias("total"))


def five_year_buckets(rows: DataFrame, year: str = "year") -> DataFrame:
    return rows.where(F.col(year).isNotNull()).groupBy((F.floor(F.col(year) / 5) * 5).cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def percent(part: Column, total: Column) -> Column:
    return F.when(total > 0, F.floor(100 * part / total)).cast("long")


def target_coverage(ledger: DataFrame, targets: DataFrame) -> DataFrame:
    held = ledger.where(F.col("doc_type").isin("D1", "D2")).groupBy("bank_code").agg(F.count(F.lit(1)).alias("held"))
    out = targets.join(held, "bank_code", "left").withColumn("held", F.coalesce("held", F.lit(0)))
    return out.withColumn("percent", percent(F.col("held"), F.col("target")))


def inventory(ledger: DataFrame) -> DataFrame:
    """part, name, n: totals by type, provenance and language, biggest first."""
    parts = [ledger.groupBy(F.col(c).alias("name")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(c).alias("part"), "name", "n") for c in ("doc_type", "provenance", "language")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).orderBy("part", F.desc("n"), "name")


def inventory_markdown(ledger: DataFrame, banks: DataFrame) -> str:
    """The inventory as Markdown; a page, made from aggregates only."""
    total = ledger.agg(F.count(F.lit(1)).alias("n"), F.min("year").alias("a"), F.max("year").alias("b")).first()
    lines = ["# Inventory", "", f"{total.n} documents, {total.a} to {total.b}", "", "| part | name | documents |", "|---|---|---|"]
    lines += [f"| {r.part} | {r.name} | {r.n} |" for r in inventory(ledger).collect()]
    empty = banks.join(ledger.select("bank_code").distinct(), "bank_code", "left_anti").orderBy("bank_code").collect()
    return "\n".join([*lines, "", "Without documents: " + ", ".join(r.bank_code for r in empty)]) + "\n"


def action_counts(rows: DataFrame, by: str, action: str, values: list[str]) -> DataFrame:
    """Counts of each action by a column, zero-filled, in one pass."""
    return rows.groupBy(by).agg(*[F.count_if(F.col(action) == v).alias(v) for v in values])


def catalogue_coverage(entries: DataFrame, as_of: Column) -> DataFrame:
    """By publisher: entries (bank, paper_id, tier, recovered) in all, covered,
    recovered by the page fetch, and missing ones, recent or legacy."""
    from quillstone.operators.matching import recent

    _, new = recent(F.col("paper_id"), as_of)
    gone = F.col("tier").isNull() & ~F.coalesce("recovered", F.lit(False))
    return entries.groupBy("bank").agg(
        F.count(F.lit(1)).alias("repec_total"),
        F.count_if(F.col("tier").isNotNull() | F.coalesce("recovered", F.lit(False))).alias("covered"),
        F.count_if(F.col("tier").isNull() & F.coalesce("recovered", F.lit(False))).alias("recovered_pagefetch"),
        F.count_if(gone & new).alias("missing_recent"),
        F.count_if(gone & ~new).alias("missing_legacy"))
