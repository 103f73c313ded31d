"""Retrieval side: chunks with inherited metadata, filters, citations, changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.functions.text import chunk_text


def documents(ledger: DataFrame, files: DataFrame) -> DataFrame:
    """Ledger rows whose PDF is among the stored files (path)."""
    return ledger.where(F.endswith("local_path", F.lit(".pdf"))).join(files.select(F.col("path").alias("local_path")).distinct(), "local_path", "left_semi")


def metadata(ledger: DataFrame, banks: DataFrame, types: DataFrame) -> DataFrame:
    b = banks.select("bank_code", F.col("name").alias("bank_name"), "country")
    t = types.select("doc_type", F.col("label").alias("type_label"))
    return ledger.join(b, "bank_code", "left").join(t, "doc_type", "left").select("doc_id", "bank_code", "bank_name", "country", "doc_type", "type_label", "title", "date", "year", "source_url", "pdf_url")


def chunked(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """All other columns, chunk_index, chunk_id (doc:index) and chunk."""
    keep = [c for c in docs.columns if c != text]
    out = docs.select(*keep, F.posexplode(chunk_text(F.col(text))).alias("chunk_index", "chunk"))
    return out.withColumn("chunk_id", F.concat_ws(":", F.col(ident).cast("string"), F.col("chunk_index").cast("string")))


def retrieve(chunks: DataFrame, equal: dict | None = None, among: dict | None = None, at_least: dict | None = None) -> DataFrame:
    """Metadata filters; they reach the scan."""
    for c, v in (equal or {}).items():
        chunks = chunks.where(F.col(c) == v)
    for c, v in (among or {}).items():
        chunks = chunks.where(F.col(c).isin(list(v)))
    for c, v in (at_least or {}).items():
        chunks = chunks.where(F.col(c) >= v)
    return chunks


def citation(bank_name: Column, title: Column, date: Column, url: Column) -> Column:
    return F.format_string("%s, %s, %s. Source: %s", bank_name, title, F.coalesce(F.date_format(date, "yyyy-MM-dd"), F.lit("undated")), url)


def changed(now: DataFrame, indexed: DataFrame) -> DataFrame:
    """Rows that are new or whose content is another than when indexed."""
    return now.join(indexed.select("doc_id", "sha256"), ["doc_id", "sha256"], "left_anti")
