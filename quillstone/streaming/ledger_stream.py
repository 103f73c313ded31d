"""Structured Streaming: page snapshots to candidates, first-wins saving,
latest failures, windowed audit counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone import schema
from quillstone.functions import urls
from quillstone.operators import dedup
from quillstone.sources import html


def snapshots(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema.PAGES).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def candidates(pages: DataFrame, layout: html.Layout) -> DataFrame:
    """link_url, date, title of new pages, each URL once over the stream's life;
    the state grows with the corpus' identities only."""
    ok = pages.where("status = 200").select("url", urls.page_text(F.col("body")).alias("html"))
    links = html.page_links(ok).where(F.col("href").rlike(f"(?i){layout.pattern}"))
    return links.select("link_url", "text").dropDuplicates(["link_url"])


def save_stream(rows: DataFrame, ledger_path: str, checkpoint: str):
    """Rows with doc_id, sha256, seq to the ledger, first wins on both keys; a
    batch that is run again finds its own rows and saves nothing twice."""

    def save(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        try:
            held = spark.read.parquet(ledger_path)
        except Exception as e:  # the first batch: there is no ledger yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            held = batch.limit(0)
        new = dedup.save_decisions(batch, held).where("status = 'saved'").drop("status")
        new.write.mode("append").parquet(ledger_path)

    return rows.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_failures(rows: DataFrame) -> DataFrame:
    """The latest failure of each URL (complete output mode)."""
    return rows.groupBy("pdf_url").agg(F.max_by(F.struct("ts", "error"), "ts").alias("last")).select("pdf_url", "last.*")


def audit_windows(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts by window and type, with a watermark for late rows."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), "event_type", "n")
