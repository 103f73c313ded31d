"""Date recovery and the recovery of failed downloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstone.functions import dates, urls
from quillstone.operators import dedup

#: Fixed value: the first year of archive captures.
ARCHIVE_SINCE = 1997
ACTIONS = ("converged", "recoverable", "recovered", "duplicate", "unrecoverable")


def recover_dates(rows: DataFrame, index: DataFrame, captures: DataFrame, bodies: DataFrame, apply_only: bool = False) -> DataFrame:
    """doc_id, new_date, date_source, from_index of papers whose date is not of
    day precision.  A committed index entry of the row's key wins, as it is;
    else the PDF's creation date, else the first capture of the PDF or another
    URL, in order, where it lies in the asserted month.  Per key the first row
    in scan order (seq) that resolves wins; later ones of that key take its
    entry.  Rows without a key are never changed."""
    r = rows.where(F.col("doc_type").isin("D1", "D2") & (F.coalesce("date_precision", F.lit("")) != "day"))
    r = r.withColumn("key", urls.row_key(F.col("source_url"), F.col("repec_handle"), F.col("title_norm"))).where("key is not null")
    r = r.join(index.select("key", F.to_date("date").alias("_index_date"), F.col("date_source").alias("_index_source")), "key", "left")
    cols = ["doc_id", "key", "seq", "_index_date", "_index_source"]
    if apply_only:
        out = r.where("_index_date is not null").select("doc_id", F.col("_index_date").alias("new_date"), F.col("_index_source").alias("date_source"), F.lit(True).alias("from_index"))
        return out
    body = bodies.select("doc_id", dates.pdf_creation_date(F.col("body")).alias("_pdf"))
    r = r.join(body, "doc_id", "left")
    variants = r.select("doc_id", "date", F.posexplode(urls.url_variants(F.col("pdf_url"), F.col("alt_urls"))).alias("pos", "url")).where(F.year("date") >= ARCHIVE_SINCE)
    seen = variants.join(captures.groupBy(F.col("original").alias("url")).agg(F.min("stamp").alias("stamp")), "url").withColumn("_day", dates.stamp_date(F.col("stamp")))
    first = seen.where(dates.month_ok(F.col("_day"), F.col("date"))).groupBy("doc_id").agg(F.min_by("_day", "pos").alias("_archive"))
    r = r.join(first, "doc_id", "left")
    pdf = F.when(dates.month_ok(F.col("_pdf"), F.col("date")), F.col("_pdf"))
    r = r.withColumn("_found", F.coalesce(pdf, F.col("_archive"))).withColumn("_source", F.when(pdf.isNotNull(), "pdf_meta").when(F.col("_archive").isNotNull(), "wayback")).select(*cols, "_found", "_source")
    # The first row of a key that resolves makes the key's entry.
    w = Window.partitionBy("key").orderBy("seq")
    entry = F.first(F.when(F.col("_found").isNotNull(), F.struct("_found", "_source")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    r = r.withColumn("_entry", entry)
    mine = F.col("_index_date").isNull()
    return r.select("doc_id", F.coalesce("_index_date", "_entry._found").alias("new_date"), F.when(mine, F.col("_entry._source")).otherwise(F.col("_index_source")).alias("date_source"), (~mine).alias("from_index")).where("new_date is not null")


def converged(failures: DataFrame, ledger: DataFrame) -> DataFrame:
    """Failures (pdf_url, alt_urls, source_url, ...) with ``converged``: the
    ledger knows the PDF, one of the other URLs, or the source by now."""
    known = dedup.known_urls(ledger)
    every = F.concat(F.array("pdf_url"), F.coalesce("alt_urls", F.array().cast("array<string>")))
    by_url = failures.select(F.col("pdf_url").alias("_p"), F.explode(every).alias("url")).join(known, "url", "left_semi").select("_p").distinct()
    sources = dedup.known_sources(ledger).select(F.col("source_url").alias("_s"))
    r = failures.join(by_url, F.col("pdf_url") == F.col("_p"), "left").join(sources, F.col("source_url") == F.col("_s"), "left")
    return r.select(*failures.columns, (F.col("_p").isNotNull() | F.col("_s").isNotNull()).alias("converged"))


def classify_failures(failures: DataFrame, ledger: DataFrame, captures: DataFrame, fresh: DataFrame, outcomes: DataFrame | None = None) -> DataFrame:
    """Failures with action, snapshot_ts and snapshot_url.  ``fresh`` (pdf_url,
    candidates) holds what the source page offers now; ``outcomes`` (pdf_url,
    status) the results of the downloads tried."""
    r = converged(failures, ledger).join(fresh.select("pdf_url", "candidates"), "pdf_url", "left")
    none = F.array().cast("array<string>")
    tried = F.concat(F.array("pdf_url"), F.array_distinct(F.concat(F.coalesce("candidates", none), F.coalesce("alt_urls", none))))
    each = r.where(~F.col("converged")).select(F.col("pdf_url").alias("_p"), F.posexplode(tried).alias("pos", "url")).where("coalesce(url, '') <> ''")
    latest = captures.groupBy(F.col("original").alias("url")).agg(F.max("stamp").alias("stamp"))
    snap = each.join(latest, "url").groupBy("_p").agg(F.min_by(F.struct("stamp", "url"), "pos").alias("snap"))
    r = r.join(snap, F.col("pdf_url") == F.col("_p"), "left")
    action = F.when(F.col("converged"), "converged").when(F.col("snap").isNull(), "unrecoverable").otherwise("recoverable")
    r = r.withColumn("action", action)
    if outcomes is not None:
        r = r.join(outcomes.select("pdf_url", F.col("status").alias("_o")), "pdf_url", "left")
        turned = F.when(F.col("_o") == "saved", "recovered").when(F.col("_o").isin("duplicate_content", "exists"), "duplicate")
        r = r.withColumn("action", F.when(F.col("action") == "recoverable", F.coalesce(turned, F.col("action"))).otherwise(F.col("action")))
    return r.select(*failures.columns, "action", F.col("snap.stamp").alias("snapshot_ts"), F.when(F.col("snap").isNotNull(), urls.archive_url(F.col("snap.stamp"), F.col("snap.url"))).alias("snapshot_url"))
