"""Identity and content dedup, known sets, incremental listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key.  A partial aggregate, so a key with many rows
    costs one row for each task; ties are broken by the whole row."""
    cols = [c for c in rows.columns if c not in key]
    pick = F.min_by(F.struct(*cols), F.struct(F.struct(*order), F.struct(*cols))) if order else F.min(F.struct(*cols))
    return rows.groupBy(*key).agg(pick.alias("_r")).select(*key, "_r.*").select(*rows.columns)


def save_decisions(rows: DataFrame, ledger: DataFrame, seq: str = "seq") -> DataFrame:
    """``rows`` (doc_id, sha256 or null where nothing could be fetched, seq) with
    status 'exists', 'download_failed', 'duplicate_content' or 'saved', as if
    saved one by one in the order of seq.

    Identity comes first, content second among the survivors: a row that its
    doc_id turns away does not claim its content."""
    cols = rows.columns
    ids = ledger.select(F.col("doc_id").alias("_known_id")).distinct()
    hashes = ledger.where("sha256 is not null").select(F.col("sha256").alias("_known_sha")).distinct()
    r = rows.join(ids, F.col("doc_id") == F.col("_known_id"), "left")
    # A later row of an id counts as known only if an earlier one had a body.
    fetched = r.where("_known_id is null and sha256 is not null").groupBy("doc_id").agg(F.min(seq).alias("_first"))
    r = r.join(fetched, "doc_id", "left")
    known = F.col("_known_id").isNotNull() | (F.col(seq) > F.col("_first"))
    r = r.withColumn("_stage", F.when(F.coalesce(known, F.lit(False)), "exists").when(F.col("sha256").isNull(), "download_failed"))
    left = r.where("_stage is null").join(hashes, F.col("sha256") == F.col("_known_sha"), "left")
    claim = left.where("_known_sha is null").groupBy("sha256").agg(F.min(seq).alias("_claim"))
    left = left.join(claim, "sha256", "left")
    status = F.when(F.col("_known_sha").isNotNull() | (F.col(seq) > F.col("_claim")), "duplicate_content").otherwise("saved")
    return r.where("_stage is not null").select(*cols, F.col("_stage").alias("status")).unionByName(left.select(*cols, status.alias("status")))


def reindex_decisions(rows: DataFrame, ledger: DataFrame, dry_run: bool = False) -> DataFrame:
    """Rows (doc_id, file_exists, sha256) with the status of a reindex."""
    ids = ledger.select(F.col("doc_id").alias("_id")).distinct()
    hashes = ledger.where("sha256 is not null").select(F.col("sha256").alias("_sha")).distinct()
    r = rows.join(ids, F.col("doc_id") == F.col("_id"), "left").join(hashes, F.col("sha256") == F.col("_sha"), "left")
    status = F.when(F.col("_id").isNotNull(), "exists").when(~F.col("file_exists"), "missing_file").when(F.lit(dry_run), "dry_run").when(F.col("_sha").isNotNull(), "duplicate_content").otherwise("reindexed")
    return r.select(*rows.columns, status.alias("status"))


def content_dedup(rows: DataFrame, text: str, ident: str) -> DataFrame:
    """One row for each content, of the least id."""
    return first_by(rows.withColumn("_sha", F.sha2(F.col(text), 256)), ["_sha"], [ident]).drop("_sha")


def duplicate_groups(rows: DataFrame, text: str, ident: str) -> DataFrame:
    return rows.groupBy(F.sha2(F.col(text), 256).alias("sha256")).agg(F.count(F.lit(1)).alias("n"), F.min(ident).alias("first_id")).where("n > 1")


def known_urls(ledger: DataFrame) -> DataFrame:
    """url: every PDF and alternative URL of the ledger."""
    every = F.concat(F.array("pdf_url"), F.coalesce("alt_urls", F.array().cast("array<string>")))
    return ledger.select(F.explode(every).alias("url")).where("url is not null and url <> ''").distinct()


def known_sources(ledger: DataFrame) -> DataFrame:
    """source_url: a set of its own, never joined with the known URLs."""
    return ledger.select("source_url").where("coalesce(source_url, '') <> ''").distinct()


def unknown(rows: DataFrame, known: DataFrame, column: str, known_column: str) -> DataFrame:
    """Rows whose column is not among the known ones; a null is unknown."""
    k = known.select(F.col(known_column).alias("_known"))
    return rows.join(k, F.col(column) == F.col("_known"), "left_anti")


def since_until(rows: DataFrame, date: str, since: Column | None, until: Column | None, keep_undated: bool) -> DataFrame:
    """Rows in the range; undated rows by the source's rule."""
    inside = F.lit(True)
    if since is not None:
        inside = inside & (F.col(date) >= since)
    if until is not None:
        inside = inside & (F.col(date) <= until)
    return rows.where(F.coalesce(inside, F.lit(keep_undated)) & (F.col(date).isNotNull() | F.lit(keep_undated)))


def cap_per_group(rows: DataFrame, group: list[str], order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows of each group; Spark limits groups before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def incremental_listing(items: DataFrame, known: DataFrame, stop_on_known: bool = True, cap: int = 5_000) -> DataFrame:
    """Items (series, page, pos, url) that are unknown, up to the first page of
    a series without an unknown one; of each series ``cap`` items are
    considered, known ones included."""
    k = known.select(F.col("url").alias("_url")).distinct()
    marked = items.join(k, F.col("url") == F.col("_url"), "left").withColumn("new", F.col("_url").isNull())
    order = Window.partitionBy("series").orderBy("page", "pos")
    marked = marked.withColumn("nth", F.row_number().over(order))
    pages = marked.groupBy("series", "page").agg(F.bool_or("new").alias("any_new"))
    stop = pages.where(~F.col("any_new")).groupBy("series").agg(F.min("page").alias("stop_page"))
    out = marked.join(stop, "series", "left") if stop_on_known else marked.withColumn("stop_page", F.lit(None).cast("int"))
    keep = F.col("new") & (F.col("nth") <= cap) & F.coalesce(F.col("page") <= F.col("stop_page"), F.lit(True))
    return out.where(keep).select(*items.columns)


def first_working(rows: DataFrame, ident: str, urls: Column, working: DataFrame) -> DataFrame:
    """ident, url: the first of a row's URLs that is among the working ones."""
    each = rows.select(ident, F.posexplode(urls).alias("pos", "url"))
    return each.join(working.select("url").distinct(), "url", "left_semi").groupBy(ident).agg(F.min_by("url", "pos").alias("url"))


def status_counts(rows: DataFrame, status: str = "status") -> DataFrame:
    """Counts by the part of a status before its colon."""
    return rows.groupBy(F.split(status, ":")[0].alias("status")).agg(F.count(F.lit(1)).alias("n"))


def converge(step, max_rounds: int = 5, dry_run: bool = False) -> list[dict]:
    """Rounds of ``step() -> {'saved', 'errors', 'discovery_errors'}`` until one
    saves nothing and fails nowhere; a dry run is one round.  The counts of all
    rounds; the last are those of the run."""
    rounds = []
    for _ in range(1 if dry_run else max_rounds):
        rounds.append(step())
        if not any(rounds[-1].get(k) for k in ("saved", "errors", "discovery_errors")):
            break
    return rounds
