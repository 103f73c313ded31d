"""The ledger on disk: JSON lines by publisher, checked, read and rewritten."""

from __future__ import annotations

import json
import os
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone import schema


_BROKEN = "_broken_line"


class TornMiddle(ValueError):
    """A broken line that is not the last of its file."""


def read_ledger(spark: SparkSession, path: str, banks: list[str] | None = None) -> DataFrame:
    """Rows of ``path``: one file <bank>.jsonl for each publisher, or folders
    bank_code=<bank>.  A last line that a crash has torn is left out; any other
    broken line raises TornMiddle, which names its file and number.  With
    ``banks`` only their files are read."""
    flat = not any("/bank_code=" in f for f in spark.read.text(path).inputFiles())
    reader = spark.read.schema(f"{schema.LEDGER}, {_BROKEN} string").option("columnNameOfCorruptRecord", _BROKEN)
    if banks and flat:
        reader = reader.option("pathGlobFilter", "{" + ",".join(banks) + "}.json*")
    rows = reader.json(path)
    rows = rows.where(F.col("bank_code").isin(banks)) if banks and not flat else rows
    broken = rows.select("*", F.col("_metadata.file_path").alias("_file")).where(F.col(_BROKEN).isNotNull())
    # Spark reads no broken line without another column beside it.
    for r in broken.groupBy("_file").agg(F.max("doc_id")).toLocalIterator():
        require_whole(spark, r["_file"])
    rows = rows.where(F.col(_BROKEN).isNull()).drop(_BROKEN)
    return rows.where(F.col("bank_code").isin(banks)) if banks else rows


def check_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line, offset, problem ('torn' or 'broken') of every line that is no
    JSON object or no UTF-8.  A last line may be torn by a crash; any other is
    damage.  Files are read whole, a publisher's is small."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.decode("content", "ISO-8859-1").alias("text"))
    lines = files.select("file", F.posexplode(F.split("text", "\n")).alias("pos", "raw"), "text")
    size = F.length("raw") + 1
    from pyspark.sql import Window

    w = Window.partitionBy("file").orderBy("pos")
    lines = lines.drop("text").withColumn("offset", F.sum(size).over(w) - size).where(F.trim("raw") != "")
    # One character stands for one byte here; encode back to see the real text.
    text = F.expr("try_validate_utf8(decode(encode(raw, 'ISO-8859-1'), 'UTF-8'))")
    bad = F.expr("is_valid_utf8(cast(encode(raw, 'ISO-8859-1') as string))")
    ok = F.coalesce(bad & F.try_parse_json(text).isNotNull() & F.startswith(F.trim("raw"), F.lit("{")), F.lit(False))
    lines = lines.withColumn("last", F.max("pos").over(Window.partitionBy("file")))
    return lines.where(~ok).select("file", (F.col("pos") + 1).alias("line"), "offset", F.when(F.col("pos") == F.col("last"), "torn").otherwise("broken").alias("problem"), F.col("raw").alias("fragment"))


def require_whole(spark: SparkSession, path: str) -> DataFrame:
    """The torn last lines; a broken line elsewhere is an error that names it."""
    problems = check_lines(spark, path)
    worst = problems.where("problem = 'broken'").orderBy("file", "line").first()
    if worst:
        raise TornMiddle(f"{worst['file']}:{worst['line']}")
    return problems


def repair_torn_tail(file: str, offset: int) -> str:
    """Maintenance on a local file, never part of a query: the torn last line
    goes to <file>.torn and the file ends before it.  Returns the fragment."""
    import fcntl

    with open(file, "r+b") as f:
        fcntl.flock(f, fcntl.LOCK_EX)
        f.seek(offset)
        fragment = f.read()
        try:
            json.loads(fragment)
            return ""  # another process has completed it
        except ValueError:
            pass
        with open(f"{file}.torn", "ab") as t:
            t.write(fragment.rstrip(b"\n") + b"\n")
        f.truncate(offset)
    return fragment.decode("utf-8", "replace")


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").partitionBy("bank_code").json(path)


def append_audit(rows: DataFrame, path: str) -> None:
    """Audit lines, of discovery or of downloads, as they are; files are only
    added, and ``last_lines`` or ``inventory`` reads the latest of a key."""
    rows.write.mode("append").json(path)


def split_legacy(spark: SparkSession, file: str, root: str) -> int:
    """One file of all publishers to a folder for each, every line as it was, in
    its order; the number of publishers.  A broken line stops it (but for a
    torn last one, which goes with the unknown), an existing folder too."""
    require_whole(spark, file)
    lines = spark.read.text(file).where(F.trim("value") != "").withColumn("_pos", F.monotonically_increasing_id())
    bank = F.coalesce(F.nullif(F.get_json_object("value", "$.bank_code"), F.lit("")), F.lit("_unknown"))
    lines = lines.withColumn("bank_code", bank).repartition("bank_code").sortWithinPartitions("bank_code", "_pos")
    lines.select("value", "bank_code").write.mode("errorifexists").partitionBy("bank_code").text(root)
    return spark.read.text(root).select("bank_code").distinct().count()


def save_artefacts(rows: DataFrame, root: str) -> DataFrame:
    """path, size of the bodies (path, body) written below ``root``, a folder
    that all executors mount.  A file is complete or absent, and is the same
    when a task runs again."""

    def run(batches):
        for b in batches:
            names, sizes = b.column(0).to_pylist(), []
            for path, body in zip(names, b.column(1).to_pylist()):
                full = os.path.join(root, path)
                os.makedirs(os.path.dirname(full), exist_ok=True)
                part = f"{full}.{uuid.uuid4().hex}.part"
                with open(part, "wb") as f:
                    f.write(body or b"")
                os.replace(part, full)
                sizes.append(len(body or b""))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], names=["path", "size"])

    return rows.select("path", "body").mapInArrow(run, "path string, size long")


class LostRows(AssertionError):
    """A rewrite would not keep the ledger's documents."""


def assert_same_documents(before: DataFrame, after: DataFrame) -> None:
    """Rails of a metadata rewrite: as many rows, the same doc_ids."""
    a, b = before.count(), after.count()
    changed = before.select("doc_id").exceptAll(after.select("doc_id")).limit(1).count()
    if a != b or changed:
        raise LostRows(f"{a} rows before, {b} after" + ", other documents" * bool(changed))


def rewrite(rows: DataFrame, root: str, rails: DataFrame | None = None) -> str:
    """Writes a new version below ``root`` and then swaps the pointer file
    CURRENT; the version being read is never overwritten.  Local or mounted
    paths; returns the version's path."""
    version = f"v-{uuid.uuid4().hex[:12]}"
    out = os.path.join(root, version)
    rows.write.partitionBy("bank_code").json(out)
    if rails is not None:
        assert_same_documents(rails, rows.sparkSession.read.schema(schema.LEDGER).json(out))
    pointer = os.path.join(root, "CURRENT")
    with open(pointer + ".new", "w") as f:
        f.write(version)
    os.replace(pointer + ".new", pointer)
    return out


def current(spark: SparkSession, root: str) -> DataFrame:
    with open(os.path.join(root, "CURRENT")) as f:
        return spark.read.schema(schema.LEDGER).json(os.path.join(root, f.read().strip()))


def write_report(rows: DataFrame, path: str, order: list[str]) -> None:
    """A CSV report as one file, in a stated order; reports are small."""
    rows.orderBy(*order).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """A CSV that people have edited: all strings, blanks kept, BOM dropped,
    with ``line``, the order of its rows."""
    rows = spark.read.option("header", True).option("nullValue", "\0").option("emptyValue", "").csv(path)
    return rows.withColumn("line", F.monotonically_increasing_id())


def last_lines(rows: DataFrame, key: str, pos: str) -> DataFrame:
    """For each key its last line; files that are appended to hold many."""
    cols = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*cols), pos).alias("_r")).select(key, "_r.*")


def inventory(rows: DataFrame, pos: str = "pos") -> DataFrame:
    """Download failures, one for each pdf_url: the last entry, at the place of
    the first."""
    cols = [c for c in rows.columns if c not in ("pdf_url", pos)]
    return rows.groupBy("pdf_url").agg(F.min(pos).alias(pos), F.max_by(F.struct(*cols), pos).alias("_r")).select("pdf_url", pos, "_r.*")


def stored_files(spark: SparkSession, root: str) -> DataFrame:
    """bank_code, doc_type, year, doc_id, path of raw/<bank>/<type>/<year>/<id>.pdf."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", True).load(root).select("path")
    part = lambda k: F.element_at(F.split("path", "/"), k)
    return files.select(part(-4).alias("bank_code"), part(-3).alias("doc_type"), part(-2).cast("int").alias("year"), F.regexp_replace(part(-1), r"\.pdf$", "").alias("doc_id"), "path")
