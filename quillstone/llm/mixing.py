"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source gets the same copy rate target / source size, at
most 2.  Its whole copies are certain; the fractional rest is a mass in words.
Two masses are paired and words move between them, in either direction with
the probabilities that keep both expectations, until one is empty or full;
the other one meets the next.  Documents are dealt to bounded buckets by a
hash of their id, every bucket leaves one undecided document, and those meet
in a reduction tree of fixed fan-in until one for each source is left.  What
that last one still holds is a whole number of words, so a source misses its
target by less than one word.

Defined results: null text has size 0 and is taken 0 times; null source is a
source of its own, the last; repeated rows are decided one by one; an empty
table gives an empty result; other columns of the input pass by.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialize

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
BUCKET_ROWS = 2_000
FAN_IN = 1_000
ALIKE = 10_000

_STATE = "source string, bucket long, row_key long, doc_id long, size long, mass double"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per source: source, source_size, n_docs, target; ``sizes`` has
    a row for ``rows`` documents (source, size, rows).

    Water filling: sources in the order of cap / weight; those before the
    level are at their cap, the others share what is left by weight."""
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.sum("rows").alias("n_docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", w).withColumn("cap", F.col("source_size") * F.lit(most)).withColumn("level", F.col("cap") / F.col("weight"))
    everything = Window.partitionBy()
    before = Window.orderBy("level", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    per = (
        per.withColumn("total", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("left_words", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("left_weight", F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("water", F.col("left_words") / F.col("left_weight"))
    )
    # The water rises over the capped sources and falls from the first uncapped one.
    target = F.least(F.col("cap"), F.col("weight") * F.max("water").over(everything))
    return per.select("source", "source_size", "n_docs", target.alias("target"))


def pivot(mass: np.ndarray, size: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, int]:
    """Sequential pivotal rounding of one bucket; the masses after it and the
    index of the one that may still be fractional (-1: none)."""
    m, s = mass.tolist(), size.tolist()
    held = -1
    for i, u in enumerate(draws.tolist()):
        if not 1e-9 < m[i] < s[i] - 1e-9:
            m[i] = 0.0 if m[i] <= 1e-9 else float(s[i])
            continue
        if held < 0:
            held = i
            continue
        a, b = m[held], m[i]
        up = min(s[held] - a, b)  # words that held can take
        down = min(a, s[i] - b)  # words that it can give
        if u * (up + down) < down:
            a, b = a + up, b - up
        else:
            a, b = a - down, b + down
        m[held], m[i] = a, b
        held_open, here_open = 1e-9 < a < s[held] - 1e-9, 1e-9 < b < s[i] - 1e-9
        if not held_open:
            m[held] = 0.0 if a <= 1e-9 else float(s[held])
        if not here_open:
            m[i] = 0.0 if b <= 1e-9 else float(s[i])
        held = held if held_open else i if here_open else -1
    return np.array(m), held


def _round(level: int, last: bool, seed: int):
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("row_key", "ascending"), ("doc_id", "ascending"), ("size", "ascending")])
        source, bucket = t["source"][0].as_py(), t["bucket"][0].as_py()
        name = "\0null" if source is None else source
        rng = np.random.default_rng(xxhash.xxh64_intdigest(f"{level}|{bucket}|{name}", seed))
        mass, held = pivot(t["mass"].to_numpy(), t["size"].to_numpy().astype(float), rng.random(len(t)))
        if last:
            mass = np.rint(mass)
        t = t.set_column(t.schema.get_field_index("mass"), "mass", pa.array(mass))
        return t.append_column("open", pa.array((np.arange(len(t)) == held) & (not last)))

    return run


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    """doc_id, source, size, source_size, target, taken, copies, partial:
    ``taken`` words are ``copies`` whole copies and ``partial`` words more."""
    sizes = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"))
    # Rows that look alike are counted and then numbered, so those of one id, or
    # of none, are dealt to many buckets as well.
    alike = materialize(sizes.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("rows")))
    targets = materialize(source_targets(alike, weights, share, most))
    parts = alike.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / ALIKE))))
    numbered = parts.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(ALIKE).cast("long"), F.col("rows") - F.col("part") * ALIKE))))
    d, t = numbered.alias("d"), targets.alias("t")
    rate = F.least(F.lit(float(most)), F.when(F.col("t.source_size") > 0, F.col("t.target") / F.col("t.source_size")).otherwise(0.0))
    rows = d.join(t, F.col("d.source").eqNullSafe(F.col("t.source"))).select(
        "d.doc_id", "d.source", "d.size", "t.source_size", "t.target", rate.alias("rate"),
        F.ceil(F.col("t.n_docs") / F.lit(BUCKET_ROWS)).alias("buckets"), F.xxhash64("d.doc_id", "d.part", "d.nth").alias("row_key"))
    whole = F.floor("rate")
    state = rows.select("source", F.pmod("row_key", "buckets").alias("bucket"), "row_key", "doc_id", "size", ((F.col("rate") - whole) * F.col("size")).alias("mass"))
    n = targets.agg(F.max("n_docs")).first()[0] or 0
    groups = math.ceil(n / BUCKET_ROWS)
    decided, level = None, 0
    while True:
        last = groups <= 1
        out = materialize(state.groupBy("source", "bucket").applyInArrow(_round(level, last, seed), _STATE + ", open boolean"))
        done = out.where(~F.col("open"))
        decided = done if decided is None else decided.unionByName(done)
        if last:
            break
        state = out.where("open").drop("open").withColumn("bucket", F.floor(F.col("bucket") / F.lit(FAN_IN)))
        groups, level = math.ceil(groups / FAN_IN), level + 1
    a = decided.alias("a")
    rate = F.least(F.lit(float(most)), F.when(F.col("t.source_size") > 0, F.col("t.target") / F.col("t.source_size")).otherwise(0.0))
    full = F.col("mass") >= F.col("size")
    extra = F.when((F.col("size") > 0) & full, 1).otherwise(0)
    out = a.join(t, F.col("a.source").eqNullSafe(F.col("t.source"))).select(
        "a.doc_id", "a.source", "a.size", "t.source_size", "t.target",
        (F.floor(rate) + extra).cast("long").alias("copies"),
        F.when(full, 0).otherwise(F.col("mass")).cast("long").alias("partial"))
    return out.withColumn("taken", F.col("copies") * F.col("size") + F.col("partial"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns
    of ``docs``.  Documents aren't cut: of the one partial copy that a source
    has at most, half a document or more counts as a copy."""
    plan = materialize(mix(docs, **options))
    copies = F.col("copies") + F.when((F.col("partial") > 0) & (2 * F.col("partial") >= F.col("size")), 1).otherwise(0)
    # The k-th row of a repeated id gets the id's k-th decision; the texts are
    # shuffled once, by id.
    made = F.struct("size", "taken", copies.cast("int").alias("copies"))
    made = plan.groupBy(F.col("doc_id").alias("_plan_id")).agg(F.sort_array(F.collect_list(made), asc=False).alias("_made"))
    own = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").cast("long").alias("_id"), word_count(F.col("text")).alias("_size"))
    # The plan grows with the documents, so it is never broadcast.
    rows = own.join(made.hint("merge"), F.col("_id").eqNullSafe(F.col("_plan_id")))
    rows = rows.withColumn("_k", F.row_number().over(Window.partitionBy("_id").orderBy(F.desc("_size")))) if _repeats(plan) else rows.withColumn("_k", F.lit(1))
    rows = rows.withColumn("_copies", F.element_at("_made", F.col("_k"))["copies"]).where("_copies > 0")
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return rows.select("_row.*")


def _repeats(plan: DataFrame) -> bool:
    return plan.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count() > 0
