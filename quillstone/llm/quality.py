"""Quality classifier: a sparse rule ensemble.

Shallow boosted trees over text statistics give the rules, one for each path
from a root to a node; lasso logistic regression weighs them and drops most;
what is left becomes one Spark column expression over the statistics, so
scoring is plain SQL.  The statistics are those of whole texts; labels, lang,
source and doc_id are never among them.

The fit sees at most ``TRAIN_ROWS`` labelled rows, those of least
xxhash64(doc_id), and never rows whose crc32(doc_id as text) mod 4 is 2.

Defined results: null and empty texts have statistics of 0 and a score like
any other; a null doc_id is not held out and has no label; repeated rows are
scored one by one; without labelled rows of both classes every score is the
share of label 1, 0.5 if there are none; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, others

TRAIN_ROWS = 20_000
THRESHOLD = 0.7
STATISTICS = (
    "n_words", "word_len", "distinct_words", "top_word", "repeat_next", "top_pair", "upper", "digit", "symbol", "stop", "space", "non_ascii",
    "marked_words", "upper_words", "punct_words", "doubled_marks", "line_len", "repeat_lines", "short_lines", "long_words",
)
_CLASS = np.zeros(256, np.int64)
for _name, _k in ((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), (b"0123456789", 2), (b"#$%&*+/<=>@[\\]^_`{|}~", 3), (b"!\"'(),-.:;?", 4), (b" \t\n\r\x0b\x0c", 5)):
    _CLASS[list(_name)] = _k
_CLASS[128:] = 6
_MARKS = frozenset(b"#$%&*+/<=>@[\\]^_`{|}~!?")


def statistics(text: bytes) -> list[float]:
    """Figures of one text, in the order of STATISTICS."""
    n = len(text)
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    kinds = np.zeros(7)
    for lo in range(0, n, 1 << 20):
        kinds += np.bincount(_CLASS[np.frombuffer(text, np.uint8, min(1 << 20, n - lo), lo)], minlength=7)
    counts = Counter(words)
    w = len(words)
    pairs = Counter(zip(words, words[1:]))
    marked = sum(c for x, c in counts.items() if x[-1] in _MARKS or x[0] in _MARKS)
    doubled = sum(c for x, c in counts.items() if len(x) > 2 and x[-1] == x[-2] and x[-1] in _MARKS)
    upper = sum(c for x, c in counts.items() if len(x) > 1 and x.isupper())
    punct = sum(c for x, c in counts.items() if x[-1] in b".,;:!?")
    long_words = sum(c for x, c in counts.items() if len(x) > 18)
    lines = [x for x in text.split(b"\n") if x.strip()]
    line_counts = Counter(lines)
    return [
        math.log1p(w), sum(len(x) * c for x, c in counts.items()) / w, len(counts) / w, max(counts.values()) / w,
        sum(c for (a, b), c in pairs.items() if a == b) / w, max(pairs.values()) / w if pairs else 0.0,
        *(float(kinds[k]) / n for k in (1, 2, 3, 4, 5, 6)),
        marked / w, upper / w, punct / w, doubled / w, math.log1p(n / len(lines)), 1 - len(line_counts) / len(lines),
        sum(c for x, c in line_counts.items() if len(x) < 20) / len(lines), long_words / w,
    ]


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """All other columns and one double for each of STATISTICS."""
    keep = others(df, text, *STATISTICS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = column(b, "_text")
            rows = [statistics(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in col]
            made = np.array(rows, float).reshape(len(rows), len(STATISTICS))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *(pa.array(made[:, k]) for k in range(made.shape[1]))], names=[*(f"k{k}" for k in range(len(keep))), *STATISTICS])

    given = df.select(*[F.col(c).alias(f"k{k}") for k, c in enumerate(keep)], F.col(text).alias("_text"))
    schema = given.drop("_text").schema
    for name in STATISTICS:
        schema = schema.add(name, "double")
    return given.mapInArrow(run, schema).toDF(*keep, *STATISTICS)


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, above, threshold)


def grow_rules(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, rate: float = 0.3, bins: int = 32, seed: int = 7) -> list[Rule]:
    """Paths of boosted logistic trees, each root-to-node path once."""
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(x.shape[1])]
    cuts = [c[(c >= x[:, k].min()) & (c < x[:, k].max())] for k, c in enumerate(cuts)]
    code = np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(cuts)], 1)
    raw, rules = np.full(len(y), math.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))), {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        used = rng.random(len(y)) < 0.6
        level = [((), np.arange(len(y)))]
        for d in range(depth + 1):
            after = []
            for path, rows in level:
                own = rows[used[rows]]
                best = None
                if d < depth and len(own) >= 40:
                    total_g, total_h = g[own].sum(), h[own].sum() + 1e-3
                    for k in rng.permutation(x.shape[1])[: max(4, x.shape[1] * 2 // 3)]:
                        if not len(cuts[k]):
                            continue
                        c = code[own, k]
                        gl = np.cumsum(np.bincount(c, g[own], len(cuts[k]) + 1))[:-1]
                        hl = np.cumsum(np.bincount(c, h[own], len(cuts[k]) + 1))[:-1] + 1e-3
                        nl = np.cumsum(np.bincount(c, minlength=len(cuts[k]) + 1))[:-1]
                        gain = gl**2 / hl + (total_g - gl) ** 2 / (total_h - hl + 2e-3) - total_g**2 / total_h
                        gain[(nl < 15) | (len(own) - nl < 15)] = -1
                        j = int(gain.argmax())
                        if gain[j] > 1e-3 and (best is None or gain[j] > best[0]):
                            best = (gain[j], k, j)
                if best is None:
                    if len(own):
                        raw[rows] += rate * g[own].sum() / (h[own].sum() + 1.0)
                    continue
                _, k, j = best
                above = code[rows, k] > j
                for side in (False, True):
                    rule = (*path, (int(k), side, float(cuts[k][j])))
                    rules[rule] = None
                    after.append((rule, rows[above == side]))
            level = after
    return list(rules)


def coverage(x: np.ndarray, rules: list[Rule]) -> np.ndarray:
    out = np.ones((len(x), len(rules)), np.float32)
    for r, rule in enumerate(rules):
        for k, above, t in rule:
            out[:, r] *= (x[:, k] > t) if above else (x[:, k] <= t)
    return out


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float, steps: int = 250) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient; the intercept is free."""
    n = len(y)
    top = z.T @ (z @ np.ones(z.shape[1], np.float32)) / n
    size = 4.0 / (float(top.max()) + 1.0)
    w, v, b, c, t = np.zeros(z.shape[1], np.float32), np.zeros(z.shape[1], np.float32), 0.0, 0.0, 1.0
    for _ in range(steps):
        r = 1 / (1 + np.exp(-(z @ v + c))) - y
        new = v - size * (z.T @ r.astype(np.float32) / n)
        new = np.sign(new) * np.maximum(np.abs(new) - size * penalty, 0)
        new_b = c - size * float(r.mean())
        t, last = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
        v, c = new + (last - 1) / t * (new - w), new_b + (last - 1) / t * (new_b - b)
        w, b = new.astype(np.float32), new_b
    return b, w


class RuleModel:
    """Weighted conjunctive rules; ``column`` is the score as Spark SQL."""

    def __init__(self, intercept: float, rules: list[Rule], weights: list[float]):
        self.intercept, self.rules, self.weights = intercept, rules, weights

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, penalties=(1e-2, 3e-3, 1e-3, 3e-4)) -> "RuleModel":
        y = y.astype(float)
        if not len(y) or y.min() == y.max():
            share = float(y.mean()) if len(y) else 0.5
            return cls(math.log((share + 1e-6) / (1 - share + 1e-6)), [], [])
        rules = grow_rules(x, y)
        if not rules:
            return cls(math.log(y.mean() / (1 - y.mean())), [], [])
        z = coverage(x, rules)
        _, first = np.unique(np.packbits(z.astype(bool), axis=0), axis=1, return_index=True)
        first = np.sort(first)
        z, rules = z[:, first], [rules[k] for k in first]
        test = np.arange(len(y)) % 5 == 0
        loss = {}
        for penalty in penalties:
            b, w = lasso_logistic(z[~test], y[~test], penalty)
            p = np.clip(1 / (1 + np.exp(-(z[test] @ w + b))), 1e-6, 1 - 1e-6)
            loss[penalty] = -np.mean(y[test] * np.log(p) + (1 - y[test]) * np.log(1 - p)) if test.any() else 0.0
        # The sparsest of the fits that are about as good as the best.
        b, w = lasso_logistic(z, y, max(p for p in penalties if loss[p] <= min(loss.values()) + 0.002))
        kept = np.flatnonzero(np.abs(w) > 1e-4)
        return cls(float(b), [rules[k] for k in kept], [float(w[k]) for k in kept])

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(coverage(x, self.rules) @ np.array(self.weights, np.float32) + self.intercept)))

    def column(self, names=STATISTICS) -> Column:
        def holds(rule: Rule) -> Column:
            return reduce(Column.__and__, [(F.col(names[k]) > t) if above else (F.col(names[k]) <= t) for k, above, t in rule])

        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights):
            total = total + F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> RuleModel:
    """A model from the labelled rows that are not held out, ``train_rows`` of
    them at most; only their texts are looked at.  The labels picked are so
    few by their limit that they can be sent to every task."""
    marks = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("_quality")).where(~held_out(F.col("_id")))
    picked = marks.orderBy(F.xxhash64("_id"), "_id", "_quality").limit(train_rows)
    given = docs.select(F.col("doc_id").cast("long").alias("_id"), "text")
    rows = with_statistics(given.join(F.broadcast(picked), "_id"))
    some = rows.orderBy(F.xxhash64("_id"), "_id", "_quality", *STATISTICS).limit(train_rows).toArrow()
    x = np.stack([some[c].to_numpy() for c in STATISTICS], 1) if len(some) else np.zeros((0, len(STATISTICS)))
    return RuleModel.fit(x, some["_quality"].to_numpy() if len(some) else np.zeros(0))


def score_quality(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted and the statistics of every document."""
    score = fit_quality(docs, labels, train_rows).column()
    stats = with_statistics(docs.select("doc_id", "text"))
    return stats.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), *STATISTICS).withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))


def keep_good(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` without the documents whose score is below THRESHOLD."""
    score = fit_quality(docs, labels, train_rows).column()
    row = docs.select(F.struct(*docs.columns).alias("_row"), "text")
    return with_statistics(row).where(score >= THRESHOLD).select("_row.*")
