import zlib

import numpy as np

from quillstone.llm import quality, queries


def test_query(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")  # more labels
    got = {r.doc_id: r for r in queries.op5_quality_classifier(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    for r in docs:
        g = got[r.doc_id]
        assert g.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= g.score <= 1 and g.predicted == int(g.score >= 0.7)
    held = [d for d in marks if got[d].held_out]
    assert held and np.mean([got[d].predicted == marks[d] for d in held]) >= 0.95


def test_held_out_labels_are_not_learnt(spark, sf_dir):
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    from pyspark.sql import functions as F

    twisted = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.fit_quality(docs, labels), quality.fit_quality(docs, twisted)
    assert a.rules == b.rules and a.weights == b.weights


def test_rules_in_sql_equal_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.random((3000, len(quality.STATISTICS)))
    y = ((x[:, 1] > 0.6) & (x[:, 4] < 0.5) | (x[:, 9] > 0.9)).astype(float)
    model = quality.RuleModel.fit(x, y)
    scores = model.scores(x)
    assert ((scores > 0.5) == y).mean() > 0.97 and 0 < len(model.rules) < 250
    df = spark.createDataFrame([tuple(map(float, r)) for r in x[:200]], ", ".join(f"{n} double" for n in quality.STATISTICS))
    got = [r.s for r in df.select(model.column().alias("s")).collect()]
    assert np.allclose(got, scores[:200], atol=1e-4)


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 9.0), (2, "", 9.0), (3, "a " * 400_000, 9.0), (None, "x y", 9.0), (3, "b", 9.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (3, 1), (None, 0), (5, None)], "doc_id long, quality int")
    got = quality.score_quality(docs, labels).collect()
    assert len(got) == 5 and all(r.score > 0.9 for r in got) and len({r.score for r in got}) == 1
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    assert {r.score for r in quality.score_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.score_quality(docs.limit(0), labels).count() == 0
    assert quality.keep_good(docs, labels).columns == docs.columns
