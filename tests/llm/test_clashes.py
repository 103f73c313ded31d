"""Extra columns named like an operator's inner or made columns."""

import corpus_pipeline
from quillstone.llm import bpe, chat, fingerprints, jpeg, mixing, pii, quality, repeats, simhash, url_filters

NAMES = "_row _id _key _k _size _copies _t _text text_ k0 k1 k2 key node root fp fp1 f0 ids decoded media n_bytes feature fingerprint component_id score predicted n_words spans size taken target copies bucket row_key stretch halo anchor found held_out _listed _at".split()


def test_operators(spark):
    rows = [(1, "alpha beta gamma 4111111111111111", "en", "s", 33, *("x" for _ in NAMES)), (2, None, None, None, None, *(None for _ in NAMES))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in NAMES))
    made = [
        bpe.decode(bpe.encode(df)), jpeg.features(jpeg.store(df)), fingerprints.fingerprints(df), fingerprints.fingerprint_edits(df), simhash.fingerprints(df, seeds=(1, 2)), simhash.near_duplicates(df),
        quality.with_statistics(df), quality.score_quality(df, df.selectExpr("doc_id", "1 as quality", "text")), pii.pseudonymize(df, key=b"k"), mixing.mix(df), mixing.mixed_documents(df), simhash.unique_documents(df),
    ]
    chats = spark.createDataFrame([(1, 0, "user", "a", *("x" for _ in NAMES)), (None, None, None, None, *(None for _ in NAMES))], "conv_id long, turn long, role string, text string, " + ", ".join(f"{n} string" for n in NAMES))
    events = spark.createDataFrame([("h.org", "/", "spam", "add", "2024-01-01", *("x" for _ in NAMES))], "host string, prefix string, category string, action string, dated string, " + ", ".join(f"{n} string" for n in NAMES))
    results = "host blocked n_active categories listed_since _host _path _n _h _p _a prefix category valid_from valid_to".split()
    captures = spark.createDataFrame([("http://a.h.org/x", "2024-02-01", *("x" for _ in NAMES + results)), (None, None, *(None for _ in NAMES + results))], "url string, fetched_at string, " + ", ".join(f"{n} string" for n in NAMES + results))
    filtered = url_filters.filter_urls(captures, events)
    assert sorted((r.host, r.blocked, r._host) for r in filtered.select("host", "blocked", "_host").collect()) == [("", False, None), ("a.h.org", True, "x")]
    made += [repeats.dedup_repeats(df), chat.digest_chats(chat.format_chats(chats)), filtered]
    for out in made:
        assert len(set(out.columns)) == len(out.columns)
        out.collect()


def test_pipeline_stages_pass_them_on(spark, tmp_path):
    docs = spark.createDataFrame([(k, f"alpha beta gamma {k} " * 9, "en", "s", 1, *(f"{n}{k}" for n in NAMES)) for k in range(6)], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in NAMES))
    spark.createDataFrame([(0, 1)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    out = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, str(tmp_path))
        assert out.columns == docs.columns
    rows = out.collect()
    assert rows and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in NAMES)
    assert corpus_pipeline.STAGES[-1][1](spark, out, str(tmp_path)).count() == len(rows)
