import brute

import corpus_pipeline


def test_pipeline_keeps_what_the_plain_stages_keep(spark, tmp_path, odd_rows):
    rows = list(dict(odd_rows).items())
    items = [(1, " ".join(odd_rows[12][1].split()[:40]) or "x"), (2, None)]
    docs = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    kept = [(i, t) for i, t in rows if t and any(c.isalpha() for c in t)]
    last = {}
    for i, t in kept:
        last[t] = i if t not in last or i is not None and (last[t] is None or i > last[t]) else last[t]
    kept = [(i, t) for i, t in kept if last[t] == i]
    kept = [r for r, (i, _, c) in zip(kept, brute.similar(kept)) if i == c]
    kept = [r for r, bad in zip(kept, brute.leaked(kept, items)) if not bad]

    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
    got = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == {i for i, _ in kept}
