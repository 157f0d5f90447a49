"""The stages against brute force on a small corpus with planted cases."""

import corpus_pipeline
from llm.helpers import frame, prose, seeded, words
from llm.test_models import labelled


def test_stages(spark, tmp_path):
    rng = seeded(41)
    texts, toxic = labelled(240, 42)
    clean = [prose(rng, 120, 3000) for _ in range(20)]
    near = clean[0].split(" ")
    near[7] = "other"
    passage, item = prose(rng, 70, 3000).replace("\n", " "), prose(rng, 30, 3000)
    planted = [" ".join(near), clean[1], *[prose(rng, 120, 3000) + "\n" + passage for _ in range(2)], "some words first " + item]
    extra = [prose(rng, 60, 3000), None, ""]
    all_ = texts + clean + planted + extra
    frame(spark, all_).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "substring_dedup", "decontaminate", "packing"]
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / f"s{k}"))
        docs = spark.read.parquet(str(tmp_path / f"s{k}"))
        kept.append({r.doc_id: r.text for r in docs.collect()})
    ids = lambda lo, n: set(range(lo, lo + n))
    bad = {i for i, t in enumerate(toxic) if t}
    assert len(bad & set(kept[0])) <= 0.2 * len(bad) and len(set(range(240)) - bad - set(kept[0])) <= 8 and len(ids(240, 20) - set(kept[0])) <= 1 and ids(260, 8) <= set(kept[0]) | {265}
    assert set(kept[0]) - set(kept[1]) == {260, 261}  # a near copy and a copy
    assert set(kept[2]) >= set(kept[1]) - {262, 263} - bad
    parts = [passage in (kept[2].get(i) or "") for i in (262, 263)]
    assert sum(parts) == 1 and len(words(kept[2].get(263))) <= 121 + 12
    assert set(kept[2]) - set(kept[3]) == {264}
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = {}
    for i, t in kept[3].items():
        if words(t):
            want[i] = len(words(t))
    got = {}
    for r in found:
        for d, n in zip(r.doc_ids, r.lengths):
            got[d] = got.get(d, 0) + n
    assert got == want


def test_empty_tables_repeated_rows_and_clashing_columns(spark, tmp_path):
    rng = seeded(43)
    t = prose(rng, 60)
    texts, ids = [t, t, t, None, "", prose(rng, 5000), "one two"], [1, 1, None, 2, 3, 4, 5]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    for name, docs in (("a", frame(spark, texts, ids, clashing=True)), ("b", frame(spark, []))):
        at = tmp_path / name
        for table, df in (("documents", docs), ("labels", labels), ("benchmark", bench)):
            df.write.parquet(f"{at}/{table}.parquet")
        windows = corpus_pipeline.run(spark, str(at)).collect()
        seen = {}
        for r in windows:
            for d, n in zip(r.doc_ids, r.lengths):
                seen[d] = seen.get(d, 0) + n
        assert seen == ({1: 60, 4: 5000, 5: 2} if name == "a" else {})
        read = spark.read.parquet(f"{at}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, read, str(at))
            assert out.columns == docs.columns and {r.doc_id for r in out.collect() if not r.text} >= ({2, 3} if name == "a" else set())
