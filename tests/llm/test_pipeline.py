from __future__ import annotations

import corpus_pipeline as pipeline
from tramline.llm import mixing

DATA = "/root/testdata/sf0.001"


def test_stages_keep_clean_documents_and_drop_copies(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    junk = spark.createDataFrame([(10_000, "!!! 123", "en", "s", 7), (10_001, None, None, None, None)], docs.schema)
    copy = docs.limit(3).selectExpr("doc_id + 20000 AS doc_id", "text || ' x' AS text", "lang", "source", "n_chars").where("n_chars > 400")
    held, n_copies = docs.unionByName(junk).unionByName(copy), copy.count()
    seen = {}
    for name, stage in pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, held, DATA).write.parquet(path)
        after = spark.read.parquet(path)
        if name != "packing":
            assert sorted(after.columns) == sorted(docs.columns)
        seen[name] = (held, after)
        held = after
    before, after = seen["language"]
    assert before.join(after, "doc_id", "left_anti").count() == 2
    before, after = seen["near_duplicates"]
    gone = {r.doc_id for r in before.join(after, "doc_id", "left_anti").collect()}
    assert n_copies and {d for d in gone if d >= 20_000} and after.count() == before.count() - len(gone)
    before, after = seen["repeated_passages"]
    assert before.count() == after.count() and after.where("n_chars <> length(text)").count() == 0
    before, after = seen["mixing"]
    assert sorted(map(tuple, before.collect())) == sorted(map(tuple, after.collect()))
    before, after = seen["packing"]
    assert after.select("doc_id").distinct().count() == before.count()


def test_language_stage_judges_by_the_model(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    other = [(10_000, "北京是中国的首都,人口众多", None, "s", 13), (10_001, "москва столица россии", None, "s", 21), (10_002, "the cat", None, "s", 7)]
    kept = {r.doc_id for r in pipeline.language_stage(spark, docs.unionByName(spark.createDataFrame(other, docs.schema)), DATA).select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.select("doc_id").collect()} | {10_002}
    plain = spark.createDataFrame([(1, "Zoë", None, "s", 3), (2, "12 !", None, "s", 4), (3, None, None, "s", None)], docs.schema)
    assert [r.doc_id for r in pipeline.language_stage(spark, plain, DATA).collect()] == [1]


def test_sequences_follow_the_mix(spark, tmp_path):
    rows = [(i, " ".join(f"w{i * 7 % 1000 + j}" for j in range(400 if i % 10 else 20)), "en", "hot" if i % 10 else "small", None) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pipeline.mixing_stage(spark, docs, DATA).write.parquet(str(tmp_path / "mixed"))
        pieces = pipeline.packing_stage(spark, spark.read.parquet(str(tmp_path / "mixed")), DATA).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    position = {r.doc_id: r.position for r in mixing.mix(docs).collect()}
    ranges = {}
    for p in pieces:
        ranges.setdefault(p.sequence_id >> 40, []).append(position[p.doc_id])
    ranges = [ranges[k] for k in sorted(ranges)]
    assert len(ranges) > 2 and all(max(a) < min(b) for a, b in zip(ranges, ranges[1:]))  # noqa: B905


def test_run(spark):
    assert pipeline.run(spark, DATA).count() > 0


def test_near_stage_tells_documents_of_one_id_apart(spark):
    text = lambda k, n=40: " ".join(f"{k}{i}" for i in range(n))
    rows = [(5, text("a")), (5, text("b")), (5, text("b")), (3, text("b") + " x"), (None, text("c")), (None, text("c")), (None, text("d")), (7, None), (7, None), (8, ""), (9, text("a"))]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "x", 2) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, _key string, component_id int")
    got = sorted((str(r.doc_id), (r.text or "")[:2]) for r in pipeline.near_stage(spark, docs, DATA).collect())
    assert got == [("3", "b0"), ("7", ""), ("8", ""), ("9", "a0"), ("None", "c0"), ("None", "d0")]
    assert pipeline.near_stage(spark, docs.limit(0), DATA).count() == 0
