"""The pipeline over a small corpus: what each stage drops, and what is left."""

import random

from siftwell.llm.common import stored


def test_each_stage_drops_what_it_should(spark, tmp_path):
    import corpus_pipeline

    draw = random.Random(1)
    word = lambda: "".join(draw.choice(["th", "ing", "er", "on", "re", "an"]) for _ in range(draw.randint(1, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, text(80), "en") for i in range(40)]
    near = text(120).split()
    same = text(80)  # near no other text, so only the exact stage has to do with it
    rows += [(50, "copy " + same, "en"), (51, "COPY " + same, "en")]
    rows += [(60, " ".join(near), "en"), (61, " ".join([*near[:60], "zzz", *near[61:]]), "en")]
    leak = text(30)
    rows += [(70, text(40) + " " + leak + " " + text(40), "en"), (80, "12345 !!!", "en"), (81, None, "en")]
    table = spark.createDataFrame([(i, t, k, "s", 0) for i, t, k in rows], "doc_id long, text string, lang string, source string, n_chars long")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    gone = []
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, now, str(tmp_path)))
        assert out.columns == table.columns, name
        ids = lambda df: {r[0] for r in df.select("doc_id").collect()}
        gone.append(ids(now) - ids(out))
        now = out
    assert gone == [{80, 81}, {50}, {61}, {70}]
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == {r[0] for r in now.select("doc_id").collect()}


def test_an_empty_corpus(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
