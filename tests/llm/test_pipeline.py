import corpus_pipeline
from lapsewatch.llm import catalog, decontaminate, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    counts = [before]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        counts.append(docs.count())
        assert docs.columns == columns if i < 4 else docs.columns == [*columns, "size", "shard", "slot"]
    assert before > counts[1] >= counts[2] >= counts[3] > before / 2 and counts[5] == counts[4]
    assert corpus_pipeline.run(spark, SF).count() == counts[5]


def test_bad_texts_take_no_other_rows_of_their_id(spark, tmp_path):
    item = " ".join(f"item{i}" for i in range(12))
    rows = [(None, "clean"), (None, "so " + item), (1, "clean"), (1, item), (2, None), (2, ""), (3, item)]
    spark.createDataFrame([("a", item)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = decontaminate.stage(spark, docs, str(tmp_path)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [rows[i] for i in (0, 2, 4, 5)]))
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    foul = " ".join(toxicity.LEXICON)
    rows = [(None, "clean words"), (None, foul), (1, "clean words"), (1, foul), (2, foul)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = toxicity.stage(spark, docs, str(tmp_path)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [rows[0], rows[2]]))


def test_every_operator_has_its_query():
    assert sorted(int(k[2:].split("_")[0]) for k in catalog.QUERIES) == list(range(1, 14))
