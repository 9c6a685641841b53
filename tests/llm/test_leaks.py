import corpus_pipeline

ITEM = "which of the seven rivers of the northern plain reaches the sea first in spring"
OTHER = "name the metal that the old masters of the valley melted with tin and why"
PLAIN = "an invented report on weather and roads that has nothing to do with any test at all"


def test_a_document_with_one_whole_item_goes(spark, tmp_path):
    spark.createDataFrame([(1, ITEM), (2, OTHER), (None, PLAIN[:60])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [
        (0, "plain words before " + ITEM + " and plain words after", 1),
        (1, "Plain. " + ITEM.upper().replace(" ", ", ") + "!", 2),
        (2, ITEM + " " + OTHER, 3),
        (3, " ".join(ITEM.split()[:7]) + " is no whole window", 4),
        (4, "an invented report on weather and trains that has nothing to do", 5),
        (5, PLAIN, 6),
        (6, "", 7),
        (7, None, 8),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_hit long").repartition(3)
    clean = corpus_pipeline.drop_leaks(spark, docs, str(tmp_path))
    assert clean.columns == docs.columns
    # 5 holds windows of an item without an id
    assert sorted(tuple(r) for r in clean.collect()) == [rows[i] for i in (3, 4, 6, 7)]


def test_planted_passages_of_the_given_tables_go(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [r["text"].lower() for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    whole = {r["doc_id"] for r in docs.collect() if any(i in r["text"].lower() for i in items)}
    left = {r["doc_id"] for r in corpus_pipeline.drop_leaks(spark, docs, sf).select("doc_id").collect()}
    assert len(whole) > 5 and not whole & left
    assert len(left) > 0.9 * docs.count()
