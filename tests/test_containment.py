import __spark_entry__


def test_passages_inside_words(spark, tmp_path):
    passage = "one two three four five six seven eight nine ten"
    docs = [(1, f'he said "{passage}" and left'), (2, f"tab\t{passage}."), (3, "see (alpha beta), gamma"), (4, "one two three")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage), (2, "alpha beta")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = __spark_entry__.queries()["benchmark_containment"](spark, str(tmp_path)).collect()
    assert {(r.doc_id, r["items"], r.n) for r in got} == {(1, "1", 1), (2, "1", 1), (3, "2", 1)}
