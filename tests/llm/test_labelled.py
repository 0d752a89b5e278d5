from rainledger.llm.labelled import sample


def test_one_text_an_id(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(2, None), (3, "three")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 1), (None, 1)], "doc_id long, toxic int")
    rows = sample(docs, labels, "toxic", 5, 9, 100).collect()
    assert sorted((r.id, r.label) for r in rows) == [(1, 1), (2, 0), (3, 1)]
    assert {r.id: r.text for r in rows}[2] == "" and len(sample(docs, labels, "toxic", 5, 9, 2).collect()) <= 2
