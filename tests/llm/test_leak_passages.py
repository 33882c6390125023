from inkmill.llm import leaks


def test_every_passage_of_an_item_has_a_row(spark):
    items = spark.createDataFrame([(7, "t", "one two three four five six seven eight")], "item_id bigint, task string, text string")
    text = "One two three four! And then, much later: six seven eight."
    docs = spark.createDataFrame([(1, text), (1, text), (2, "Nothing of it")], "doc_id bigint, text string")
    found = {tuple(r) for r in leaks.leaked_passages(docs, items, 3).collect()}
    assert found == {(1, 7, 0, 18, 4), (1, 7, 42, 57, 3)}
    assert [tuple(r) for r in leaks.leak_report(docs, items, 3).collect()] == [(7, "t", 1, 4)]
