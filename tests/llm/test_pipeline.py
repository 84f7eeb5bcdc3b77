"""Stages of the corpus pipeline on small fixtures."""

import corpus_pipeline


def test_one_row_of_a_group_of_near_copies_stays(spark):
    words = [f"w{i}" for i in range(100)]
    text, near, other = " ".join(words), " ".join([*words[:-1], "new"]), " ".join(reversed(words))
    rows = [
        (7, text, "de"), (7, text, "en"), (9, near, "en"), (3, near, "en"), (None, text, "en"), (None, near, "en"),
        (None, other, "en"), (None, other, "en"),
        (4, "one two three four five six", "en"), (4, "quite another text under the same id", "en"),
        (5, "", "en"), (5, None, "en"), (None, "", "en"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    want = [rows[i] for i in (3, 6, 8, 9, 10, 11, 12)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert corpus_pipeline.drop_near_duplicates(spark, docs.where("false"), "").count() == 0
