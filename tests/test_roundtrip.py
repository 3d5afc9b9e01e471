"""Whole texts come back from the JSON round trip."""

import os

from cantor.plans import catalogue

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_whole_texts_come_back(spark):
    texts = {r.doc_id: r.text for r in catalogue.table(spark, FOLDER, "documents").collect()}
    assert {r.doc_id: r.title for r in catalogue._roundtrip(spark, FOLDER).select("doc_id", "book.title").collect()} == texts


def test_marks_late_in_a_text_come_back(spark, tmp_path):
    text = "x" * 60 + ' "quoted" \\ \t\n\x01 </p> \u2028 \U0001f600'
    spark.createDataFrame([(1, text, "en"), (2, None, "en")], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.title for r in catalogue._roundtrip(spark, tmp_path).select("doc_id", "book.title").collect()} == {1: text, 2: None}
