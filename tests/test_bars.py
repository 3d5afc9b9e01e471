"""Each bar under, on and over; missing and null ends; rounding; contents of a package; verdicts over a stream."""

import pytest
from pyspark.sql import functions as F

from cantor.functions import numbers as N
from cantor.functions import text as X
from cantor.operators import gate, metrics, overlay
from cantor.streaming import gate as streaming

GOOD = {"paras": 100, "placed": 80, "span_coverage": 0.95, "lead_s": 10.0, "start_gap": 0.0, "end_gap": 0.0, "median_conf": 0.9, "has_ends": True}
CASES = [
    ({}, None), ({"median_conf": 0.8}, None), ({"median_conf": 0.799}, "median confidence 0.80"), ({"span_coverage": 0.9}, None), ({"span_coverage": 0.899}, "only 90% of the text between"),
    ({"placed": 50}, None), ({"placed": 49}, "only 49% of the tale's paragraphs"), ({"lead_s": 125.0}, None), ({"lead_s": 125.1}, "plays for 125 seconds"), ({"start_gap": 0.05}, None),
    ({"start_gap": 0.051}, "starts 5% of the way"), ({"end_gap": 0.05}, None), ({"end_gap": 0.051}, "stops 5% short"), ({"start_gap": None}, "starts 100%"), ({"end_gap": None}, "stops 100%"),
    ({"paras": 0, "placed": 0}, ""), ({"median_conf": 0.1, "lead_s": 900.0, "end_gap": None}, "median confidence"),
]
SCHEMA = "paras int, placed int, span_coverage double, lead_s double, start_gap double, end_gap double, median_conf double, has_ends boolean"


def test_bars(spark):
    rows = [tuple((GOOD | change).values()) for change, _ in CASES]
    got = gate.verdicts(spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], f"k int, {SCHEMA}")).orderBy("k").collect()
    for r, (change, wanted) in zip(got, CASES, strict=True):
        assert r["pass"] == (wanted is None), change
        assert (r.refusal is None) if wanted is None else wanted in (r.refusal or ""), (change, r.refusal)


def test_missing_ends_are_an_error(spark):
    row = spark.createDataFrame([tuple((GOOD | {"has_ends": False}).values())], SCHEMA)
    with pytest.raises(Exception, match="predates the ends gate"):
        gate.verdicts(row).collect()


def test_ties_round_as_binary_numbers(spark):
    values = [0.8995, 2.675, 0.0005, 0.5, 1.5, 2.5, None]
    got = spark.createDataFrame([(v,) for v in values], "x double").select(N.rounded(F.col("x"), 3).alias("a"), N.rounded(F.col("x"), 0).alias("b")).collect()
    assert [r.a for r in got] == [None if v is None else round(v, 3) for v in values]
    assert [r.b for r in got] == [None if v is None else round(v, 0) for v in values]


def test_contents_are_top_level_sections_with_a_heading(spark):
    body = '<section id="a"><h2>Q &amp; A&nbsp;&lt;1&gt;</h2><div><section id="in"><h3>Inner</h3></section></div></section><section><h2>No id</h2></section><section id="b"><p>none</p></section>'
    got = spark.createDataFrame([(body,), ("<p>x</p>",)], "b string").select(overlay.nav("b", F.lit("T & U"), F.lit("en")).alias("n")).collect()
    assert got[0].n.count("<li>") == 1 and 'href="book.xhtml#a">Q &amp; A\xa0&lt;1&gt;<' in got[0].n
    assert '<li><a href="book.xhtml">T &amp; U</a></li>' in got[1].n


def test_void_elements_are_closed(spark):
    got = spark.createDataFrame([('a<br>b<hr class="x" />c<img src="i.png">d<col>e<colgroup>f&nbsp;',)], "b string").select(X.xhtml_repair("b").alias("x")).first().x
    assert got == 'a<br/>b<hr class="x"/>c<img src="i.png"/>d<col/>e<colgroup>f&#160;'


def test_apparatus_is_left_out_unless_most_is_apparatus(spark):
    def rows(ids):
        return [(k, o, a, True, True) for k, names in enumerate(ids) for o, a in enumerate(names)]

    few, many = ["notes-1", "a-1", "a-2", "preface"], ["notes-1", "notes-2", "index", "a-1", "notes"]
    paras = spark.createDataFrame(rows([few, many]), "book_id int, ord int, anchor_id string, real boolean, placed boolean")
    got = {r.book_id: r.body_paras for r in metrics.coverage(metrics.marked(paras)).collect()}
    assert got == {0: 2, 1: 5}


def test_verdicts_over_a_stream(spark, tmp_path):
    schema = streaming.PARAGRAPH
    part = lambda name, rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/{name}")
    part("1", [(1, 4, 0, True, [0.9, 0.9], 3.0), (1, 4, 1, True, [0.9], 9.0), (2, 2, 0, True, [], 0.0)])
    part("2", [(1, 4, 2, True, [0.95], 20.0), (1, 4, 3, True, [0.9], 30.0), (2, 2, 1, True, [0.9], 5.0)])
    rows = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    query = streaming.running(rows).writeStream.outputMode("update").format("memory").queryName("verdicts").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination(240)
    got = [(r.book_id, r.placed, r["pass"]) for r in spark.table("verdicts").collect()]
    assert sorted(g for g in got if g[0] == 1) == [(1, 2, False), (1, 4, True)]
    assert max(g for g in got if g[0] == 2) == (2, 1, False)
