"""Keyed snapshots by bucket, the summary table and the JSON document."""

import json
import os

from pyspark.sql import functions as F

from conftest import make_steps
from setstride.operators import evaluate
from setstride.sources.keyed import KeyedTable
from setstride.sources.store import append_summary, before_old_page, upsert, write_document
from test_learners import periodic

ROWS = "k long, a int, b string"


def test_bucketed_upsert_is_the_whole_table_upsert(spark, tmp_path):
    first = spark.createDataFrame([(i, i, str(i)) for i in range(200)], ROWS)
    second = spark.createDataFrame([(3, 30), (3, 31), (500, 5)], "k long, a int")
    table = KeyedTable(spark, str(tmp_path / "t"), first.schema, ("k",), 8)
    assert table.version() == -1 and table.read().count() == 0
    assert (table.upsert(first), table.upsert(second, ["a"])) == (0, 1)
    expected = upsert(first, [second], ["k"], ["a"])
    assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, expected.collect()))
    assert sorted(map(tuple, table.read(0).collect())) == sorted(map(tuple, first.collect()))  # earlier versions stay
    assert table.upsert(second, ["a"], version=1) == 1  # a batch that is run again
    assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, expected.collect()))


def test_an_upsert_touches_only_its_buckets(spark, tmp_path):
    rows = spark.createDataFrame([(i, i, "x") for i in range(300)], ROWS)
    table = KeyedTable(spark, str(tmp_path / "t"), rows.schema, ("k",), 16)
    table.upsert(rows)
    before = table.manifest()
    table.upsert(rows.where("k = 7").withColumn("a", F.lit(-1)))
    after = table.manifest()
    assert sum(before[b] != after[b] for b in before) == 1
    found = table.lookup(spark.createDataFrame([(7,), (900,)], "k long"))
    assert [tuple(r) for r in found.collect()] == [(7, -1, "x")]
    read = {os.path.dirname(f) for f in found.inputFiles()}
    assert len(read) <= 2


def test_paging_stops_at_the_first_old_row(spark):
    pages = spark.createDataFrame([(1, 90), (1, 89), (2, 88), (2, 40), (3, 87), (4, 39)], "page int, k int")
    stored = spark.createDataFrame([(40,), (39,)], "k int")
    assert sorted(r["k"] for r in before_old_page(pages, stored, "k", "page").collect()) == [88, 89, 90]
    assert before_old_page(pages.where("k > 80"), stored, "k", "page").count() == 4


def test_summary_rows_append_with_25_columns(spark, tmp_path):
    table = make_steps(spark, periodic(260))
    report = evaluate.walk_report(evaluate.prequential(table, ("frequency", "bayesian"), 200, 50, {}), table)
    for run in ("2024-01-01 10:00", "2024-01-02 10:00"):
        append_summary(report, str(tmp_path / "summary"), run, {"frequency": 2.04})
    back = spark.read.option("header", True).csv(str(tmp_path / "summary"))
    assert len(back.columns) == 25 and back.columns[:3] == ["run_time", "model", "n_draws"] and back.columns[-1] == "buy5_roi"
    assert {(r["run_time"][:10], r["model"], r["elapsed_sec"]) for r in back.collect()} == {
        (d, m, e) for d in ("2024-01-01", "2024-01-02") for m, e in (("frequency", "2.0"), ("bayesian", None))
    }


def test_document_of_the_open_step(spark, tmp_path):
    table = make_steps(spark, periodic(300))
    write_document(evaluate.next_step_document(table, ("frequency", "bayesian", "knn", "genetic")), str(tmp_path / "doc"))
    (line,) = spark.read.text(str(tmp_path / "doc")).collect()
    doc = json.loads(line["value"])
    assert doc["ord"] == 300 and [m["model"] for m in doc["models"]] == ["bayesian", "frequency", "genetic", "knn"]
    assert all(len(m["tickets"]) == 5 and sorted(m["items"]) == m["items"] for m in doc["models"])
    assert len(doc["consensus"]) == 5 and len(doc["votes"]) <= 10
