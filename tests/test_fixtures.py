"""Hand-computed literals for parsing, patterns, frequencies, storage and payoffs."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import Step, make_steps
from setstride.functions.arrays import expected_prize, hits, prize
from setstride.functions.casts import money, safe_float, safe_int
from setstride.functions.stats import student_two_sided
from setstride.operators.evaluate import date_histogram, fold_windows, require_folds
from setstride.operators.patterns import patterns
from setstride.operators.scorers import scorer
from setstride.operators.state import frequency
from setstride.sources import records
from setstride.sources.html import parse_table_draws
from setstride.sources.store import append_table, backfill, latest_key, read_table, upsert


def record(number=4065, balls=(40, 1, 46, 26, 35), special=(7,), **extra):
    plain = {str(i): {"Number": str(n), "IsSpecial": False} for i, n in enumerate(balls)}
    marked = {str(10 + i): {"Number": str(n), "IsSpecial": True} for i, n in enumerate(special)}
    return {"DrawNumber": number, "DrawDate": "2026-03-18T07:00:00", "WinningNumbers": plain | marked} | extra


def pages(spark, tmp_path, *raw, broken=False):
    lines = [json.dumps({"PreviousDraws": list(raw), "TotalPreviousDraws": len(raw)})]
    (tmp_path / "pages.json").write_text("\n".join(lines + (["{not json"] if broken else [])))
    return records.read_pages(spark, str(tmp_path))


def parsed(spark, tmp_path, *raw):
    return records.parse_draws(records.raw_records(pages(spark, tmp_path, *raw)))


def test_valid_record(spark, tmp_path):
    row = records.valid_draws(parsed(spark, tmp_path, record(JackpotAmount=5000000))).first()
    assert row.asDict() == {
        "draw_number": 4065, "draw_date": date(2026, 3, 18), "n1": 1, "n2": 26, "n3": 35, "n4": 40, "n5": 46,
        "mega_number": 7, "jackpot_amount": 5000000.0,
    }


def test_rejections_name_their_reason(spark, tmp_path):
    no_key = record()
    del no_key["DrawNumber"]
    bad = [
        no_key, record(1, balls=(1, 2, 3, 4, 99)), record(2, balls=(1, 2)), record(3, special=()),
        record(4, special=(1, 2)), record(5, special=(28,)),
    ]
    reasons = [r["reason"] for r in parsed(spark, tmp_path, *bad).orderBy("draw_number").collect()]
    assert reasons == [
        "draw number", "number out of range", "count of numbers", "special missing", "several specials", "special out of range",
    ]


def test_repeated_number_is_kept(spark, tmp_path):
    assert parsed(spark, tmp_path, record(balls=(5, 5, 6, 7, 8))).first()["reason"] is None


def test_prizes(spark, tmp_path):
    listed = [
        {"PrizeDescription": "5 + Mega", "NumberOfWinners": 0, "PrizeAmount": 5000000},
        {"PrizeDescription": "5 + 0", "NumberOfWinners": 2, "PrizeAmount": 20000.5},
        {"PrizeDescription": "4 + Mega", "NumberOfWinners": 9, "PrizeAmount": 1500},
    ]
    mapped = {"1": {"PrizeTypeDescription": "5 + Mega", "Count": 0, "Amount": "$1,000,000"}}
    good = parsed(spark, tmp_path, record(PrizePayoutDetails=listed), record(2, Prizes=mapped), record(3), record(4, special=(), PrizePayoutDetails=listed))
    rows = sorted(tuple(r) for r in records.draw_prizes(good).collect())
    assert rows == sorted([
        (4065, "5 + Mega", 0, 5000000.0), (4065, "5 + 0", 2, 20000.5), (4065, "4 + Mega", 9, 1500.0), (2, "5 + Mega", None, 1000000.0),
    ], key=lambda r: (r[0], r[1]))


def test_broken_page_is_counted_and_skipped(spark, tmp_path):
    landed = pages(spark, tmp_path, record(), broken=True)
    assert records.page_report(landed).first()["broken"] == 1
    assert records.raw_records(landed).count() == 1


def test_casts(spark):
    rows = spark.createDataFrame([("$1,000,000", "12"), ("N/A", "3.0"), ("", "x"), (None, None)], "a string, b string")
    got = rows.select(safe_float(F.col("a")).alias("a"), safe_int(F.col("b")).alias("b")).collect()
    assert [tuple(r) for r in got] == [(1000000.0, 12), (None, 3), (None, None), (None, None)]
    texts = spark.createDataFrame([("$11M",), ("10 Million",), ("1.2B",), ("750",), ("none",)], "t string")
    assert [r[0] for r in texts.select(money(F.col("t"))).collect()] == [11e6, 10e6, 1.2e9, 750.0, None]


def test_html_table(spark):
    rows = [
        ("December 28, 2024", "6 14 22 28 35 24 Mega Ball", "$11M"), ("December 25", "1 2 3 4 5 <b>6</b> Mega Ball", "10 Million"),
        ("Dec 21", "7 8 9 10 11 12 Mega Ball", "1.2B"), ("December 18", "1 2 3 4 5 Mega Ball", "$1M"),
        ("December 14", "1 2 3 4 48 6 Mega Ball", "$1M"), ("someday", "1 2 3 4 5 6 Mega Ball", "$1M"),
    ]
    body = "".join("<tr>" + "".join(f"<td class='c'> {c} </td>" for c in r) + "</tr>" for r in rows)
    page = spark.createDataFrame([(2024, f"<html><table><tr><th>Date</th></tr>{body}</table></html>"), (2023, "<p>none</p>")], "year int, html string")
    got = [tuple(r)[1:] for r in parse_table_draws(page).orderBy("draw_date").collect()]
    assert got == [
        (date(2024, 12, 21), 7, 8, 9, 10, 11, 12, 1.2e9),
        (date(2024, 12, 25), 1, 2, 3, 4, 5, 6, 10e6),
        (date(2024, 12, 28), 6, 14, 22, 28, 35, 24, 11e6),
    ]


@pytest.mark.parametrize("items, special, odd, low, total", [
    ([3, 7, 12, 25, 36], 5, 3, 3, 83), ([2, 4, 8, 16, 32], 6, 0, 4, 62), ([1, 3, 5, 7, 9], 1, 5, 5, 25),
])
def test_patterns(spark, items, special, odd, low, total):
    row = spark.createDataFrame([(items, special)], "items array<int>, special int").select(*[c.alias(n) for n, c in patterns().items()]).first()
    assert (row["odd_count"], row["even_count"], row["low_count"], row["high_count"], row["white_sum"]) == (odd, 5 - odd, low, 5 - low, total)
    assert row["mega_is_odd"] == special % 2


@pytest.mark.parametrize("items, pairs, width", [
    ([1, 3, 5, 7, 9], 0, 8), ([1, 2, 5, 7, 9], 1, 8), ([7, 8, 12, 13, 20], 2, 13), ([5, 6, 7, 8, 9], 4, 4), ([1, 10, 20, 30, 47], 0, 46),
])
def test_consecutive_and_range(spark, items, pairs, width):
    row = spark.createDataFrame([(items, 1)], "items array<int>, special int").select(*[c.alias(n) for n, c in patterns().items()]).first()
    assert (row["consecutive_pairs"], row["number_range"]) == (pairs, width)


def test_frequency(spark):
    steps = [Step(0, 1, 0, [1, 2, 10, 20, 30], 1), Step(0, 2, 1, [1, 5, 15, 25, 35], 2), Step(0, 3, 2, [1, 10, 20, 30, 40], 3)]
    table = make_steps(spark, steps)
    counts = {r["item"]: r["appearances"] for r in frequency(table).collect()}
    assert (counts[1], counts[2], counts[47], sum(counts.values())) == (3, 1, 0, 15)
    recent = {r["item"]: r["appearances"] for r in frequency(table, 1).collect()}
    assert (recent[1], recent[10], recent[5]) == (1, 1, 0)


def test_upsert_is_idempotent_and_ordered(spark):
    schema = "draw_number long, jackpot double, machine string"
    empty = spark.createDataFrame([], schema)
    assert latest_key(empty, "draw_number").first()["latest"] == 0
    rows = spark.createDataFrame([(1003, None, "a"), (1001, None, "b"), (1002, 5e6, None)], schema)
    once = upsert(empty, [rows], ["draw_number"])
    twice = upsert(once, [rows, spark.createDataFrame([(1003, 1.0)], "draw_number long, jackpot double")], ["draw_number"])
    got = [tuple(r) for r in twice.orderBy("draw_number").collect()]
    assert got == [(1001, None, "b"), (1002, 5e6, None), (1003, 1.0, None)]
    assert latest_key(twice, "draw_number").first()["latest"] == 1003


def test_backfill_counts_down_from_the_newest(spark):
    stored = spark.createDataFrame([(5, date(2024, 1, 3)), (-1, date(2023, 12, 1))], "step_id long, ts date")
    scraped = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2)), (3, date(2024, 1, 3))], "_source_id long, ts date")
    got = {str(r["ts"]): r["step_id"] for r in backfill(stored, scraped).collect()}
    assert got == {"2024-01-02": -2, "2024-01-01": -3}


def test_sink_round_trip(spark, tmp_path):
    for fmt in ("csv", "json", "parquet"):
        path = str(tmp_path / fmt)
        for run in ("a", "b"):
            append_table(spark.createDataFrame([("m", 1.5)], "model string, ev double"), path, fmt, run)
        rows = read_table(spark, path, "model string, ev double, run string", fmt).orderBy("run").collect()
        assert [tuple(r) for r in rows] == [("m", 1.5, "a"), ("m", 1.5, "b")]


def test_payoffs(spark):
    row = spark.range(1).select(
        prize(F.lit(5), F.lit(True)), prize(F.lit(2), F.lit(False)), prize(F.lit(3), F.lit(False)), expected_prize(F.lit(0), 27),
        hits(F.array(*map(F.lit, (3, 7, 15, 22, 41))), F.array(*map(F.lit, (7, 12, 15, 33, 44)))),
    ).first()
    assert tuple(row) == (7000000.0, 0.0, 11.0, pytest.approx(1 / 27), 2)


@pytest.mark.parametrize("r, p", [
    (-0.01976086159151398, 0.0009228323359598782), (0.00972210005002366, 0.10313088899749313), (-0.002107712125303413, 0.7238340634346611),
])
def test_student_tail(r, p):
    n = 28106
    assert student_two_sided(r * ((n - 2) / (1 - r * r)) ** 0.5, n - 2) == pytest.approx(p, rel=1e-8)


def test_errors(spark):
    with pytest.raises(ValueError):
        scorer("no such scorer")
    dates = date_histogram(make_steps(spark, [Step(0, i, i, [1, 2, 3, 4, 5], 1) for i in range(10)]))
    with pytest.raises(ValueError):
        fold_windows(dates, step=0)
    with pytest.raises(ValueError):
        require_folds(dates, 24, 6)
