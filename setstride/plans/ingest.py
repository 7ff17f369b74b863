"""Queries over landing, cleaning, keyed snapshots and constraints."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from setstride.functions.arrays import not_among
from setstride.functions.casts import money, safe_float, safe_int
from setstride.plans.common import draws, query, table
from setstride.plans.sql import DRAWS, with_
from setstride.session import shared_folder
from setstride.sources import records
from setstride.sources.draws import draws_columns, draws_from_orders
from setstride.sources.html import elements, parse_table_draws
from setstride.sources.keyed import KeyedTable
from setstride.sources.store import Rules, append_table, backfill, before_old_page, latest_key, newer_than, prefer_official, read_table, violations

BAD = "CASE WHEN step_id % 73 = 0 THEN 'numbers missing' WHEN step_id % 97 = 0 THEN 'number out of range' WHEN step_id % 89 = 0 THEN 'special missing' WHEN step_id % 83 = 0 THEN 'count of numbers' WHEN step_id % 79 = 0 THEN 'draw date' END"


def landed_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The draws written as nested JSON pages (about 400 ids each), some records and one page broken on purpose, read back."""
    steps = draws_from_orders(spark, folder)
    k = F.col("step_id")
    numbers = F.when(k % 83 == 0, F.slice("items", 1, 4)).when(
        k % 97 == 0, F.concat(F.slice("items", 1, 4), F.array(F.lit(99)))
    ).otherwise(F.col("items"))
    balls = F.transform(numbers, lambda n, i: F.struct(i.cast("string"), F.struct(n.cast("string").alias("Number"), F.lit(False).alias("IsSpecial"))))
    special = F.array(F.struct(F.lit("5"), F.struct(F.col("special").cast("string").alias("Number"), F.lit(True).alias("IsSpecial"))))
    prizes = F.array(
        F.struct(F.lit("5 + Mega").alias("PrizeDescription"), (k % 3).cast("int").alias("NumberOfWinners"), F.lit(0).alias("Count"), F.col("amount").alias("PrizeAmount")),
        F.struct(F.lit("5 + 0").alias("PrizeDescription"), (k % 5).cast("int").alias("NumberOfWinners"), F.lit(7).alias("Count"), F.lit(25241.0).alias("PrizeAmount")),
    )
    raw = F.struct(
        k.alias("DrawNumber"),
        F.concat(F.when(k % 79 == 0, F.lit("no date")).otherwise(F.date_format("ts", "yyyy-MM-dd")), F.lit("T07:00:00")).alias("DrawDate"),
        F.map_from_entries(F.when(k % 89 == 0, balls).otherwise(F.concat(balls, special))).alias("WinningNumbers"),
        F.concat(F.lit("$"), F.col("amount").cast("decimal(18,2)").cast("string")).alias("JackpotAmount"),
        prizes.alias("PrizePayoutDetails"),
    )
    listed = F.struct(k.alias("DrawNumber"), F.date_format("ts", "yyyy-MM-dd").alias("DrawDate"), F.transform(numbers, lambda n: n.cast("string")).alias("WinningNumbers"))
    text = F.when(k % 73 == 0, F.to_json(listed)).otherwise(F.to_json(raw))
    pages = steps.groupBy(F.expr("step_id div 400").alias("p")).agg(F.array_join(F.collect_list(text), ",").alias("records"), F.count("*").alias("n"))
    lines = pages.select(F.concat(F.lit('{"PreviousDraws":['), F.col("records"), F.lit('],"TotalPreviousDraws":'), F.col("n").cast("string"), F.lit("}")).alias("value"))
    broken = steps.agg(F.concat(F.lit("<html>"), F.count("*").cast("string")).alias("value"))
    path = f"{shared_folder(spark)}/pages-{uuid.uuid4().hex}"
    lines.unionByName(broken).write.text(path)
    return records.read_pages(spark, path)


@query(
    "json_draws",
    with_(DRAWS, select=f"""
SELECT step_id AS draw_number, CAST(ts AS VARCHAR) AS draw_date, items[1] AS n1, items[2] AS n2, items[3] AS n3, items[4] AS n4,
       items[5] AS n5, special AS mega_number, round(amount, 2) AS jackpot_amount
FROM d WHERE {BAD} IS NULL"""),
)
def json_draws(spark, folder):
    return records.valid_draws(records.parse_draws(records.raw_records(landed_pages(spark, folder))))


QUARANTINE = """CASE WHEN step_id % 73 = 0 THEN 'numbers missing' WHEN step_id % 79 = 0 THEN 'draw date' WHEN step_id % 83 = 0 THEN 'count of numbers'
WHEN step_id % 89 = 0 THEN 'special missing' WHEN step_id % 97 = 0 THEN 'number out of range' END"""


@query("json_quarantine", with_(DRAWS, select=f"SELECT {QUARANTINE} AS reason, count(*) AS n FROM d WHERE {QUARANTINE} IS NOT NULL GROUP BY 1 UNION ALL SELECT 'page unreadable', 1"))
def json_quarantine(spark, folder):
    pages = landed_pages(spark, folder)
    rejected = records.quarantine(records.parse_draws(records.raw_records(pages))).unionByName(records.unreadable_pages(pages))
    return rejected.groupBy("reason").agg(F.count("*").alias("n"))


@query(
    "page_lineage",
    with_(DRAWS, select="""
SELECT CAST(0 AS BIGINT) AS broken, records, count(*) AS n FROM (SELECT count(*) AS records FROM d GROUP BY step_id // 400) GROUP BY records
UNION ALL SELECT 1, 0, 1"""),
)
def page_lineage(spark, folder):
    """How many pages hold how many records; one page is broken."""
    pages = landed_pages(spark, folder).withColumn("page", F.coalesce(F.concat_ws(",", F.slice("PreviousDraws", 1, 1)), F.lit("")))
    return records.page_report(pages).groupBy("broken", "records").agg(F.count("*").alias("n"))


@query(
    "json_prizes",
    with_(DRAWS, select=f"""
SELECT step_id AS draw_number, '5 + Mega' AS prize_description, CAST(step_id % 3 AS BIGINT) AS winner_count, round(amount, 6) AS prize_amount FROM d WHERE {BAD} IS NULL
UNION ALL SELECT step_id, '5 + 0', 7, 25241.0 FROM d WHERE {BAD} IS NULL"""),
)
def json_prizes(spark, folder):
    return records.draw_prizes(records.parse_draws(records.raw_records(landed_pages(spark, folder))))


@query(
    "html_table_draws",
    with_(DRAWS, select="""
SELECT CAST(ts AS VARCHAR) AS draw_date, items[1] AS n1, items[2] AS n2, items[3] AS n3, items[4] AS n4, items[5] AS n5,
       special AS mega_number, CAST(round(amount) AS BIGINT) * 1e6 AS jackpot_amount
FROM d WHERE step_id % 53 <> 0"""),
)
def html_table_draws(spark, folder):
    """The draws as HTML tables, one page per year and about 400 ids, parsed back; some rows hold a 48."""
    steps = draws_from_orders(spark, folder)
    shown = F.when(F.col("step_id") % 53 == 0, F.concat(F.slice("items", 1, 4), F.array(F.lit(48)))).otherwise(F.col("items"))
    row = F.concat(
        F.lit("<tr><td> "), F.date_format("ts", "MMMM d"), F.when(F.col("step_id") % 2 == 0, F.date_format("ts", ", yyyy")).otherwise(F.lit("")),
        F.lit("</td><td>"), F.array_join(F.transform(shown, lambda n: n.cast("string")), " "), F.lit(" <b>"), F.col("special").cast("string"),
        F.lit("</b> Mega Ball</td><td>$"), F.round("amount").cast("long").cast("string"), F.lit("M</td></tr>"),
    )
    pages = steps.groupBy(F.year("ts").alias("year"), F.expr("step_id div 400").alias("part")).agg(F.array_join(F.collect_list(row), "\n").alias("rows"))
    html = pages.select("year", F.concat(F.lit("<html><table class='x'><tr><th>Date</th></tr>"), F.col("rows"), F.lit("</table></html>")).alias("html"))
    return parse_table_draws(html).drop("draw_number")


@query(
    "page_elements",
    r"""SELECT page_id, CAST(len(regexp_extract_all(html, '(?is)<a(?:\s[^>]*)?>(.*?)</a\s*>', 1)) AS BIGINT) AS links,
       CAST(len(regexp_extract_all(html, '(?is)<p(?:\s[^>]*)?>(.*?)</p\s*>', 1)) AS BIGINT) AS paragraphs,
       coalesce(regexp_extract_all(html, '(?is)<a(?:\s[^>]*)?>(.*?)</a\s*>', 1)[1], '') AS first_link FROM pages""",
)
def page_elements(spark, folder):
    html = F.col("html")
    links = elements(html, "a")
    return table(spark, folder, "pages").select(
        "page_id", F.size(links).alias("links"), F.size(elements(html, "p")).alias("paragraphs"),
        F.coalesce(F.get(links, F.lit(0)), F.lit("")).alias("first_link"),
    )


@query(
    "safe_casts",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE round(CAST(round(o_totalprice * 100) AS BIGINT) / 100.0, 6) END AS amount,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS whole FROM orders""",
)
def safe_casts(spark, folder):
    k, cents = F.col("o_orderkey"), F.round(F.col("o_totalprice") * 100).cast("long")
    orders = table(spark, folder, "orders").withColumn("_c", cents)
    tail = F.concat(F.lpad(F.expr("_c div 100 % 1000").cast("string"), 3, "0"), F.lit("."), F.lpad((F.col("_c") % 100).cast("string"), 2, "0"))
    shown = F.when(k % 7 == 0, F.lit("N/A")).otherwise(F.concat(F.lit("$ "), F.expr("_c div 100000").cast("string"), F.lit(","), tail, F.lit(" ")))
    number = F.when(k % 5 == 0, F.lit("none")).otherwise(F.concat(F.lit(" "), F.col("o_custkey").cast("string")))
    return orders.select("o_orderkey", safe_float(shown).alias("amount"), safe_int(number).alias("whole"))


@query(
    "money_text",
    """SELECT o_orderkey, round((CAST(round(o_totalprice) AS BIGINT) % 1000) / 10.0 *
       CASE o_orderkey % 4 WHEN 0 THEN 1e6 WHEN 1 THEN 1e6 WHEN 2 THEN 1e9 ELSE 1 END, 6) AS amount FROM orders""",
)
def money_text(spark, folder):
    orders = table(spark, folder, "orders").withColumn("_t", F.round("o_totalprice").cast("long") % 1000)
    value = F.concat(F.expr("_t div 10").cast("string"), F.lit("."), (F.col("_t") % 10).cast("string"))
    k = F.col("o_orderkey") % 4
    unit = F.when(k == 0, "M").when(k == 1, " Million").when(k == 2, "B").otherwise("")
    return orders.select("o_orderkey", money(F.concat(F.lit("$"), value, unit)).alias("amount"))


@query(
    "constraint_violations",
    """SELECT 'not null o_orderdate' AS rule, count(*) FILTER (o_orderdate IS NULL) AS violations FROM orders
UNION ALL SELECT 'not null o_totalprice', count(*) FILTER (o_totalprice IS NULL) FROM orders
UNION ALL SELECT 'check price range', count(*) FILTER (NOT (o_totalprice BETWEEN 1000 AND 90000)) FROM orders
UNION ALL SELECT 'unique o_orderkey', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'unique o_custkey, o_orderdate', count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1)
UNION ALL SELECT 'foreign o_custkey', count(*) FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 3)""",
)
def constraint_violations(spark, folder):
    rules = Rules(
        not_null=("o_orderdate", "o_totalprice"),
        checks=(("price range", F.col("o_totalprice").between(1000, 90000)),),
        unique=(("o_orderkey",), ("o_custkey", "o_orderdate")),
        foreign=(("o_custkey", table(spark, folder, "customer").where(F.col("c_custkey") % 10 != 3), "c_custkey"),),
    )
    return violations(table(spark, folder, "orders"), rules)


@query(
    "upsert_orders",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
       round(CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 2 WHEN o_orderkey % 2 = 0 THEN o_totalprice + 1 ELSE o_totalprice END, 6) AS o_totalprice
FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0 OR o_orderkey % 5 = 0""",
)
def upsert_orders(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    k = F.col("o_orderkey")
    first = orders.where(k % 2 == 0).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    second = orders.where(k % 5 == 0).select("o_orderkey", (F.col("o_totalprice") + 2).alias("o_totalprice"))
    held = KeyedTable(spark, f"{shared_folder(spark)}/orders-{uuid.uuid4().hex}", orders.schema, ("o_orderkey",), 16)
    for batch in (orders.where(k % 3 != 0), first, second):
        held.upsert(batch)
    return held.read()


@query(
    "upsert_few_keys",
    """SELECT o_orderkey, o_custkey, round(CASE WHEN o_orderkey IN (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 3) THEN -o_totalprice ELSE o_totalprice END, 6) AS o_totalprice FROM orders""",
)
def upsert_few_keys(spark, folder):
    """The three dearest orders are written anew: only their buckets are read and written."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    held = KeyedTable(spark, f"{shared_folder(spark)}/orders-{uuid.uuid4().hex}", orders.schema, ("o_orderkey",), 16)
    held.upsert(orders)
    dearest = orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(3)
    held.upsert(dearest.withColumn("o_totalprice", -F.col("o_totalprice")))
    return held.read()


@query(
    "incremental_pages",
    """WITH p AS (SELECT o_orderkey, o_totalprice, (SELECT max(o_orderkey) FROM orders) // 100 - o_orderkey // 100 AS page FROM orders),
b AS (SELECT max(o_orderkey) AS k FROM orders WHERE o_orderkey <= (SELECT max(o_orderkey) // 2 FROM orders))
SELECT o_orderkey, page, round(o_totalprice, 6) AS o_totalprice FROM p, b WHERE o_orderkey > k AND page <= (SELECT min(page) FROM p, b WHERE o_orderkey <= k)""",
)
def incremental_pages(spark, folder):
    """Orders in pages of a hundred keys, newest first, up to the first page with a stored one."""
    orders = table(spark, folder, "orders")
    top = orders.agg(F.max("o_orderkey")).first()[0]
    pages = orders.withColumn("page", F.lit(top // 100) - F.expr("o_orderkey div 100"))
    return before_old_page(pages, orders.where(F.col("o_orderkey") <= top // 2), "o_orderkey", "page").select("o_orderkey", "page", "o_totalprice")


@query("items_not_drawn", with_(DRAWS, select="SELECT ord, array_to_string([x FOR x IN range(1, 48) IF NOT list_contains(items, x)], ' ') AS others FROM d"))
def items_not_drawn(spark, folder):
    """The complement of every step's items."""
    t = draws(spark, folder)
    return t.df.select("ord", not_among(F.col("items"), t.domain.items).alias("others"))


@query(
    "incremental_orders",
    """SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice FROM orders
WHERE o_orderkey > (SELECT max(o_orderkey) FROM orders WHERE o_orderkey <= (SELECT max(o_orderkey) // 2 FROM orders))""",
)
def incremental_orders(spark, folder):
    orders = table(spark, folder, "orders")
    half = orders.agg(F.expr("max(o_orderkey) div 2")).first()[0]
    return newer_than(orders, orders.where(F.col("o_orderkey") <= half), "o_orderkey").select("o_orderkey", "o_totalprice")


BACKFILL_SQL = with_(DRAWS, select="""
, stored AS (SELECT * FROM d WHERE month(ts) % 2 = 0),
scraped AS (SELECT * FROM d WHERE step_id % 3 = 0)
SELECT -row_number() OVER (ORDER BY ts DESC, step_id DESC) AS step_id, step_id AS source_id, CAST(ts AS VARCHAR) AS ts
FROM scraped WHERE ts NOT IN (SELECT ts FROM stored)""").replace("FROM d)\n, stored", "FROM d),\nstored")


def _backfilled(spark, folder):
    steps = draws_from_orders(spark, folder)
    stored = steps.where(F.month("ts") % 2 == 0)
    scraped = steps.where(F.col("step_id") % 3 == 0).withColumn("_source_id", F.col("step_id"))
    return stored, backfill(stored, scraped)


@query("backfill_draws", BACKFILL_SQL)
def backfill_draws(spark, folder):
    return _backfilled(spark, folder)[1].select("step_id", F.col("_source_id").alias("source_id"), "ts")


@query(
    "official_first",
    with_(DRAWS, """stored AS (SELECT step_id, ts FROM d WHERE month(ts) % 2 = 0),
filled AS (SELECT -row_number() OVER (ORDER BY ts DESC, step_id DESC) AS step_id, ts FROM d WHERE step_id % 3 = 0),
both_ AS (SELECT * FROM stored UNION ALL SELECT * FROM filled)""", select="""
SELECT CAST(ts AS VARCHAR) AS ts, max(step_id) AS step_id FROM both_ GROUP BY ts"""),
)
def official_first(spark, folder):
    steps = draws_from_orders(spark, folder)
    stored = steps.where(F.month("ts") % 2 == 0).select("step_id", "ts")
    scraped = steps.where(F.col("step_id") % 3 == 0).select("step_id", "ts").withColumn("_source_id", F.col("step_id"))
    filled = backfill(stored.limit(0), scraped).select("step_id", "ts")
    return prefer_official(stored.unionByName(filled))


@query("latest_and_count", "SELECT coalesce(max(o_orderkey), 0) AS latest, count(*) AS n_rows FROM orders")
def latest_and_count(spark, folder):
    return latest_key(table(spark, folder, "orders"), "o_orderkey")


FLAT = """step_id AS draw_number, CAST(ts AS VARCHAR) AS draw_date, items[1] AS n1, items[2] AS n2, items[3] AS n3,
items[4] AS n4, items[5] AS n5, special AS mega_number, round(amount, 6) AS jackpot_amount"""


@query("all_draws", with_(DRAWS, select=f"SELECT {FLAT} FROM d ORDER BY step_id"))
def all_draws(spark, folder):
    return draws_columns(draws_from_orders(spark, folder)).orderBy("draw_number")


@query("recent_draws", with_(DRAWS, select=f"SELECT {FLAT} FROM d WHERE ts >= DATE '2000-01-01'"))
def recent_draws(spark, folder):
    return draws_columns(draws_from_orders(spark, folder).where(F.col("ts") >= F.lit("2000-01-01").cast("date")))


@query(
    "csv_round_trip",
    """SELECT o_orderstatus AS status, o_orderpriority AS priority, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY ALL""",
)
def csv_round_trip(spark, folder):
    """Append a summary to a CSV table twice (two runs), read one run back."""
    summary = table(spark, folder, "orders").groupBy(
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")
    ).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    path = f"{shared_folder(spark)}/summary-{uuid.uuid4().hex}"
    for run in ("first", "second"):
        append_table(summary, path, run=run)
    back = read_table(spark, path, "status string, priority string, n long, total double, run string")
    return back.where("run = 'second'").drop("run")
