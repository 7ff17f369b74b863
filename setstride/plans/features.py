"""Queries over step features, per-item state, pairs and label signal."""

from __future__ import annotations

from pyspark.sql import functions as F

from setstride.functions.arrays import multihot
from setstride.operators import signal
from setstride.operators.layout import SERIES
from setstride.operators.pairs import basket_pairs, context_state, cooccurrence, sparse_transitions, transition_matrix
from setstride.operators.patterns import PATTERNS, ROLLED, draw_features, last_step_features, rolling_features, sequence_windows
from setstride.operators.state import (
    as_of_previous, average_gap, ball_stats, current_gap, frequency, gap_stats, item_grid, item_part, slot_state, sparse_gaps, step_items,
)
from setstride.plans.common import draws, numbered_events, query, table, without_series
from setstride.plans.sql import DRAWS, GRID, STATE, student_p, text, with_
from setstride.sources.draws import draws_columns, draws_from_orders

FEATURE_SQL = """
list_sum(items) AS white_sum, round(list_sum(items) / 5.0, 2) AS white_mean,
len([x FOR x IN items IF x % 2 = 1]) AS odd_count, 5 - len([x FOR x IN items IF x % 2 = 1]) AS even_count,
len([x FOR x IN items IF x <= 23]) AS low_count, 5 - len([x FOR x IN items IF x <= 23]) AS high_count,
len([j FOR j IN range(1, 5) IF items[j + 1] - items[j] = 1]) AS consecutive_pairs, items[5] - items[1] AS number_range,
len(list_distinct([x % 10 FOR x IN items])) AS unique_last_digits, special % 2 AS mega_is_odd
"""
LONGS = "CAST({0} AS BIGINT) AS {0}"
FEATURES = f"ft AS MATERIALIZED (SELECT ord, step_id, ts, items, special, {FEATURE_SQL} FROM d)"
FEATURE_COLS = ", ".join("white_mean" if p == "white_mean" else LONGS.format(p) for p in PATTERNS)


@query("draw_features", with_(DRAWS, FEATURES, select=f"SELECT step_id AS draw_number, {FEATURE_COLS} FROM ft"))
def _(spark, folder):
    return draw_features(draws_from_orders(spark, folder))


@query("draws_with_features", with_(DRAWS, FEATURES, select=f"""
SELECT d.step_id AS draw_number, CAST(d.ts AS VARCHAR) AS draw_date, d.items[1] AS n1, d.special AS mega_number, f.*
FROM d LEFT JOIN (SELECT step_id AS fid, {FEATURE_COLS} FROM ft WHERE step_id % 4 <> 0) f ON d.step_id = f.fid""").replace("f.*", ", ".join(f"f.{p}" for p in PATTERNS)))
def _(spark, folder):
    steps = draws_from_orders(spark, folder)
    stored = draw_features(steps.where(F.col("step_id") % 4 != 0))
    flat = draws_columns(steps).select("draw_number", "draw_date", "n1", "mega_number")
    return flat.join(stored, "draw_number", "left")


@query("new_dates", with_(DRAWS, select="""
SELECT step_id, CAST(ts AS VARCHAR) AS ts FROM d WHERE step_id % 2 = 0 AND ts NOT IN (SELECT ts FROM d WHERE step_id % 2 = 1)"""))
def _(spark, folder):
    steps = draws_from_orders(spark, folder).select("step_id", "ts")
    known = steps.where(F.col("step_id") % 2 == 1).select("ts").distinct()
    return steps.where(F.col("step_id") % 2 == 0).join(known, "ts", "left_anti").select("step_id", "ts")


@query("multi_hot", with_(DRAWS, GRID, select=f"SELECT ord, {text('list(y ORDER BY item)')} AS label FROM g GROUP BY ord"))
def _(spark, folder):
    t = draws(spark, folder)
    return t.df.select("ord", multihot(F.col("items"), t.domain.items).alias("label"))


@query("last_step_grid", with_(DRAWS, GRID, select="""
SELECT g.ord, CAST(g.item AS BIGINT) AS item, CAST(y AS BIGINT) AS y, CAST(list_sum(p.items) AS BIGINT) AS last_sum,
 CAST(len([x FOR x IN p.items IF x % 2 = 1]) AS BIGINT) AS last_odd_cnt, CAST(len([x FOR x IN p.items IF x > 23]) AS BIGINT) AS last_high_cnt,
 CAST(len([j FOR j IN range(1, 5) IF p.items[j + 1] - p.items[j] = 1]) AS BIGINT) AS last_consec,
 g.item % 2 AS ball_is_odd, (g.item - 1) // 10 AS ball_zone
FROM g JOIN d p ON p.ord = g.ord - 1"""))
def _(spark, folder):
    t = draws(spark, folder)
    last = last_step_features(F.col("prev_items"))
    rows = t.df.where(F.col("prev_items").isNotNull()).select("ord", "items", *[c.alias(n) for n, c in last.items()])
    grid = item_grid(rows, t, {"n": F.sequence(F.lit(1), F.lit(t.domain.items))}, ["ord", *last])
    return grid.select("ord", "item", "y", *last, (F.col("item") % 2).alias("ball_is_odd"), F.expr("(item - 1) div 10").alias("ball_zone"))


@query("step_ordinals", with_(DRAWS, select="SELECT step_id, ord FROM d"))
def _(spark, folder):
    return draws(spark, folder).df.select("step_id", "ord")


@query("event_ordinals", "SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS ord FROM events")
def _(spark, folder):
    return numbered_events(spark, folder)[0].select("event_id", F.col(SERIES).alias("user_id"), "ord")


@query("item_frequency", with_(DRAWS, select="""
SELECT nums.item, count(li.ord) AS appearances, count(li.ord) FILTER (li.ord >= len.n - 50) AS recent
FROM nums CROSS JOIN len LEFT JOIN li ON li.item = nums.item GROUP BY nums.item"""))
def _(spark, folder):
    t = draws(spark, folder)
    recent = frequency(t, 50).select(SERIES, "item", F.col("appearances").alias("recent"))
    return without_series(frequency(t).join(recent, [SERIES, "item"]))


@query("special_frequency", with_(DRAWS, select="SELECT mnums.item, count(d.ord) AS appearances FROM mnums LEFT JOIN d ON d.special = mnums.item GROUP BY 1"))
def _(spark, folder):
    return without_series(frequency(draws(spark, folder), specials=True))


def gaps_sql(source: str, numbers: str) -> str:
    return with_(DRAWS, f"""
gp AS (SELECT *, ord - lag(ord) OVER (PARTITION BY item ORDER BY ord) AS gap FROM {source}),
ag AS (SELECT item, count(*) AS appearances, avg(gap) AS avg_gap, max(gap) AS max_gap, min(gap) AS min_gap, max(ord) AS last_ord,
       min(ord) AS first_ord, arg_max(step_id, ord) AS last_step, max(ts) AS last_ts FROM gp GROUP BY item)""", select=f"""
SELECT n.item, coalesce(appearances, 0) AS appearances, round(avg_gap, 6) AS avg_gap, max_gap, min_gap,
       len.n - 1 - coalesce(last_ord, -1) AS current_gap, last_step AS last_seen_step, CAST(last_ts AS VARCHAR) AS last_seen_date
FROM {numbers} n CROSS JOIN len LEFT JOIN ag USING (item)""")


BALL_COLUMNS = ["item", "appearances", "avg_gap", "max_gap", "min_gap", "current_gap", "last_seen_step", "last_seen_date"]


@query("item_gap_stats", gaps_sql("li", "nums"))
def _(spark, folder):
    return ball_stats(draws(spark, folder)).select(*BALL_COLUMNS)


@query("special_gap_stats", gaps_sql("(SELECT ord, step_id, ts, special AS item FROM d)", "mnums"))
def _(spark, folder):
    return ball_stats(draws(spark, folder), specials=True).select(*BALL_COLUMNS)


@query("current_and_average_gap", with_(DRAWS, "ag AS (SELECT item, max(ord) AS l, min(ord) AS f, count(*) AS c FROM li GROUP BY item)", select="""
SELECT nums.item, n - 1 - coalesce(l, -1) AS current_gap, round(CASE WHEN c > 1 THEN CAST(l - f AS DOUBLE) / (c - 1) ELSE n END, 6) AS avg_gap
FROM nums CROSS JOIN len LEFT JOIN ag USING (item)"""))
def _(spark, folder):
    t = draws(spark, folder)
    seen = step_items(t).groupBy(SERIES, "item").agg(F.max("ord").alias("l"), F.min("ord").alias("f"), F.count("*").alias("c"))
    from setstride.operators.state import dense_items, series_length

    full = dense_items(t, series_length(t)).join(seen, [SERIES, "item"], "left")
    return full.select(
        "item",
        (F.col("n_steps") - 1 - F.coalesce("l", F.lit(-1))).alias("current_gap"),
        F.when(F.col("c") > 1, (F.col("l") - F.col("f")) / (F.col("c") - 1)).otherwise(F.col("n_steps").cast("double")).alias("avg_gap"),
    )


@query("gap_history", with_(DRAWS, select="""
SELECT ball_type, CAST(item AS BIGINT) AS item, step_id AS draw_number, gap FROM (
 SELECT 'white' AS ball_type, item, step_id, ord - lag(ord) OVER (PARTITION BY item ORDER BY ord) AS gap FROM li
 UNION ALL SELECT 'mega', special, step_id, ord - lag(ord) OVER (PARTITION BY special ORDER BY ord) FROM d) WHERE gap IS NOT NULL"""))
def _(spark, folder):
    t = draws(spark, folder)
    parts = [
        sparse_gaps(step_items(t, s), t.block).where(F.col("gap").isNotNull()).select(
            F.lit(kind).alias("ball_type"), "item", F.col("step_id").alias("draw_number"), "gap"
        )
        for kind, s in (("white", False), ("mega", True))
    ]
    return parts[0].unionByName(parts[1])


EVENTS_SQL = "ev AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS ord FROM events)"


@query("event_gap_stats", with_(EVENTS_SQL, "gp AS (SELECT *, ord - lag(ord) OVER (PARTITION BY user_id, event_type ORDER BY ord) AS gap FROM ev)", select="""
SELECT user_id, event_type, count(*) AS appearances, max(ord) AS last_ord, min(ord) AS first_ord, round(avg(gap), 6) AS avg_gap,
       max(gap) AS max_gap, min(gap) AS min_gap FROM gp GROUP BY ALL"""))
def _(spark, folder):
    rows, size = numbered_events(spark, folder)
    return gap_stats(rows, size).withColumnsRenamed({SERIES: "user_id", "item": "event_type"})


@query("events_as_of_view", with_(EVENTS_SQL, """
vw AS (SELECT *, max(CASE WHEN event_type = 'view' THEN ord END) OVER (PARTITION BY user_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS vo FROM ev)""", select="""
SELECT e.event_id, e.user_id, e.ord, v.event_id AS prev_view, round(v.value, 6) AS prev_value
FROM vw e LEFT JOIN ev v ON v.user_id = e.user_id AND v.ord = e.vo WHERE e.event_type = 'click'"""))
def _(spark, folder):
    rows, size = numbered_events(spark, folder)
    is_view = F.col("item") == "view"
    payload = {"view": F.when(is_view, F.col("event_id")), "value": F.when(is_view, F.col("value"))}
    return as_of_previous(rows, F.col("item") == "click", payload, size).select(
        "event_id", F.col(SERIES).alias("user_id"), "ord", "prev_view", "prev_value"
    )


@query("state_as_of_step", with_(DRAWS, GRID, STATE, """
gq AS (SELECT ord, item, ord - lag(ord) OVER (PARTITION BY item ORDER BY ord) AS gap FROM g WHERE y = 1),
gs AS (SELECT g.ord, g.item, coalesce(sum(gap * gap) OVER (PARTITION BY g.item ORDER BY g.ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gsq
       FROM g LEFT JOIN gq USING (ord, item))""", select="""
SELECT ord, item, y, cnt, last, gap, round(avg_gap, 6) AS avg_gap,
       round(CASE WHEN cnt > 1 THEN sqrt(greatest(CAST(gsq AS DOUBLE) / (cnt - 1) - avg_gap * avg_gap, 0)) ELSE 0 END, 6) AS std_gap
FROM st JOIN gs USING (ord, item)""").replace("SELECT ord, item, y, cnt, last, gap,", "SELECT ord, item, CAST(y AS BIGINT) AS y, CAST(cnt AS BIGINT) AS cnt, last, gap,"))
def _(spark, folder):
    t = draws(spark, folder)
    state = slot_state(t, (), ("cnt", "last", "first", "gsq"))
    cnt, last, first, gsq = (item_part(t, n) for n in ("cnt", "last", "first", "gsq"))
    grid = item_grid(state, t, {"cnt": cnt, "last": last, "gap": current_gap(last), "avg_gap": average_gap(cnt, last, first), "gsq": gsq}, ["ord"])
    spread = F.sqrt(F.greatest(F.col("gsq") / (F.col("cnt") - 1) - F.col("avg_gap") * F.col("avg_gap"), F.lit(0.0)))
    return grid.withColumn("std_gap", F.when(F.col("cnt") > 1, spread).otherwise(0.0)).drop("gsq")


@query("rolling_counts", with_(DRAWS, GRID, STATE, select="SELECT ord, item, " + ", ".join(f"CAST(r{w} AS BIGINT) AS r{w}" for w in (5, 10, 20, 30, 50, 100)) + " FROM st"))
def _(spark, folder):
    t = draws(spark, folder)
    windows = (5, 10, 20, 30, 50, 100)
    return item_grid(slot_state(t, windows, ()), t, {f"r{w}": item_part(t, f"r{w}") for w in windows}, ["ord"]).drop("y")


def rolled_sql(frame: str, need: int) -> str:
    cols = ", ".join(
        f"CASE WHEN ord >= {need} THEN round({f}({c}) OVER w, 6) END AS {c}_roll10_{n}" for c in ROLLED for n, f in (("mean", "avg"), ("std", "stddev_samp"))
    )
    return with_(DRAWS, FEATURES, select=f"SELECT ord, {cols} FROM ft WINDOW w AS (ORDER BY ord ROWS BETWEEN {frame})")


@query("rolling_features", rolled_sql("10 PRECEDING AND 1 PRECEDING", 10))
def _(spark, folder):
    return rolling_features(draws(spark, folder)).drop(SERIES, "step_id", "ts", "items", "special")


@query("rolling_features_inclusive", rolled_sql("9 PRECEDING AND CURRENT ROW", 9))
def _(spark, folder):
    return rolling_features(draws(spark, folder), include_current=True).drop(SERIES, "step_id", "ts", "items", "special")


@query("sequence_windows", with_(DRAWS, select="""
SELECT ord, array_to_string([array_to_string(p, ' ') FOR p IN past], ';') AS past FROM (
 SELECT ord, list(items) OVER (ORDER BY ord ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS past FROM d) WHERE len(past) = 20"""))
def _(spark, folder):
    rows = sequence_windows(draws(spark, folder))
    past = F.array_join(F.transform("past", lambda p: F.array_join(F.transform(p, lambda n: n.cast("string")), " ")), ";")
    return rows.select("ord", past.alias("past"))


# --- pairs


@query("cooccurrence", with_(DRAWS, "pr AS (SELECT a.item AS a, b.item AS b, count(*) AS n FROM li a JOIN li b ON a.ord = b.ord AND a.item < b.item GROUP BY ALL)", select="""
SELECT a, b, n, round(CAST(n AS DOUBLE) / max(n) OVER (), 6) AS share FROM pr"""))
def _(spark, folder):
    return without_series(cooccurrence(draws(spark, folder).df))


@query("brand_cooccurrence", with_("""
bk AS (SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey),
pr AS (SELECT x.p_brand AS a, y.p_brand AS b, count(*) AS n FROM bk x JOIN bk y ON x.l_orderkey = y.l_orderkey AND x.p_brand < y.p_brand GROUP BY ALL)""", select="""
SELECT a, b, n, round(CAST(n AS DOUBLE) / max(n) OVER (), 6) AS share FROM pr"""))
def _(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_brand")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    joined = lines.join(parts, lines.l_partkey == parts.p_partkey)
    return without_series(basket_pairs(joined, "l_orderkey", "p_brand"))


def transitions_sql(source: str, numbers: str, width: int) -> str:
    return with_(DRAWS, f"tc AS (SELECT a.item AS f, b.item AS t, count(*) AS n FROM {source} a JOIN {source} b ON b.ord = a.ord + 1 GROUP BY ALL)", select=f"""
SELECT x.item AS from_item, y.item AS to_item, coalesce(n, 0) AS n,
 round(CASE WHEN sum(n) OVER (PARTITION BY x.item) > 0 THEN CAST(coalesce(n, 0) AS DOUBLE) / sum(n) OVER (PARTITION BY x.item) ELSE 1.0 / {width} END, 6) AS prob
FROM {numbers} x CROSS JOIN {numbers} y LEFT JOIN tc ON tc.f = x.item AND tc.t = y.item""")


@query("transition_matrix", transitions_sql("li", "nums", 47))
def _(spark, folder):
    return without_series(transition_matrix(draws(spark, folder)))


@query("special_transitions", transitions_sql("(SELECT ord, special AS item FROM d)", "mnums", 27))
def _(spark, folder):
    return without_series(transition_matrix(draws(spark, folder), specials=True))


@query("event_transitions", with_(EVENTS_SQL, "mv AS (SELECT lag(event_type) OVER (PARTITION BY user_id ORDER BY ord) AS f, event_type AS t FROM ev)", select="""
SELECT f AS from_item, t AS to_item, n, round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY f), 6) AS prob
FROM (SELECT f, t, count(*) AS n FROM mv WHERE f IS NOT NULL GROUP BY f, t)"""))
def _(spark, folder):
    rows, size = numbered_events(spark, folder)
    return sparse_transitions(rows, size)


COOC_SQL = """
ct AS (SELECT li.ord + 1 AS ord, li.item AS c FROM li WHERE li.ord + 1 < (SELECT n FROM len)),
cv AS (SELECT ct.ord, ct.c, g.item, CASE WHEN g.item = ct.c THEN 0 ELSE g.y END AS y FROM ct JOIN g ON g.ord = ct.ord - 1),
cw AS (SELECT ord, item, sum(y) OVER (PARTITION BY c, item ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seen FROM cv),
co AS MATERIALIZED (SELECT ord, item, CAST(sum(seen) AS BIGINT) AS cooc FROM cw GROUP BY ord, item)
"""


@query("cooccurrence_with_last", with_(DRAWS, GRID, COOC_SQL, select="SELECT ord, item, cooc, round(CAST(cooc AS DOUBLE) / ord, 6) AS cooccur_last FROM co"))
def _(spark, folder):
    t = draws(spark, folder)
    grid = item_grid(context_state(t, "same"), t, {"cooc": F.transform("score", lambda x: x.cast("long"))}, ["ord"])
    return grid.select("ord", "item", "cooc", (F.col("cooc") / F.col("ord")).alias("cooccur_last"))


# --- signal

SIGNAL = """
gq AS (SELECT ord, item, ord - lag(ord) OVER (PARTITION BY item ORDER BY ord) AS dist FROM g WHERE y = 1),
gs AS (SELECT g.ord, g.item, coalesce(sum(dist * dist) OVER (PARTITION BY g.item ORDER BY g.ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gsq
       FROM g LEFT JOIN gq USING (ord, item)),
pv AS (SELECT d.ord, p.items AS li1, coalesce(q.items, []) AS li2 FROM d JOIN d p ON p.ord = d.ord - 1 LEFT JOIN d q ON q.ord = d.ord - 2),
fx AS MATERIALIZED (
 SELECT st.ord, st.item, st.y, CAST(gap AS DOUBLE) AS current_gap, avg_gap,
  CASE WHEN avg_gap > 0 THEN gap / avg_gap ELSE 1.0 END AS gap_ratio,
  CASE WHEN cnt > 1 THEN (gap - avg_gap) / greatest(sqrt(greatest(CAST(gsq AS DOUBLE) / (cnt - 1) - avg_gap * avg_gap, 0)), 1) ELSE 0.0 END AS gap_zscore,
  r5 / 5.0 AS freq_5, r10 / 10.0 AS freq_10, r30 / 30.0 AS freq_30, CAST(r100 AS DOUBLE) / least(100, st.ord) AS freq_100,
  CAST(r5 AS DOUBLE) / 5 / greatest(CAST(r30 AS DOUBLE) / 30, 1e-6) AS freq_ratio_5_30,
  CASE WHEN list_contains(li1, st.item) THEN 1e0 ELSE 0e0 END AS appeared_last,
  CASE WHEN list_contains(li2, st.item) THEN 1e0 ELSE 0e0 END AS appeared_prev2,
  CASE WHEN st.ord >= 2 THEN CAST(cooc AS DOUBLE) / st.ord ELSE 0.0 END AS cooccur_last,
  CAST(list_sum(li1) AS DOUBLE) AS last_sum, CAST(len([x FOR x IN li1 IF x % 2 = 1]) AS DOUBLE) AS last_odd_cnt,
  CAST(len([x FOR x IN li1 IF x > 23]) AS DOUBLE) AS last_high_cnt,
  CAST(len([j FOR j IN range(1, 5) IF li1[j + 1] - li1[j] = 1]) AS DOUBLE) AS last_consec,
  CAST(st.item % 2 AS DOUBLE) AS ball_is_odd, CAST((st.item - 1) // 10 AS DOUBLE) AS ball_zone
 FROM st JOIN gs USING (ord, item) JOIN co USING (ord, item) JOIN pv USING (ord)
 WHERE st.ord >= 50 AND st.ord < (SELECT n FROM len))
"""
SIGNAL_PARTS = [DRAWS, GRID, STATE, COOC_SQL, SIGNAL]


@query("feature_grid", with_(*SIGNAL_PARTS, select="SELECT ord, item, CAST(y AS BIGINT) AS y, " + ", ".join(f"round({f}, 6) + 0.0 AS {f}" for f in signal.FEATURES) + " FROM fx"))
def _(spark, folder):
    return without_series(signal.feature_grid(draws(spark, folder)))


CORR_SQL = with_(*SIGNAL_PARTS, "up AS (" + " UNION ALL ".join(f"SELECT '{f}' AS feature, {f} AS x, y FROM fx" for f in signal.FEATURES) + """),
ag AS (SELECT feature, count(*) AS n, corr(x, y) AS r, avg(x) FILTER (y = 1) AS p, avg(x) FILTER (y = 0) AS q FROM up GROUP BY feature)""", select="""
SELECT feature, round(r, 6) + 0.0 AS corr, round(abs(r), 6) + 0.0 AS abs_corr, round(r * sqrt(n - 2) / sqrt(1 - r * r), 4) + 0.0 AS t_stat,
       round(p, 4) AS mean_appear, round(q, 4) AS mean_not_app, n FROM ag""")


@query("feature_correlations", CORR_SQL)
def _(spark, folder):
    out = signal.grid_correlations(draws(spark, folder))
    return out.withColumn("t_stat", F.round("t_stat", 4) + F.lit(0.0)).drop("p_value", "sig", "delta")


SIGNIFICANCE_SQL = CORR_SQL[: CORR_SQL.rindex("SELECT feature")] + f"""SELECT feature, corr, abs_corr, t_stat, round(p, 6) + 0.0 AS p_value, mean_appear, mean_not_app, delta,
 CASE WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**' WHEN p < 0.05 THEN '*' ELSE '' END AS sig, n FROM (
 SELECT *, {student_p('t', '(n - 2)')} AS p FROM (
  SELECT feature, round(r, 6) + 0.0 AS corr, round(abs(r), 6) + 0.0 AS abs_corr, r * sqrt(n - 2) / sqrt(1 - r * r) AS t, round(r * sqrt(n - 2) / sqrt(1 - r * r), 4) + 0.0 AS t_stat,
         round(p, 4) AS mean_appear, round(q, 4) AS mean_not_app, round(round(p, 4) - round(q, 4), 4) + 0.0 AS delta, n FROM ag))"""


@query("feature_significance", SIGNIFICANCE_SQL)
def _(spark, folder):
    out = signal.grid_correlations(draws(spark, folder))
    return out.withColumn("t_stat", F.round("t_stat", 4) + F.lit(0.0)).withColumn("delta", F.round(F.round("mean_appear", 4) - F.round("mean_not_app", 4), 4) + F.lit(0.0))


def response_sql(bins: str) -> str:
    return with_(*SIGNAL_PARTS, select=f"SELECT bin, round(avg(y), 6) AS rate, count(*) AS n FROM (SELECT {bins} AS bin, y FROM fx) GROUP BY bin")


def bins_sql(c: str, edges: list[float]) -> str:
    return f"CASE WHEN {c} <= {edges[0]} THEN CAST(-1 AS BIGINT) " + " ".join(f"WHEN {c} <= {e} THEN CAST({i} AS BIGINT)" for i, e in enumerate(edges[1:])) + f" WHEN {c} IS NOT NULL THEN -1 END"


GAP_EDGES, FREQ_EDGES = [0, 0.5, 1.0, 1.5, 2.0, 99], [0, 0.5, 1.0, 2.0, 5.0, 99]


@query("response_by_last", response_sql("CAST(appeared_last AS BIGINT)"))
def _(spark, folder):
    return signal.grid_response(draws(spark, folder), "appeared_last")


@query("response_by_gap_ratio", response_sql(bins_sql("gap_ratio", GAP_EDGES)))
def _(spark, folder):
    return signal.grid_response(draws(spark, folder), "gap_ratio", GAP_EDGES)


@query("response_by_freq_ratio", response_sql(bins_sql("round(freq_ratio_5_30, 9)", FREQ_EDGES)))
def _(spark, folder):
    return signal.grid_response(draws(spark, folder), "freq_ratio_5_30", FREQ_EDGES, 9)
