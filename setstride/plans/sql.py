"""Common table expressions of the check queries (DuckDB dialect)."""

DRAWS = """
o AS (SELECT o_orderkey, o_custkey % 47 AS a, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
             CAST(o_orderdate AS DATE) AS ts, o_totalprice FROM orders),
d AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY ts, o_orderkey) - 1 AS ord, o_orderkey AS step_id, ts,
         list_sort([1 + (a + j * (1 + cents % 46)) % 47 FOR j IN range(5)]) AS items,
         1 + (cents // 46) % 27 AS special, o_totalprice AS amount
  FROM o),
li AS MATERIALIZED (SELECT ord, step_id, ts, unnest(items) AS item FROM d),
nums AS (SELECT unnest(range(1, 48)) AS item),
mnums AS (SELECT unnest(range(1, 28)) AS item),
len AS (SELECT count(*) AS n FROM d)
"""

GRID = """
g AS MATERIALIZED (
  SELECT d.ord, nums.item, CASE WHEN list_contains(d.items, nums.item) THEN 1 ELSE 0 END AS y FROM d CROSS JOIN nums),
gm AS MATERIALIZED (
  SELECT d.ord, mnums.item, CASE WHEN d.special = mnums.item THEN 1 ELSE 0 END AS y FROM d CROSS JOIN mnums)
"""


def rolling(w: int) -> str:
    return f"coalesce(sum(y) OVER (PARTITION BY item ORDER BY ord ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING), 0) AS r{w}"


STATE = f"""
st0 AS MATERIALIZED (
  SELECT ord, item, y,
         coalesce(sum(y) OVER e, 0) AS cnt,
         coalesce(max(CASE WHEN y = 1 THEN ord END) OVER e, -1) AS last,
         coalesce(min(CASE WHEN y = 1 THEN ord END) OVER e, -1) AS first,
         {', '.join(rolling(w) for w in (5, 10, 20, 30, 50, 100))}
  FROM g WINDOW e AS (PARTITION BY item ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
st AS MATERIALIZED (
  SELECT *, ord - 1 - last AS gap,
         CASE WHEN cnt > 1 THEN CAST(last - first AS DOUBLE) / (cnt - 1) ELSE CAST(ord AS DOUBLE) END AS avg_gap
  FROM st0),
stm AS MATERIALIZED (
  SELECT ord, item, y, coalesce(sum(y) OVER (PARTITION BY item ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cnt
  FROM gm)
"""

FREQUENCY = """
fs AS MATERIALIZED (SELECT 'frequency' AS model, ord, item, y, CAST(50 * cnt + 30 * r50 + 20 * r20 AS DOUBLE) AS score FROM st WHERE ord > 0),
fm AS (SELECT 'frequency' AS model, ord, min(item) AS special_pick
       FROM (SELECT *, max(cnt) OVER (PARTITION BY ord) AS top FROM stm WHERE ord > 0) WHERE cnt = top GROUP BY ord)
"""

BLEND = """
bs AS MATERIALIZED (
  SELECT 'bayesian' AS model, ord, item, y,
         round(0.5 * cnt / sum(cnt) OVER w + 0.5 * eg / sum(eg) OVER w, 12) AS score
  FROM (SELECT *, exp(CAST(gap - max(gap) OVER (PARTITION BY ord) AS DOUBLE)) AS eg FROM st WHERE ord > 0)
  WINDOW w AS (PARTITION BY ord))
"""

MARKOV = """
kt AS (
  SELECT ord, c, item, y, coalesce(sum(y) OVER (PARTITION BY c, item ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS known
  FROM (SELECT li.ord + 1 AS ord, li.item AS c FROM li) p JOIN g USING (ord)),
ks AS MATERIALIZED (
  SELECT 'markov' AS model, ord, item, any_value(y) AS y,
         round(sum(CASE WHEN tot > 0 THEN CAST(known AS DOUBLE) / tot ELSE 1.0 / 47 END ORDER BY c), 12) AS score
  FROM (SELECT *, sum(known) OVER (PARTITION BY ord, c) AS tot FROM kt) GROUP BY ord, item),
kmt AS (
  SELECT ord, item, coalesce(sum(y) OVER (PARTITION BY c, item ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS known
  FROM (SELECT ord + 1 AS ord, special AS c FROM d) p JOIN gm USING (ord)),
km AS (SELECT 'markov' AS model, ord, min(item) AS special_pick
       FROM (SELECT *, max(known) OVER (PARTITION BY ord) AS top FROM kmt) WHERE known = top GROUP BY ord)
"""

SCORES = """
sc AS MATERIALIZED (SELECT * FROM fs UNION ALL SELECT * FROM bs UNION ALL SELECT * FROM ks),
sp AS MATERIALIZED (SELECT * FROM fm UNION ALL SELECT * FROM km)
"""

RANKED = """
rk AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY model, ord ORDER BY score DESC, item) AS rk FROM sc),
pk AS MATERIALIZED (
  SELECT model, ord, CAST(sum(CASE WHEN rk <= 5 THEN y ELSE 0 END) AS BIGINT) AS hits,
         avg(CASE WHEN y = 1 THEN rk END) AS mean_rank,
         list(item ORDER BY rk) FILTER (rk <= 5) AS picks
  FROM rk GROUP BY model, ord)
"""

PRIZES = """
prizes(h, m, amount) AS (VALUES (5, 1, 7000000.0), (5, 0, 25241.0), (4, 1, 1402.0), (4, 0, 108.0), (3, 1, 61.0),
                                (3, 0, 11.0), (2, 1, 12.0), (1, 1, 2.0), (0, 1, 1.0)),
hm AS (SELECT h, m, coalesce(amount, 0.0) AS amount
       FROM (SELECT h, m FROM range(6) a(h), range(2) b(m)) LEFT JOIN prizes USING (h, m)),
expected AS (SELECT w.h, w.amount / 27.0 + n.amount * (1.0 - 1.0 / 27) AS amount
             FROM hm w JOIN hm n ON w.h = n.h AND w.m = 1 AND n.m = 0)
"""

OUTCOMES = """
oc AS MATERIALIZED (
  SELECT pk.model, pk.ord, d.ts, pk.hits, pk.mean_rank, pk.picks, sp.special_pick,
         CASE WHEN sp.special_pick = d.special THEN 1 ELSE 0 END AS special_hit,
         CASE WHEN sp.special_pick IS NULL THEN 0.0 ELSE hm.amount END AS prize,
         CASE WHEN sp.special_pick IS NULL THEN e.amount ELSE hm.amount END AS ev
  FROM pk JOIN d USING (ord) LEFT JOIN sp USING (model, ord)
  JOIN hm ON hm.h = pk.hits AND hm.m = CASE WHEN sp.special_pick = d.special THEN 1 ELSE 0 END
  JOIN expected e ON e.h = pk.hits)
"""

FOLDS = """
dates AS (SELECT ts, count(*) AS n FROM d GROUP BY ts),
lim AS (SELECT CAST(min(ts) AS DATE) AS lo, CAST(max(ts) AS DATE) AS hi FROM d),
fw AS (
  SELECT k + 1 AS fold, CAST(lo + to_months(24) + to_months(6 * k) AS DATE) AS ws,
         CAST(lo + to_months(24) + to_months(6 * k) + to_months(6) AS DATE) AS we
  FROM lim, range(200) r(k) WHERE lo + to_months(24) + to_months(6 * k) + to_months(6) <= hi + 1),
fsum AS MATERIALIZED (
  SELECT fold, ws, we, min(ts) FILTER (ts < ws) AS train_start, max(ts) FILTER (ts < ws) AS train_end,
         min(ts) FILTER (ts >= ws) AS test_start, max(ts) FILTER (ts >= ws) AS test_end,
         CAST(coalesce(sum(n) FILTER (ts < ws), 0) AS BIGINT) AS n_train,
         CAST(coalesce(sum(n) FILTER (ts >= ws), 0) AS BIGINT) AS n_test
  FROM dates JOIN fw ON ts < we GROUP BY ALL HAVING n_train >= 50 AND n_test >= 5)
"""

# The 792 index combinations of 12 candidates and the five best tickets of every (model, ord) in `wanted`; scores are whole
# numbers of units below the power of ten above the largest one.
TICKETS = """
qt AS (
  SELECT model, ord, item, CAST(floor(score * power(10.0, 9 - CASE WHEN top >= 1 THEN length(CAST(CAST(floor(top) AS BIGINT) AS VARCHAR)) ELSE 0 END) + 0.5) AS BIGINT) AS q
  FROM (SELECT rk.*, max(score) OVER (PARTITION BY model, ord) AS top FROM rk JOIN wanted USING (model, ord)) WHERE rk <= 12),
cd AS MATERIALIZED (
  SELECT model, ord, list(item ORDER BY item) AS c, list(q ORDER BY item) AS p FROM qt GROUP BY model, ord),
cx AS MATERIALIZED (
  SELECT a.i AS a, b.i AS b, c.i AS c3, e.i AS e, f.i AS f, row_number() OVER (ORDER BY a.i, b.i, c.i, e.i, f.i) AS cid
  FROM range(1, 13) a(i) JOIN range(1, 13) b(i) ON b.i > a.i JOIN range(1, 13) c(i) ON c.i > b.i
  JOIN range(1, 13) e(i) ON e.i > c.i JOIN range(1, 13) f(i) ON f.i > e.i),
tk AS MATERIALIZED (
  SELECT model, ord, [c[a], c[b], c[c3], c[e], c[f]] AS numbers,
         row_number() OVER (PARTITION BY model, ord ORDER BY p[a] + p[b] + p[c3] + p[e] + p[f] DESC, cid DESC) AS ticket
  FROM cd, cx QUALIFY ticket <= 5),
tp AS MATERIALIZED (
  SELECT tk.model, tk.ord, d.ts, tk.ticket, tk.numbers, len(list_intersect(tk.numbers, d.items)) AS hits, sp.special_pick,
         CASE WHEN sp.special_pick IS NULL THEN e.amount ELSE hm.amount END AS paid
  FROM tk JOIN d USING (ord) LEFT JOIN sp USING (model, ord)
  JOIN hm ON hm.h = len(list_intersect(tk.numbers, d.items)) AND hm.m = CASE WHEN sp.special_pick = d.special THEN 1 ELSE 0 END
  JOIN expected e ON e.h = len(list_intersect(tk.numbers, d.items)))
"""

ALL_SCORES = [DRAWS, GRID, STATE, FREQUENCY, BLEND, MARKOV, SCORES, RANKED, PRIZES, OUTCOMES]


def with_(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n" + select.strip()


def text(expr: str) -> str:
    return f"array_to_string({expr}, ' ')"


METRICS = """
count(*) AS n_draws, round(avg(hits), 6) AS mean_hits, round(avg(hits) / 5, 6) AS precision_at5,
round(avg(CASE WHEN hits > 0 THEN 1.0 ELSE 0.0 END), 6) AS coverage,
""" + "\n".join(f"count(*) FILTER (hits = {h}) AS hit{h}, round(100.0 * count(*) FILTER (hits = {h}) / count(*), 6) AS hit{h}_pct," for h in range(6)) + """
round(avg(hits) - 25.0 / 47, 6) + 0.0 AS vs_random_hits, round(avg(ev), 6) AS ev_per_draw, round(avg(ev) - 1, 6) + 0.0 AS net_ev_per_draw,
round((avg(ev) - 1) * 100, 6) + 0.0 AS roi_pct, round(sum(ev), 6) AS total_ev, CAST(count(*) AS DOUBLE) AS total_cost,
round(avg(mean_rank), 6) AS mean_rank, round(avg(mean_rank) - 24, 6) + 0.0 AS vs_random_rank, round(stddev_samp(hits), 6) AS hits_std
"""


def student_p(t: str, df: str) -> str:
    """Two-sided p value for whole degrees of freedom: the finite series in the angle atan(t / sqrt(df)), its coefficients by gammas."""
    angle = f"atan(abs({t}) / sqrt({df}))"
    odd = f"""(2 / pi()) * ({angle} + CASE WHEN {df} > 1 THEN sin({angle}) * list_sum([
      exp((2 * k + 1) * ln(cos({angle})) + 0.5 * ln(pi()) + lgamma(k + 1) - ln(2) - lgamma(k + 1.5)) FOR k IN range(0, CAST(({df} - 1) // 2 AS BIGINT))]) ELSE 0 END)"""
    even = f"""sin({angle}) * list_sum([
      exp(2 * k * ln(cos({angle})) + lgamma(k + 0.5) - 0.5 * ln(pi()) - lgamma(k + 1)) FOR k IN range(0, CAST({df} // 2 AS BIGINT))])"""
    return f"(1 - CASE WHEN {df} % 2 = 1 THEN {odd} ELSE {even} END)"
