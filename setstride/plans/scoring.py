"""Queries over scorers, rankings, tickets and next-step predictions."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from setstride.operators import combinations, evaluate, learners, neighbours, scorers
from setstride.operators.layout import StepTable
from setstride.operators.scorers import average_picks, count_ensemble, count_outcomes, count_scores, markov_scores, normalised, predictions
from setstride.plans.common import draws, query, table
from setstride.plans.sql import BLEND, DRAWS, FREQUENCY, GRID, MARKOV, RANKED, SCORES, STATE, text, with_

SCORED = [DRAWS, GRID, STATE, FREQUENCY, BLEND, MARKOV, SCORES, RANKED]


def picks_sql(model: str) -> str:
    return with_(*SCORED, select=f"""
SELECT pk.ord, {text('picks')} AS picks, special_pick, round(best, 6) AS best_score
FROM pk LEFT JOIN sp USING (model, ord) JOIN (SELECT model, ord, max(score) AS best FROM sc GROUP BY ALL) USING (model, ord)
WHERE model = '{model}' AND ord < (SELECT n FROM len)""")


def picks_of(scores):
    return scores.select("ord", "picks", "special_pick", F.array_max("score").alias("best_score"))


@query("frequency_picks", picks_sql("frequency"))
def _(spark, folder):
    return picks_of(count_scores(draws(spark, folder), models=("frequency",)))


@query("bayesian_picks", picks_sql("bayesian"))
def _(spark, folder):
    return picks_of(count_scores(draws(spark, folder), models=("bayesian",)))


@query("markov_picks", picks_sql("markov"))
def _(spark, folder):
    return picks_of(markov_scores(draws(spark, folder)))


@query("score_ranks", with_(*SCORED, select="""
SELECT model, ord, round(mean_rank, 6) AS mean_rank FROM pk WHERE ord < (SELECT n FROM len)"""))
def _(spark, folder):
    return count_outcomes(draws(spark, folder)).select("model", "ord", "mean_rank")


@query("ensemble_picks", with_(*SCORED, """
vt AS (SELECT ord, item, sum(CASE WHEN rk <= 5 THEN CASE model WHEN 'bayesian' THEN 12 ELSE 10 END ELSE 0 END) AS votes FROM rk GROUP BY ord, item),
vr AS (SELECT *, row_number() OVER (PARTITION BY ord ORDER BY votes DESC, item) AS r FROM vt)""", select=f"""
SELECT ord, {text('list(item ORDER BY r) FILTER (r <= 5)')} AS picks, round(CAST(max(votes) AS DOUBLE), 6) AS best_score
FROM vr WHERE ord < (SELECT n FROM len) GROUP BY ord"""))
def _(spark, folder):
    t = draws(spark, folder)
    return picks_of(count_ensemble(t)).drop("special_pick")


@query("average_picks", with_(*SCORED, """
nm AS (SELECT *, score / sum(score ORDER BY item) OVER (PARTITION BY model, ord ORDER BY item ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS p FROM sc WHERE model <> 'markov'),
av AS (SELECT ord, item, round(sum(p ORDER BY model) / 2, 12) AS s FROM nm GROUP BY ord, item),
ar AS (SELECT *, row_number() OVER (PARTITION BY ord ORDER BY s DESC, item) AS r FROM av)""", select=f"""
SELECT ord, {text('list(item ORDER BY r) FILTER (r <= 5)')} AS picks, round(max(s), 6) AS best_score FROM ar GROUP BY ord""").replace("sum(score ORDER BY item) OVER", "sum(score) OVER"))
def _(spark, folder):
    return average_picks(draws(spark, folder)).select("ord", "picks", "best_score")


# --- the open step after all history

OPEN = """
op AS (SELECT n AS ord, [0] AS none FROM len),
d2 AS (SELECT ord, items, special FROM d)
"""


def open_table(t: StepTable) -> tuple[StepTable, tuple[int, int]]:
    return t.with_request(), (t.longest, t.longest + 1)


OPEN_SCORES = """
lc AS (SELECT nums.item, count(li.ord) AS cnt, count(li.ord) FILTER (li.ord >= n - 20) AS r20, count(li.ord) FILTER (li.ord >= n - 50) AS r50,
              n - 1 - coalesce(max(li.ord), -1) AS gap FROM nums CROSS JOIN len LEFT JOIN li ON li.item = nums.item GROUP BY nums.item, n),
tc AS (SELECT a.item AS f, b.item AS t, count(*) AS n FROM li a JOIN li b ON b.ord = a.ord + 1 GROUP BY ALL),
tr AS (SELECT l.item AS f, nums.item AS t, CASE WHEN sum(coalesce(tc.n, 0)) OVER (PARTITION BY l.item) > 0
        THEN CAST(coalesce(tc.n, 0) AS DOUBLE) / sum(coalesce(tc.n, 0)) OVER (PARTITION BY l.item) ELSE 1.0 / 47 END AS p
       FROM (SELECT item FROM li, len WHERE ord = n - 1) l CROSS JOIN nums LEFT JOIN tc ON tc.f = l.item AND tc.t = nums.item),
os AS (
 SELECT 'frequency' AS model, item, CAST(50 * cnt + 30 * r50 + 20 * r20 AS DOUBLE) AS score FROM lc
 UNION ALL SELECT 'bayesian', item, round(0.5 * cnt / sum(cnt) OVER () + 0.5 * exp(CAST(gap - mg AS DOUBLE)) / sum(exp(CAST(gap - mg AS DOUBLE))) OVER (), 12)
   FROM lc CROSS JOIN (SELECT max(gap) AS mg FROM lc)
 UNION ALL SELECT 'markov', t, round(sum(p ORDER BY f), 12) FROM tr GROUP BY t),
orank AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY model ORDER BY score DESC, item) AS rk FROM os)
"""


@query("next_step_picks", with_(DRAWS, OPEN_SCORES, select=f"SELECT model, {text('list(item ORDER BY rk) FILTER (rk <= 5)')} AS picks, round(max(score), 6) AS best_score FROM orank GROUP BY model"))
def _(spark, folder):
    t, span = open_table(draws(spark, folder))
    return predictions(t, span=span).select("model", "picks", F.array_max("score").alias("best_score"))


@query("next_step_ranking", with_(DRAWS, OPEN_SCORES, select="""
SELECT model, item, rk AS rank, round(score / sum(score) OVER (PARTITION BY model), 6) AS prob FROM orank"""))
def _(spark, folder):
    t, span = open_table(draws(spark, folder))
    scores = predictions(t, span=span).select("model", F.posexplode(normalised(F.col("score"))).alias("at", "prob"), F.col("ranked").alias("r"))
    return scores.select("model", (F.col("at") + 1).alias("item"), F.array_position("r", F.col("at") + 1).alias("rank"), "prob")


@query("consensus_votes", with_(DRAWS, OPEN_SCORES, select="""
SELECT item, count(*) AS votes FROM orank WHERE rk <= 5 GROUP BY item ORDER BY votes DESC, item LIMIT 10"""))
def _(spark, folder):
    t, span = open_table(draws(spark, folder))
    return predictions(t, span=span).select(F.explode("picks").alias("item")).groupBy("item").agg(F.count("*").alias("votes")).orderBy(F.desc("votes"), "item").limit(10)


@query("model_comparison", with_(DRAWS, OPEN_SCORES, select=f"""
SELECT model, {text('list(item ORDER BY item) FILTER (rk <= 5)')} AS balls, CASE model WHEN 'bayesian' THEN 1.2 ELSE 1.0 END AS weight FROM orank GROUP BY model""").replace("1.2 ELSE 1.0", "CAST(1.2 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE)"))
def _(spark, folder):
    t, span = open_table(draws(spark, folder))
    weight = F.when(F.col("model") == "bayesian", 1.2).otherwise(1.0)
    return predictions(t, span=span).select("model", F.array_sort("picks").alias("balls"), weight.alias("weight"))


# --- combinations, neighbours

FITNESS = """
fr AS (SELECT nums.item, CAST(count(li.ord) AS DOUBLE) / (SELECT count(*) FROM li) AS f FROM nums LEFT JOIN li ON li.item = nums.item GROUP BY 1),
pr AS (SELECT a.item AS a, b.item AS b, count(*) AS n FROM li a JOIN li b ON a.ord = b.ord AND a.item < b.item GROUP BY ALL),
ps AS MATERIALIZED (SELECT x.item AS a, y.item AS b, coalesce(CAST(n AS DOUBLE) / (SELECT max(n) FROM pr), 0) AS s
       FROM nums x JOIN nums y ON x.item < y.item LEFT JOIN pr ON pr.a = x.item AND pr.b = y.item)
"""


@query("draw_fitness", with_(DRAWS, FITNESS, """
f1 AS (SELECT ord, sum(f ORDER BY item) AS f FROM li JOIN fr USING (item) GROUP BY ord),
f2 AS (SELECT x.ord, sum(s ORDER BY a, b) AS s FROM li x JOIN li y ON x.ord = y.ord AND x.item < y.item JOIN ps ON ps.a = x.item AND ps.b = y.item GROUP BY x.ord)""", select="""
SELECT ord, round(0.6 * f + 0.4 * s, 6) AS fitness FROM f1 JOIN f2 USING (ord)"""))
def _(spark, folder):
    t = draws(spark, folder)
    shares, pairs = combinations.fitness_tables(t)
    return t.df.select("ord", combinations.fitness(F.col("items"), shares, pairs, t.domain.items).alias("fitness"))


@query("best_combinations", with_(DRAWS, FITNESS, """
c2 AS (SELECT a, b, s FROM ps),
c3 AS (SELECT c2.a, c2.b, z.b AS c, c2.s + z.s + y.s AS s FROM c2 JOIN ps z ON z.a = c2.b JOIN ps y ON y.a = c2.a AND y.b = z.b),
c4 AS (SELECT c3.a, c3.b, c3.c, z.b AS e, c3.s + z.s + y.s + x.s AS s FROM c3 JOIN ps z ON z.a = c3.c JOIN ps y ON y.a = c3.b AND y.b = z.b JOIN ps x ON x.a = c3.a AND x.b = z.b),
c5 AS (SELECT c4.a, c4.b, c4.c, c4.e, z.b AS f, c4.s + z.s + y.s + x.s + w.s AS s FROM c4 JOIN ps z ON z.a = c4.e JOIN ps y ON y.a = c4.c AND y.b = z.b
       JOIN ps x ON x.a = c4.b AND x.b = z.b JOIN ps w ON w.a = c4.a AND w.b = z.b)""", select="""
SELECT a || ' ' || b || ' ' || c || ' ' || e || ' ' || f AS items, round(fit, 6) AS fitness FROM (
 SELECT a, b, c, e, f, round(0.6 * (f1.f + f2.f + f3.f + f4.f + f5.f) + 0.4 * s, 12) AS fit FROM c5
 JOIN fr f1 ON f1.item = a JOIN fr f2 ON f2.item = b JOIN fr f3 ON f3.item = c JOIN fr f4 ON f4.item = e JOIN fr f5 ON f5.item = c5.f
 ORDER BY fit DESC, a, b, c, e, c5.f LIMIT 10)""").replace("SELECT a, b, c, e, f, round(", "SELECT a, b, c, e, c5.f AS f, round("))
def _(spark, folder):
    return combinations.best_combinations(draws(spark, folder))


# A fit every ten steps; counts as of a fit are running sums over the steps between fits. Fitness and the place of a combination are one number, so the largest names both.
COMBINATION_FITS = """
ft AS MATERIALIZED (SELECT f AS no, 200 + 10 * f AS fit FROM len, range(CAST(ceil((n - 200) / 10.0) AS BIGINT)) r(f)),
sl AS MATERIALIZED (SELECT ord, item, CASE WHEN ord < 200 THEN 0 ELSE (ord - 200) // 10 + 1 END AS no FROM li),
pn AS (SELECT x.no, x.item AS a, y.item AS b, count(*) AS n FROM sl x JOIN sl y ON x.ord = y.ord AND x.item <= y.item GROUP BY ALL),
pq AS MATERIALIZED (SELECT ft.fit, x.item AS a, y.item AS b, sum(coalesce(pn.n, 0)) OVER (PARTITION BY x.item, y.item ORDER BY ft.no) AS n
       FROM ft CROSS JOIN nums x JOIN nums y ON x.item <= y.item LEFT JOIN pn ON pn.no = ft.no AND pn.a = x.item AND pn.b = y.item),
ps AS (SELECT *, CASE WHEN a < b THEN CAST(n AS DOUBLE) / max(CASE WHEN a < b THEN n END) OVER (PARTITION BY fit) ELSE 0 END AS s FROM pq),
pm AS MATERIALIZED (SELECT fit, list(s ORDER BY a, b) AS m, list(CAST(n AS DOUBLE) / (5 * fit) ORDER BY a) FILTER (a = b) AS f FROM ps GROUP BY fit),
u2 AS (SELECT a, unnest(range(a + 1, 48)) AS b FROM (SELECT unnest(range(1, 48)) AS a)),
u3 AS (SELECT *, unnest(range(b + 1, 48)) AS c FROM u2), u4 AS (SELECT *, unnest(range(c + 1, 48)) AS e FROM u3), u5 AS (SELECT *, unnest(range(e + 1, 48)) AS g FROM u4),
un AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY a, b, c, e, g) AS id, """ + ", ".join(f"CAST(({x} - 1) * 47 - ({x} - 1) * ({x} - 2) // 2 + {y} - {x} + 1 AS INTEGER) AS {x}{y}" for x, y in itertools.combinations("abceg", 2)) + """ FROM u5),
tp AS MATERIALIZED (SELECT fit, max(CAST(round(round(0.6 * (f[a] + f[b] + f[c] + f[e] + f[g]) + 0.4 * (""" + " + ".join(f"m[{x}{y}]" for x, y in itertools.combinations("abceg", 2)) + """), 12) * 1e12) AS UBIGINT) * 2097152 + (2097151 - id)) AS k FROM un CROSS JOIN pm GROUP BY fit),
cb AS MATERIALIZED (SELECT fit, [a, b, c, e, g] AS best FROM tp JOIN un ON id = 2097151 - CAST(k % 2097152 AS BIGINT))
"""


@query("combination_picks", with_(DRAWS, COMBINATION_FITS, select=f"""
SELECT d.ord, fit AS fit_ord, {text('best')} AS picks, len(list_intersect(best, items)) AS hits FROM d JOIN cb ON fit = 200 + (d.ord - 200) // 10 * 10 WHERE d.ord >= 200"""))
def _(spark, folder):
    """Every step from 200 on by the fittest combination as of its fit, fitted anew on the schedule of `REFIT_EVERY`."""
    t = draws(spark, folder)
    scores = evaluate.prequential(t, ("genetic",), 200)
    return evaluate.outcomes(scores, t.domain).select("ord", "fit_ord", "picks", "hits")


@query("learned_walk")
def _(spark, folder):
    """Learned and neighbour models walked from step 200 to the end, fitted anew on the schedule of `REFIT_EVERY`: metrics per model."""
    t = draws(spark, folder)
    scores = evaluate.prequential(t, ("decision_tree", "mlp", "knn", "genetic"), 200)
    return evaluate.summary(evaluate.outcomes(scores, t.domain), ["model"], t.domain)


@query("voter_ensemble_picks")
def _(spark, folder):
    """Votes of all six voters on the last fifth of the steps, fitted on the steps before."""
    t = draws(spark, folder)
    return picks_of(scorers.scorer("ensemble")(t, (t.longest * 4 // 5, t.longest))).drop("special_pick")


NEXT_TICKETS = """
qt AS (SELECT model, item, CAST(floor(score * power(10.0, 9 - CASE WHEN top >= 1 THEN length(CAST(CAST(floor(top) AS BIGINT) AS VARCHAR)) ELSE 0 END) + 0.5) AS BIGINT) AS q
  FROM (SELECT *, max(score) OVER (PARTITION BY model) AS top FROM orank) WHERE rk <= 12),
cd AS (SELECT model, list(item ORDER BY item) AS c, list(q ORDER BY item) AS p FROM qt GROUP BY model),
cx AS (SELECT a.i AS a, b.i AS b, c.i AS c3, e.i AS e, f.i AS f, row_number() OVER (ORDER BY a.i, b.i, c.i, e.i, f.i) AS cid
  FROM range(1, 13) a(i) JOIN range(1, 13) b(i) ON b.i > a.i JOIN range(1, 13) c(i) ON c.i > b.i JOIN range(1, 13) e(i) ON e.i > c.i JOIN range(1, 13) f(i) ON f.i > e.i)
"""


@query("next_step_tickets", with_(DRAWS, OPEN_SCORES, NEXT_TICKETS, select=f"""
SELECT model, row_number() OVER (PARTITION BY model ORDER BY p[a] + p[b] + p[c3] + p[e] + p[f] DESC, cid DESC) AS ticket, {text('[c[a], c[b], c[c3], c[e], c[f]]')} AS numbers FROM cd, cx QUALIFY ticket <= 5"""))
def _(spark, folder):
    t, span = open_table(draws(spark, folder))
    made = evaluate.best_tickets(predictions(t, span=span), t.domain)
    return made.select("model", F.posexplode("tickets").alias("at", "numbers")).select("model", (F.col("at") + 1).alias("ticket"), "numbers")


@query("next_step_document")
def _(spark, folder):
    """One JSON document: every model's picks and tickets for the open step, and the consensus of all."""
    return evaluate.next_step_document(draws(spark, folder), ("frequency", "markov", "bayesian", "knn", "genetic", "decision_tree", "mlp"))


@query("embedding_neighbours", """
WITH q AS (SELECT label, max(vec_id) AS qid FROM embeddings GROUP BY label),
ds AS (SELECT q.qid, b.vec_id, sqrt(list_sum([(CAST(a.embedding[j] AS DOUBLE) - b.embedding[j]) * (CAST(a.embedding[j] AS DOUBLE) - b.embedding[j]) FOR j IN range(1, 65)])) AS dist
       FROM q JOIN embeddings a ON a.vec_id = q.qid CROSS JOIN embeddings b WHERE b.vec_id <> q.qid),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, vec_id) AS rank FROM ds)
SELECT qid AS query_id, vec_id AS neighbour_id, round(dist, 6) AS distance, rank FROM r WHERE rank <= 10""")
def _(spark, folder):
    """The latest vector of each label against all vectors."""
    base = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"), "label")
    latest = base.groupBy("label").agg(F.max_by(F.struct("id", "vec"), "id").alias("q")).select("q.id", "q.vec")
    return neighbours.nearest(latest, base.select("id", "vec"), 10, skip_self=True)


@query("embedding_neighbours_by_50", """
WITH ds AS (SELECT a.vec_id AS qid, b.vec_id, sqrt(list_sum([(CAST(a.embedding[j] AS DOUBLE) - b.embedding[j]) * (CAST(a.embedding[j] AS DOUBLE) - b.embedding[j]) FOR j IN range(1, 65)])) AS dist
       FROM embeddings a CROSS JOIN embeddings b WHERE a.vec_id % 50 = 0 AND b.vec_id <> a.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, vec_id) AS rank FROM ds)
SELECT qid AS query_id, vec_id AS neighbour_id, round(dist, 6) AS distance, rank FROM r WHERE rank <= 10""")
def _(spark, folder):
    """Every vector whose id is divisible by 50 against all vectors: the queries grow with the table."""
    base = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))
    return neighbours.nearest(base.where(F.col("id") % 50 == 0), base, 10, skip_self=True)


@query("embedding_moments", """
SELECT i - 1 AS dim, round(avg(CAST(embedding[i] AS DOUBLE)), 6) + 0.0 AS mean, round(stddev_pop(CAST(embedding[i] AS DOUBLE)), 6) AS std
FROM embeddings, range(1, 65) r(i) GROUP BY i""")
def _(spark, folder):
    return neighbours.vector_moments(table(spark, folder, "embeddings").select(F.col("embedding").cast("array<double>").alias("vec")))


STATE_VECTORS = """
st2 AS (
  SELECT ord, item, y, coalesce(sum(y) OVER e, 0) AS cnt, coalesce(max(CASE WHEN y = 1 THEN ord END) OVER e, -1) AS last,
         coalesce(min(CASE WHEN y = 1 THEN ord END) OVER e, -1) AS first,
         coalesce(sum(y) OVER (PARTITION BY item ORDER BY ord ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), 0) AS r20,
         coalesce(sum(y) OVER (PARTITION BY item ORDER BY ord ROWS BETWEEN 100 PRECEDING AND 1 PRECEDING), 0) AS r100
  FROM (SELECT * FROM g UNION ALL SELECT len.n, nums.item, 0 FROM nums, len)
  WINDOW e AS (PARTITION BY item ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v4 AS (SELECT ord, item, CAST(ord - 1 - last AS DOUBLE) AS a,
        (ord - 1 - last) / greatest(CASE WHEN cnt > 1 THEN CAST(last - first AS DOUBLE) / (cnt - 1) ELSE ord END, 1) AS b,
        CAST(r20 AS DOUBLE) AS c, CAST(r100 AS DOUBLE) AS e FROM st2 WHERE ord >= 25),
vl AS (SELECT ord, item AS dim, a AS x FROM v4 UNION ALL SELECT ord, item + 47, b FROM v4 UNION ALL SELECT ord, item + 94, c FROM v4 UNION ALL SELECT ord, item + 141, e FROM v4),
mo AS (SELECT dim, avg(x) AS m, stddev_pop(x) + 1e-8 AS s FROM vl, len WHERE ord < n GROUP BY dim),
qv AS (SELECT dim, x FROM vl, len WHERE ord = n),
dist AS (SELECT vl.ord, sqrt(sum(power((vl.x - qv.x) / s, 2))) AS dist FROM vl JOIN qv USING (dim) JOIN mo USING (dim), len WHERE vl.ord < n GROUP BY vl.ord),
nb AS (SELECT ord FROM dist ORDER BY dist, ord LIMIT 10)
"""


@query("neighbour_votes", with_(DRAWS, GRID, STATE_VECTORS, select="SELECT nums.item, count(v.item) AS votes FROM nums LEFT JOIN (SELECT item FROM li JOIN nb USING (ord)) v ON v.item = nums.item GROUP BY nums.item"))
def _(spark, folder):
    return neighbours.neighbour_votes(draws(spark, folder))


# The ten nearest earlier states of every step, each dimension scaled by its deviation over the states before that step.
NEIGHBOUR_WALK = """
vw AS MATERIALIZED (
  SELECT ord, item, a, b, c, e, stddev_pop(a) OVER w + 1e-8 AS sa, stddev_pop(b) OVER w + 1e-8 AS sb, stddev_pop(c) OVER w + 1e-8 AS sc, stddev_pop(e) OVER w + 1e-8 AS se
  FROM v4, len WHERE ord < n WINDOW w AS (PARTITION BY item ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
vv AS MATERIALIZED (
  SELECT ord, list_concat(list_concat(list(a ORDER BY item), list(b ORDER BY item)), list_concat(list(c ORDER BY item), list(e ORDER BY item))) AS x,
         list_concat(list_concat(list(sa ORDER BY item), list(sb ORDER BY item)), list_concat(list(sc ORDER BY item), list(se ORDER BY item))) AS s FROM vw GROUP BY ord),
vq AS MATERIALIZED (SELECT ord, list_transform(list_zip(x, s), lambda t: CASE WHEN t[2] > 1e-7 THEN t[1] / t[2] / t[2] ELSE 0 END) AS u,
         list_transform(s, lambda t: CASE WHEN t > 1e-7 THEN 1 / t / t ELSE 0 END) AS w FROM vv),
vx AS MATERIALIZED (SELECT ord, x, list_transform(x, lambda t: t * t) AS xx FROM vv),
dn AS (SELECT q.ord AS q, b.ord AS i, list_dot_product(b.xx, q.w) - 2 * list_dot_product(b.x, q.u) AS dist FROM vq q JOIN vx b ON b.ord < q.ord),
nn AS MATERIALIZED (SELECT q, unnest(min_by(i, dist, 10)) AS i FROM dn GROUP BY q),
kv AS (SELECT q AS ord, nums.item, count(v.item) AS votes FROM (SELECT DISTINCT q FROM nn) CROSS JOIN nums LEFT JOIN (SELECT nn.q, li.item FROM nn JOIN li ON li.ord = nn.i) v USING (q, item) GROUP BY ALL),
kr AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY ord ORDER BY votes DESC, item) AS r FROM kv)
"""


@query("neighbour_picks", with_(DRAWS, GRID, STATE_VECTORS, NEIGHBOUR_WALK, select=f"""
SELECT ord, {text('list(item ORDER BY r) FILTER (r <= 5)')} AS picks, CAST(max(votes) AS DOUBLE) AS best_score FROM kr GROUP BY ord"""))
def _(spark, folder):
    """Every step by the ten closest states of its own past."""
    return picks_of(neighbours.neighbour_walk(draws(spark, folder))).drop("special_pick")


# --- learning inputs


@query("feature_matrix", with_(DRAWS, "ft AS MATERIALIZED (SELECT ord, list_sum(items) AS white_sum, len([x FOR x IN items IF x % 2 = 1]) AS odd_count, len([x FOR x IN items IF x <= 23]) AS low_count, items[5] - items[1] AS number_range FROM d)", GRID, STATE, """
rl AS (SELECT ord, """ + ", ".join(f"{f}({c}) OVER w AS {c}_{f}" for c in ("white_sum", "odd_count", "low_count", "number_range") for f in ("avg", "stddev_samp")) + """ FROM ft WINDOW w AS (ORDER BY ord ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)),
ax AS (SELECT ord, list(gap ORDER BY item) AS gaps, list(CAST(r20 AS BIGINT) ORDER BY item) AS freqs, list(CAST(y AS BIGINT) ORDER BY item) AS y FROM st GROUP BY ord)""", select=f"""
SELECT ord, """ + ", ".join(f"round({c}_{f}, 6) AS x{i}" for i, (c, f) in enumerate((c, f) for c in ("white_sum", "odd_count", "low_count", "number_range") for f in ("avg", "stddev_samp"))) + f""",
 {text('gaps')} AS gaps, {text('freqs')} AS freqs, {text('y')} AS y FROM rl JOIN ax USING (ord) WHERE ord >= 10"""))
def _(spark, folder):
    m = learners.feature_matrix(draws(spark, folder))
    longs = lambda a, b: F.transform(F.slice("x", a, b), lambda v: v.cast("long"))
    return m.select("ord", *[F.get("x", F.lit(i)).alias(f"x{i}") for i in range(8)], longs(9, 47).alias("gaps"), longs(56, 47).alias("freqs"), "y")


@query("class_weights", with_(DRAWS, GRID, """
cw AS (SELECT item, y, count(*) AS nc, sum(count(*)) OVER (PARTITION BY item) AS n FROM g GROUP BY item, y)""", select="""
SELECT item, CAST(y AS BIGINT) AS y, nc AS n, round(CAST(n AS DOUBLE) / (2 * nc), 6) AS weight FROM cw"""))
def _(spark, folder):
    from setstride.operators.state import item_grid

    t = draws(spark, folder)
    grid = item_grid(t.df, t, {}, ["ord"])
    return learners.balanced_weights(grid, ["item"]).groupBy("item", "y").agg(F.count("*").alias("n"), F.max("weight").alias("weight"))


# --- learned scorers

TREE_BINS = """
fb AS MATERIALIZED (
  SELECT ord, dim, CAST(least(31, floor(x)) AS BIGINT) AS bin FROM (
    SELECT ord, item - 1 AS dim, CAST(gap AS DOUBLE) AS x FROM st
    UNION ALL SELECT ord, item + 46, gap / greatest(avg_gap, 1) / 0.125 FROM st
    UNION ALL SELECT ord, item + 93, CAST(r30 AS DOUBLE) FROM st
    UNION ALL SELECT ord, item + 140, CAST(r100 AS DOUBLE) FROM st), len
  WHERE ord >= 100 AND ord < 100 + CAST(floor((n - 100) * 0.8) AS BIGINT)),
fa AS (SELECT dim, bin, count(*) AS n FROM fb GROUP BY ALL),
fp AS (SELECT li.item, dim, bin, count(*) AS k FROM fb JOIN li USING (ord) GROUP BY ALL),
cum AS (
  SELECT item, dim, bin, sum(n) OVER (w ROWS UNBOUNDED PRECEDING) AS ln, sum(k) OVER (w ROWS UNBOUNDED PRECEDING) AS lk,
         sum(n) OVER (PARTITION BY item, dim) AS an, sum(k) OVER (PARTITION BY item, dim) AS ak
  FROM (SELECT nums.item, f.dim, b.bin, coalesce(fa.n, 0) AS n, coalesce(fp.k, 0) AS k
        FROM nums CROSS JOIN range(188) f(dim) CROSS JOIN range(32) b(bin) LEFT JOIN fa USING (dim, bin) LEFT JOIN fp USING (item, dim, bin))
  WINDOW w AS (PARTITION BY item, dim ORDER BY bin)),
wt AS (SELECT *, CAST(an AS DOUBLE) / (2 * (an - ak)) AS w0, CAST(an AS DOUBLE) / (2 * ak) AS w1 FROM cum),
sd AS (SELECT *, w0 * (an - ak) + w1 * ak AS aw, w0 * (ln - lk) + w1 * lk AS lw, w0 * (an - ln - ak + lk) + w1 * (ak - lk) AS rw FROM wt WHERE ln >= 20 AND an - ln >= 20),
gn AS (SELECT *, round(2 * w1 * ak * (aw - w1 * ak) / aw - 2 * w1 * lk * (lw - w1 * lk) / lw - 2 * w1 * (ak - lk) * (rw - w1 * (ak - lk)) / rw, 9) AS gain FROM sd),
rt AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY gain DESC, dim, bin) AS r FROM gn)
"""


@query("tree_roots", with_(DRAWS, GRID, STATE, TREE_BINS, select="""
SELECT item, ['gap', 'gap_ratio', 'freq30', 'freq100'][CAST(dim // 47 AS INTEGER) + 1] || '_' || (dim % 47 + 1) AS feature_name, bin, round(gain, 6) AS gain,
       round(w1 * ak / aw, 6) AS share, round(w1 * lk / lw, 6) AS share_low, round(w1 * (ak - lk) / rw, 6) AS share_high FROM rt WHERE r = 1"""))
def _(spark, folder):
    return learners.tree_roots(draws(spark, folder))


@query("tree_scores")
def _(spark, folder):
    return picks_of(learners.tree_scores(draws(spark, folder)))


@query("tree_importance")
def _(spark, folder):
    return learners.tree_importance(draws(spark, folder))


@query("forest_scores")
def _(spark, folder):
    return picks_of(learners.forest_scores(draws(spark, folder)))


@query("boosted_scores")
def _(spark, folder):
    return picks_of(learners.boosted_scores(draws(spark, folder)))


@query("perceptron_scores")
def _(spark, folder):
    return picks_of(learners.network_scores(draws(spark, folder)))


@query("forest_search")
def _(spark, folder):
    return learners.halving_search(draws(spark, folder))
