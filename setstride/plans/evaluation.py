"""Queries over walk-forward evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from setstride.config import INITIAL_STEPS
from setstride.operators import evaluate
from setstride.operators.scorers import count_scores, predictions
from setstride.plans.common import draws, query, without_series
from setstride.plans.sql import ALL_SCORES, DRAWS, FOLDS, METRICS, TICKETS, student_p, text, with_


@query("walk_outcomes", with_(*ALL_SCORES, select="""
SELECT model, ord, hits, CAST(special_hit AS BIGINT) AS special_hit, round(CAST(prize AS DOUBLE), 6) AS prize, round(ev, 6) AS ev, round(mean_rank, 6) AS mean_rank FROM oc"""))
def _(spark, folder):
    t = draws(spark, folder)
    return evaluate.walk_outcomes(t).select("model", "ord", "hits", "special_hit", "prize", "ev", "mean_rank")


@query("walk_metrics", with_(*ALL_SCORES, select=f"SELECT model, {METRICS} FROM oc GROUP BY model"))
def _(spark, folder):
    t = draws(spark, folder)
    return evaluate.summary(evaluate.walk_outcomes(t), ["model"], t.domain)


@query("fold_table", with_(DRAWS, FOLDS, select="""
SELECT fold, CAST(train_start AS VARCHAR) AS train_start, CAST(train_end AS VARCHAR) AS train_end, CAST(test_start AS VARCHAR) AS test_start,
       CAST(test_end AS VARCHAR) AS test_end, n_train, n_test FROM fsum"""))
def _(spark, folder):
    dates = evaluate.date_histogram(draws(spark, folder))
    return evaluate.fold_summary(dates).drop("window_start", "window_end")


FOLD_WALK = "fo AS MATERIALIZED (SELECT oc.*, fold FROM oc JOIN fsum ON oc.ts >= ws AND oc.ts < we)"


@query("fold_metrics", with_(*ALL_SCORES, FOLDS, FOLD_WALK, select=f"SELECT model, fold, {METRICS} FROM fo GROUP BY model, fold"))
def _(spark, folder):
    t = draws(spark, folder)
    return evaluate.summary(evaluate.fold_walk(t), ["model", "fold"], t.domain)


@query("fold_metrics_rollup", with_(*ALL_SCORES, FOLDS, FOLD_WALK, select="""
SELECT model, fold, count(*) AS n_draws, round(avg(hits), 6) AS mean_hits, round(avg(ev), 6) AS ev_per_draw FROM fo GROUP BY ROLLUP (model, fold)"""))
def _(spark, folder):
    rows = evaluate.fold_walk(draws(spark, folder))
    return rows.rollup("model", "fold").agg(F.count("*").alias("n_draws"), F.avg("hits").alias("mean_hits"), F.avg("ev").alias("ev_per_draw"))


@query("fold_comparison", with_(*ALL_SCORES, FOLDS, FOLD_WALK, """
pf AS (SELECT model, fold, avg(hits) AS mh, avg(CASE WHEN hits > 0 THEN 1.0 ELSE 0.0 END) AS cov, avg(ev) AS ev FROM fo GROUP BY ALL),
pm AS (SELECT model, count(*) AS n_draws, (avg(hits) - 25.0 / 47) / (stddev_samp(hits) / sqrt(count(*))) AS t FROM fo GROUP BY model)""", select="""
SELECT model, count(*) AS n_folds, round(avg(mh), 6) AS mean_hits_avg, round(stddev_pop(mh), 6) AS mean_hits_std, round(avg(mh) / 5, 6) AS precision_at5_avg,
 round(stddev_pop(mh / 5), 6) AS precision_at5_std, round(avg(cov), 6) AS coverage_avg, round(avg(ev), 6) AS ev_avg, round(avg(ev) - 1, 6) + 0.0 AS net_ev_avg,
 round((avg(ev) - 1) * 100, 6) + 0.0 AS roi_pct, any_value(n_draws) AS n_draws, round(any_value(t), 6) + 0.0 AS t_stat,
 CASE WHEN any_value(t) > 0 THEN 'better' WHEN any_value(t) < 0 THEN 'worse' ELSE 'none' END AS direction FROM pf JOIN pm USING (model) GROUP BY model"""))
def _(spark, folder):
    t = draws(spark, folder)
    return evaluate.compare_models(evaluate.fold_walk(t), t.domain).drop("p_value")


@query("fold_significance", with_(*ALL_SCORES, FOLDS, FOLD_WALK, f"""
pm AS (SELECT model, count(*) AS n_draws, (avg(hits) - 25.0 / 47) / (stddev_samp(hits) / sqrt(count(*))) AS t FROM fo GROUP BY model)""", select=f"""
SELECT model, n_draws, round(t, 6) + 0.0 AS t_stat, round({student_p('t', '(n_draws - 1)')}, 6) + 0.0 AS p_value,
 CASE WHEN t > 0 THEN 'better' WHEN t < 0 THEN 'worse' ELSE 'none' END AS direction FROM pm"""))
def _(spark, folder):
    t = draws(spark, folder)
    return evaluate.compare_models(evaluate.fold_walk(t), t.domain).select("model", "n_draws", "t_stat", "p_value", "direction")


@query("chronological_split", with_(DRAWS, select="""
SELECT ord, CASE WHEN ord < CAST(floor(n * 0.8) AS BIGINT) THEN 'train' ELSE 'test' END AS part, CAST(CASE WHEN ord >= n - 60 THEN 1 ELSE 0 END AS BIGINT) AS validation FROM d, len"""))
def _(spark, folder):
    t = draws(spark, folder)
    train, test = evaluate.chronological_split(t, 0.8)
    parts = train.select("series_id", "ord", F.lit("train").alias("part")).unionByName(test.select("series_id", "ord", F.lit("test").alias("part")))
    _, valid = evaluate.last_steps(t, 60)
    flags = valid.select("series_id", "ord", F.lit(1).alias("validation"))
    return parts.join(flags, ["series_id", "ord"], "left").select("ord", "part", F.coalesce("validation", F.lit(0)).alias("validation"))


# --- prequential walk from ord 200 to the end

WALKED = "wanted AS MATERIALIZED (SELECT model, ord FROM pk WHERE ord >= 200)"
WALK_PARTS = [*ALL_SCORES, WALKED, TICKETS]


@query("prequential_tickets", with_(*WALK_PARTS, select=f"SELECT model, ord, ticket, {text('numbers')} AS numbers, hits AS ticket_hits, round(paid, 6) AS ticket_prize FROM tp"))
def _(spark, folder):
    return evaluate.ticket_rows(evaluate.walk_tickets(draws(spark, folder))).select("model", "ord", "ticket", "numbers", "ticket_hits", "ticket_prize")


@query("prequential_metrics", with_(*ALL_SCORES, select=f"""
SELECT model, {METRICS}, round((avg(hits) - 25.0 / 47) / (stddev_samp(hits) / sqrt(count(*))), 6) AS t_stat FROM oc WHERE ord >= 200 GROUP BY model"""))
def _(spark, folder):
    t = draws(spark, folder)
    tested = evaluate.against_random(evaluate.summary(evaluate.walk_outcomes(t, start=INITIAL_STEPS), ["model"], t.domain), t.domain)
    return tested.drop("p_value", "direction")


@query("multi_ticket_returns", with_(*WALK_PARTS, """
cu AS (SELECT model, ord, ticket AS buy_n, sum(paid) OVER (PARTITION BY model, ord ORDER BY ticket) AS paid FROM tp)""", select="""
SELECT model, buy_n, round(avg(paid), 6) AS ev_per_draw, CAST(buy_n AS DOUBLE) AS cost_per_draw, round(avg(paid) - buy_n, 6) + 0.0 AS net_ev,
       round((avg(paid) - buy_n) / buy_n * 100, 6) + 0.0 AS roi_pct FROM cu GROUP BY model, buy_n"""))
def _(spark, folder):
    return evaluate.multi_ticket(evaluate.walk_tickets(draws(spark, folder)))


@query("drift", with_(*ALL_SCORES, """
dr AS (SELECT model, ord - 200 AS position, avg(hits) OVER (PARTITION BY model ORDER BY ord ROWS BETWEEN 50 PRECEDING AND CURRENT ROW) AS ma
       FROM oc WHERE ord >= 200)""", select="SELECT model, position, round(ma, 6) AS moving_avg FROM dr WHERE position % 50 = 49"))
def _(spark, folder):
    t = draws(spark, folder)
    return without_series(evaluate.drift(evaluate.walk_outcomes(t, start=INITIAL_STEPS), t, INITIAL_STEPS))


@query("drift_all_steps", with_(*ALL_SCORES, """
dr AS (SELECT model, ord AS position, avg(hits) OVER (PARTITION BY model ORDER BY ord ROWS BETWEEN 50 PRECEDING AND CURRENT ROW) AS ma FROM oc)""", select="SELECT model, position, round(ma, 6) AS moving_avg FROM dr WHERE position % 50 = 49"))
def _(spark, folder):
    t = draws(spark, folder)
    return without_series(evaluate.drift(evaluate.walk_outcomes(t), t))


STALE = """
fit AS (SELECT model, ord AS fit_ord, picks FROM pk WHERE ord >= 200 AND (ord - 200) % {every} = 0),
sv AS (SELECT f.model, d.ord, f.fit_ord, f.picks, len(list_intersect(f.picks, d.items)) AS hits
       FROM d JOIN fit f ON f.fit_ord = 200 + {every} * ((d.ord - 200) // {every}) WHERE d.ord >= 200)
"""


@query("stale_predictions", with_(*ALL_SCORES, STALE.format(every=10), select=f"SELECT model, ord, fit_ord, {text('picks')} AS picks, hits FROM sv"))
def _(spark, folder):
    """Every step from 200 on, served by a fit that is renewed every tenth step."""
    t = draws(spark, folder)
    aged = evaluate.stale_scores(predictions(t), t, 10)
    return evaluate.outcomes(aged, t.domain).select("model", "ord", "fit_ord", "picks", "hits")


BUYS = ", ".join(
    f"round(max(CASE WHEN buy_n = {k} THEN e END), 6) AS buy{k}_ev, round(max(CASE WHEN buy_n = {k} THEN e - {k} END), 6) + 0.0 AS buy{k}_net_ev, round(max(CASE WHEN buy_n = {k} THEN (e - {k}) / {k} * 100 END), 6) + 0.0 AS buy{k}_roi"
    for k in range(1, 6)
)


@query("walk_report", with_(*WALK_PARTS, """
cu AS (SELECT model, ord, ticket AS buy_n, sum(paid) OVER (PARTITION BY model, ord ORDER BY ticket) AS paid FROM tp),
be AS (SELECT model, buy_n, avg(paid) AS e FROM cu GROUP BY ALL),
b5 AS (SELECT model, """ + BUYS + """ FROM be GROUP BY model),
f1 AS (SELECT model, count(*) AS n_draws, round(avg(hits), 6) AS avg_hits, round(avg(hits) / 5, 6) AS prec_at5, round(avg(hits) - 25.0 / 47, 6) + 0.0 AS vs_random,
       round(avg(paid), 6) AS ev_per_draw, round(avg(paid) - 1, 6) + 0.0 AS net_ev, round((avg(paid) - 1) * 100, 6) + 0.0 AS roi_pct,
       """ + ", ".join(f"round(100.0 * count(*) FILTER (hits = {h}) / count(*), 6) AS hit{h}_pct" for h in range(6)) + """ FROM tp WHERE ticket = 1 GROUP BY model)""", select="SELECT * FROM f1 JOIN b5 USING (model)"))
def _(spark, folder):
    t = draws(spark, folder)
    return evaluate.ticket_report(evaluate.walk_tickets(t), t)


AUC = """
nm AS (SELECT item, y, score / sum(score) OVER (PARTITION BY ord) AS p FROM fs WHERE ord < (SELECT n FROM len)),
cl AS (SELECT item, p, sum(y) AS pos, count(*) - sum(y) AS neg FROM nm GROUP BY item, p),
be AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY item ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM cl),
au AS (SELECT item, CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives, sum(pos * (below + neg / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) AS auc FROM be GROUP BY item)
"""


@query("item_auc", with_(*ALL_SCORES, AUC, select="SELECT item, round(auc, 6) AS auc, positives, negatives FROM au"))
def _(spark, folder):
    t = draws(spark, folder)
    return evaluate.item_auc(count_scores(t, models=("frequency",)), t.domain)


@query("model_quality", with_(*ALL_SCORES, AUC, select="""
SELECT round(avg(hits) / 5, 6) AS precision_at_5, round(avg(hits), 6) AS avg_hits, round((SELECT avg(auc) FROM au), 6) AS auc_roc_macro,
       round(5.0 / 47, 6) AS random_baseline_p5, round(avg(hits) / 5 - 5.0 / 47, 6) + 0.0 AS improvement_over_random FROM oc WHERE model = 'frequency'"""))
def _(spark, folder):
    t = draws(spark, folder)
    return evaluate.model_quality(count_scores(t, models=("frequency",)), t.domain)


@query("payoff_table", """
WITH h AS (SELECT h, m FROM range(6) a(h), range(2) b(m)),
p(h, m, amount) AS (VALUES (5, 1, 7000000.0), (5, 0, 25241.0), (4, 1, 1402.0), (4, 0, 108.0), (3, 1, 61.0), (3, 0, 11.0), (2, 1, 12.0), (1, 1, 2.0), (0, 1, 1.0)),
x AS (SELECT l_linenumber % 6 AS h, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS m FROM lineitem)
SELECT CAST(x.h AS BIGINT) AS hits, CAST(x.m AS BIGINT) AS special_hit, count(*) AS n, CAST(round(sum(coalesce(amount, 0.0)), 2) AS DOUBLE) AS total FROM x LEFT JOIN p ON p.h = x.h AND p.m = x.m GROUP BY ALL""")
def _(spark, folder):
    from setstride.config import PRIZES
    from setstride.plans.common import table

    lines = table(spark, folder, "lineitem").select(
        (F.col("l_linenumber") % 6).alias("hits"), (F.col("l_returnflag") == "R").cast("int").alias("special_hit")
    )
    # Nine rows, fixed by the game.
    prizes = spark.createDataFrame([(h, int(s), a) for (h, s), a in PRIZES.items()], "hits int, special_hit int, amount double")
    paid = lines.join(F.broadcast(prizes), ["hits", "special_hit"], "left")
    return paid.groupBy("hits", "special_hit").agg(F.count("*").alias("n"), F.round(F.sum(F.coalesce("amount", F.lit(0.0))), 2).alias("total"))
