"""Walk-forward evaluation: hits, payoff, folds, schedules, drift, multi-ticket returns, AUC."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from setstride.config import INITIAL_STEPS, MAX_TICKETS, REFIT_EVERY, TICKET_CANDIDATES, TICKET_COST, Domain
from setstride.functions.arrays import expected_prize, hits, mean_rank, prize
from setstride.functions.stats import student_p
from setstride.operators.kernels import ticket_kernel
from setstride.operators.layout import SERIES, StepTable, halo_window, running_totals, spread
from setstride.operators.scorers import COUNTED, KEYS, count_outcomes, count_tickets, normalised, predictions, refitted

COUNT_MODELS = ("frequency", "markov", "bayesian")


def outcomes(scores: DataFrame, domain: Domain) -> DataFrame:
    """Score each revealed step: hits, special_hit, prize (0 without a special pick), ev, mean_rank."""
    h = hits(F.col("picks"), F.col("items"), domain.pick)
    return paid_outcomes(scores.withColumn("hits", h).withColumn("mean_rank", mean_rank(F.col("ranked"), F.col("items"))), domain)


def paid_outcomes(rows: DataFrame, domain: Domain) -> DataFrame:
    """Rows of revealed steps that know their hits, with special_hit, prize and ev."""
    special_hit = F.col("special_pick") == F.col("special")
    return (
        rows.where(F.col("special").isNotNull())
        .withColumn("special_hit", F.coalesce(special_hit, F.lit(False)))
        .withColumn("prize", F.when(F.col("special_pick").isNull(), 0.0).otherwise(prize(F.col("hits"), F.col("special_hit"))))
        .withColumn(
            "ev",
            F.when(F.col("special_pick").isNull(), expected_prize(F.col("hits"), domain.specials)).otherwise(F.col("prize")),
        )
    )


def walk_outcomes(table: StepTable, models: tuple[str, ...] = COUNT_MODELS, start: int | None = None) -> DataFrame:
    """`outcomes` of all steps, or of those from ord `start` on; count models make theirs beside the scores, which stay in the task."""
    span = None if start is None else (start, table.longest)
    if set(models) <= set(COUNTED):
        return paid_outcomes(count_outcomes(table, models, span), table.domain)
    return outcomes(predictions(table, models, span), table.domain)


def summary(rows: DataFrame, keys: list[str], domain: Domain) -> DataFrame:
    """The per-model (or per-fold) metric row over outcome rows."""
    counts = [F.count_if(F.col("hits") == h).alias(f"hit{h}") for h in range(domain.pick + 1)]
    base = rows.groupBy(*keys).agg(
        F.count("*").alias("n_draws"),
        F.avg("hits").alias("mean_hits"),
        (F.avg("hits") / domain.pick).alias("precision_at5"),
        F.avg((F.col("hits") > 0).cast("int")).alias("coverage"),
        *counts,
        F.avg("ev").alias("ev_per_draw"),
        F.sum("ev").alias("total_ev"),
        F.avg("mean_rank").alias("mean_rank"),
        F.stddev_samp("hits").alias("hits_std"),
    )
    return base.select(
        *keys,
        "n_draws",
        "mean_hits",
        "precision_at5",
        "coverage",
        *[f"hit{h}" for h in range(domain.pick + 1)],
        *[(F.col(f"hit{h}") / F.col("n_draws") * 100).alias(f"hit{h}_pct") for h in range(domain.pick + 1)],
        (F.col("mean_hits") - domain.random_hits).alias("vs_random_hits"),
        "ev_per_draw",
        (F.col("ev_per_draw") - TICKET_COST).alias("net_ev_per_draw"),
        ((F.col("ev_per_draw") - TICKET_COST) / TICKET_COST * 100).alias("roi_pct"),
        "total_ev",
        (F.col("n_draws") * TICKET_COST).alias("total_cost"),
        "mean_rank",
        (F.col("mean_rank") - (domain.items + 1) / 2).alias("vs_random_rank"),
        "hits_std",
    )


def against_random(metrics: DataFrame, domain: Domain) -> DataFrame:
    """One-sample t of the hit mean against random picking, two-sided p and direction (10 steps at least)."""
    t = F.try_divide(F.col("vs_random_hits"), F.col("hits_std") / F.sqrt("n_draws"))
    tested = metrics.withColumn("t_stat", F.when(F.col("n_draws") >= 10, t))
    return tested.withColumn("p_value", student_p(F.col("t_stat"), F.col("n_draws") - 1)).withColumn(
        "direction", F.when(F.col("t_stat") > 0, "better").when(F.col("t_stat") < 0, "worse").otherwise("none")
    )


# ---------------------------------------------------------------------------------------------------
# Folds by calendar months


def date_histogram(table: StepTable) -> DataFrame:
    """Steps per calendar date; every fold question below is answered on this small table."""
    return table.df.groupBy("ts").agg(F.count("*").alias("n"))


def fold_windows(dates: DataFrame, train: int = 24, test: int = 6, step: int = 6) -> DataFrame:
    """fold (1-based), test_start, test_end of every window that ends inside the data."""
    if min(train, test, step) <= 0:
        raise ValueError("train, test and step months must be positive")
    bounds = dates.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    most = F.ceil(F.months_between("hi", "lo") / step).cast("int")
    starts = bounds.withColumn("_k", F.explode(F.sequence(F.lit(0), F.greatest(most, F.lit(0)))))
    anchor = F.add_months("lo", train)
    return (
        starts.select(
            (F.col("_k") + 1).alias("fold"),
            F.add_months(anchor, F.col("_k") * step).alias("test_start"),
            F.add_months(F.add_months(anchor, F.col("_k") * step), test).alias("test_end"),
            "hi",
        )
        .where(F.col("test_end") <= F.date_add("hi", 1))
        .drop("hi")
    )


def require_folds(dates: DataFrame, train: int, test: int) -> None:
    """Raise when the data do not reach the end of the first test window."""
    lo, hi = dates.agg(F.min("ts"), F.max("ts")).first()
    row = dates.sparkSession.range(1).select(F.add_months(F.add_months(F.lit(lo), train), test).alias("e")).first()
    if row["e"] > hi:
        raise ValueError(f"{train + test} months are needed, the data end at {hi}")


def fold_summary(dates: DataFrame, train: int = 24, test: int = 6, step: int = 6, least_train: int = 50, least_test: int = 5) -> DataFrame:
    """Dates and sizes of each fold; folds with too few steps are skipped but keep their number.

    Both sides are calendar-sized (dates x month windows), so the range condition stays cheap.
    """
    windows = fold_windows(dates, train, test, step)
    near = dates.join(windows, F.col("ts") < F.col("test_end"))
    in_train = F.col("ts") < F.col("test_start")
    return (
        near.groupBy("fold", F.col("test_start").alias("window_start"), F.col("test_end").alias("window_end"))
        .agg(
            F.min(F.when(in_train, F.col("ts"))).alias("train_start"),
            F.max(F.when(in_train, F.col("ts"))).alias("train_end"),
            F.min(F.when(~in_train, F.col("ts"))).alias("test_start"),
            F.max(F.when(~in_train, F.col("ts"))).alias("test_end"),
            F.coalesce(F.sum(F.when(in_train, F.col("n"))), F.lit(0)).alias("n_train"),
            F.coalesce(F.sum(F.when(~in_train, F.col("n"))), F.lit(0)).alias("n_test"),
        )
        .where((F.col("n_train") >= least_train) & (F.col("n_test") >= least_test))
    )


def fold_dates(dates: DataFrame, **months: int) -> DataFrame:
    """Which folds test which date: the table that turns the interval join into an equi-join on date."""
    folds = fold_summary(dates, **months).select("fold", "window_start", "window_end")
    return dates.join(folds, (F.col("ts") >= F.col("window_start")) & (F.col("ts") < F.col("window_end"))).select("ts", "fold")


def fold_walk(table: StepTable, models: tuple[str, ...] = ("frequency", "markov", "bayesian"), **months: int) -> DataFrame:
    """Outcome rows of every model with their test fold."""
    return walk_outcomes(table, models).join(fold_dates(date_histogram(table), **months), "ts")


def across_folds(per_fold: DataFrame, *more: Column) -> DataFrame:
    """Mean and population deviation over the folds of each model."""
    return per_fold.groupBy("model").agg(
        F.count("*").alias("n_folds"),
        F.avg("mean_hits").alias("mean_hits_avg"),
        F.stddev_pop("mean_hits").alias("mean_hits_std"),
        F.avg("precision_at5").alias("precision_at5_avg"),
        F.stddev_pop("precision_at5").alias("precision_at5_std"),
        F.avg("coverage").alias("coverage_avg"),
        F.avg("ev_per_draw").alias("ev_avg"),
        F.avg("net_ev_per_draw").alias("net_ev_avg"),
        (F.avg("net_ev_per_draw") / TICKET_COST * 100).alias("roi_pct"),
        *more,
    )


def compare_models(rows: DataFrame, domain: Domain) -> DataFrame:
    """One row per model over its folds, with the pooled t test against random picking.

    The test pools the folds' counts of hits, so the walk is scored once.
    """
    per_fold = summary(rows, ["model", "fold"], domain)
    counts = [F.sum(f"hit{h}") for h in range(domain.pick + 1)]
    n, one, two = (sum((c * h**power for h, c in enumerate(counts)), F.lit(0)) for power in (0, 1, 2))
    pooled = across_folds(per_fold, n.alias("n_draws"), one.alias("_one"), two.alias("_two"))
    n, one, two = F.col("n_draws"), F.col("_one"), F.col("_two")
    variance = F.try_divide(n * two - one * one, n * (n - 1))
    tested = against_random(
        pooled.withColumn("vs_random_hits", one / n - domain.random_hits).withColumn("hits_std", F.sqrt(variance)), domain
    )
    return tested.drop("_one", "_two", "vs_random_hits", "hits_std")


# ---------------------------------------------------------------------------------------------------
# Prequential walk


def stale_scores(scores: DataFrame, table: StepTable, every: int, initial: int = INITIAL_STEPS) -> DataFrame:
    """Refit schedule: a prediction made at initial, initial + every, ... serves the steps up to the next refit."""
    if every <= 1:
        return scores
    fits = scores.where((F.col("ord") >= initial) & ((F.col("ord") - initial) % every == 0))
    served = fits.select(
        SERIES,
        F.explode(F.sequence(F.col("ord"), F.col("ord") + (every - 1))).alias("ord"),
        F.col("ord").alias("fit_ord"),
        "model",
        "score",
        "ranked",
        "picks",
        "special_pick",
    )
    facts = table.df.select(SERIES, "ord", "step_id", "ts", "items", "special")
    return facts.join(served, [SERIES, "ord"])


TICKET_KEYS = [SERIES, "ord", "step_id", "ts", "model", "items", "special", "special_pick"]


def best_tickets(scores: DataFrame, domain: Domain, tickets: int = MAX_TICKETS, candidates: int = TICKET_CANDIDATES) -> DataFrame:
    """Each scored step with its best combinations of the first `candidates` items: tickets, ticket_hits (parallel arrays)."""
    kept = scores.select(*TICKET_KEYS, "score", "ranked")
    schema = kept.select(*TICKET_KEYS, F.lit(None).cast("array<array<int>>").alias("tickets"), F.lit(None).cast("array<int>").alias("ticket_hits")).schema
    return kept.mapInArrow(ticket_kernel(TICKET_KEYS, candidates, domain.pick, tickets), schema)


def ticket_steps(scores: DataFrame, domain: Domain, tickets: int = MAX_TICKETS, candidates: int = TICKET_CANDIDATES) -> DataFrame:
    """The best tickets of each revealed step, one row per step and model, with `ticket_prizes` beside them."""
    return paid_tickets(best_tickets(scores.where(F.col("special").isNotNull()), domain, tickets, candidates), domain)


def paid_tickets(made: DataFrame, domain: Domain) -> DataFrame:
    known = F.col("special_pick") == F.col("special")
    paid = F.when(F.col("special_pick").isNull(), F.transform("ticket_hits", lambda h: expected_prize(h, domain.specials))).otherwise(
        F.transform("ticket_hits", lambda h: prize(h, known))
    )
    return made.withColumn("ticket_prizes", paid)


def walk_tickets(table: StepTable, models: tuple[str, ...] = COUNT_MODELS, start: int = INITIAL_STEPS, tickets: int = MAX_TICKETS, candidates: int = TICKET_CANDIDATES) -> DataFrame:
    """`ticket_steps` of count models from ord `start` on, made in the tasks that score them."""
    kernel = ticket_kernel([*KEYS, "model", "special_pick"], candidates, table.domain.pick, tickets)
    return paid_tickets(count_tickets(table, models, (start, table.longest), KEYS, kernel), table.domain)


def ticket_rows(steps: DataFrame) -> DataFrame:
    """One row per ticket of each step of `ticket_steps`: columns ticket (1-based), numbers, ticket_hits, ticket_prize."""
    rows = steps.select(*TICKET_KEYS, F.posexplode(F.arrays_zip("tickets", "ticket_hits", "ticket_prizes")).alias("_at", "_t"))
    return rows.select(
        *TICKET_KEYS, (F.col("_at") + 1).alias("ticket"), F.col("_t.tickets").alias("numbers"), "_t.ticket_hits", F.col("_t.ticket_prizes").alias("ticket_prize")
    )


def prequential(
    table: StepTable,
    models: tuple[str, ...] = ("frequency", "markov", "bayesian"),
    initial: int = INITIAL_STEPS,
    test: int | None = None,
    every: dict[str, int] | None = None,
) -> DataFrame:
    """Scores of each model from ord `initial` on, for `test` steps or to the end, refit on the model's own schedule.

    A model of counts follows every step; refit every k steps, it serves its fit's prediction up to the next. A learned model is fitted
    at initial, initial + k, ... on the steps before, and scores the steps up to the next fit.
    """
    every = REFIT_EVERY if every is None else every
    end = table.longest if test is None else min(initial + test, table.longest)
    learned = [m for m in models if refitted(m)]
    followed = tuple(m for m in models if m not in learned)
    parts = []
    if followed:
        scores = predictions(table, followed, (initial, end))
        fresh = [m for m in followed if every.get(m, 1) <= 1]
        parts.append(scores.where(F.col("model").isin(fresh)).withColumn("fit_ord", F.col("ord")))
        parts += [stale_scores(scores.where(F.col("model") == m), table, every[m], initial).where(F.col("ord") < end) for m in followed if m not in fresh]
    for model in learned:
        step = max(every.get(model, 1), 1)
        scores = refitted(model)(table, list(range(initial, end, step)), end)
        parts.append(scores.withColumn("fit_ord", F.col("ord") - F.pmod(F.col("ord") - initial, F.lit(step))))
    return reduce(DataFrame.unionByName, parts)


def _paid(k: int) -> Column:
    """What the first `k` tickets of a step pay."""
    return F.aggregate(F.slice("ticket_prizes", 1, k), F.lit(0.0), lambda a, p: a + p)


def multi_ticket(steps: DataFrame, tickets: int = MAX_TICKETS) -> DataFrame:
    """Return of buying the first 1..K tickets each step, per model; running sums stay inside the row."""
    means = steps.groupBy("model").agg(*[F.avg(_paid(k)).alias(f"_{k}") for k in range(1, tickets + 1)])
    rows = means.select("model", F.posexplode(F.array(*[f"_{k}" for k in range(1, tickets + 1)])).alias("_at", "ev_per_draw"))
    cost = (F.col("_at") + 1) * TICKET_COST
    return rows.select(
        "model", (F.col("_at") + 1).alias("buy_n"), "ev_per_draw", cost.alias("cost_per_draw"),
        (F.col("ev_per_draw") - cost).alias("net_ev"), ((F.col("ev_per_draw") - cost) / cost * 100).alias("roi_pct"),
    )


def drift(rows: DataFrame, table: StepTable, origin: int = 0, window: int = 51, every: int = 50) -> DataFrame:
    """Moving mean of hits over `window` rows, reported at positions every-1, 2*every-1, ... of the walk."""
    at = rows.select(SERIES, "model", (F.col("ord") - origin).alias("ord"), "hits")
    ordered = halo_window("model")
    sums = spread(at, table.block, window - 1).select(
        "*", F.row_number().over(ordered).alias("_k"), F.sum("hits").over(ordered.rowsBetween(Window.unboundedPreceding, 0)).alias("_sum")
    )
    moved = F.col("_sum") - F.lag("_sum", window, 0).over(ordered)  # no row adds up its frame anew
    return (
        sums.withColumn("moving_avg", moved / F.least("_k", F.lit(window)))
        .where(F.col("own") & (F.col("ord") % every == every - 1))
        .select(SERIES, "model", F.col("ord").alias("position"), "moving_avg")
    )


def walk_report(scores: DataFrame, table: StepTable, tickets: int = MAX_TICKETS) -> DataFrame:
    return ticket_report(ticket_steps(scores, table.domain, tickets), table, tickets)


def ticket_report(steps: DataFrame, table: StepTable, tickets: int = MAX_TICKETS) -> DataFrame:
    """Per model, from one pass over `ticket_steps`: metrics of the first ticket, shares of its hits and the 1..K ticket returns."""
    first = steps.withColumn("hits", F.get("ticket_hits", F.lit(0))).withColumn("ev", F.get("ticket_prizes", F.lit(0)))
    n, pick = F.col("n_draws"), table.domain.pick
    rows = first.groupBy("model").agg(
        F.count("*").alias("n_draws"), F.avg("hits").alias("avg_hits"), F.avg("ev").alias("ev_per_draw"),
        *[F.count_if(F.col("hits") == h).alias(f"_h{h}") for h in range(pick + 1)],
        *[F.avg(_paid(k)).alias(f"buy{k}_ev") for k in range(1, tickets + 1)],
    )
    return rows.select(
        "model", "n_draws", "avg_hits", (F.col("avg_hits") / pick).alias("prec_at5"), (F.col("avg_hits") - table.domain.random_hits).alias("vs_random"),
        "ev_per_draw", (F.col("ev_per_draw") - TICKET_COST).alias("net_ev"), ((F.col("ev_per_draw") - TICKET_COST) / TICKET_COST * 100).alias("roi_pct"),
        *[
            c for k in range(1, tickets + 1) for c in (
                F.col(f"buy{k}_ev"), (F.col(f"buy{k}_ev") - k * TICKET_COST).alias(f"buy{k}_net_ev"),
                ((F.col(f"buy{k}_ev") - k * TICKET_COST) / (k * TICKET_COST) * 100).alias(f"buy{k}_roi"),
            )
        ],
        *[(F.col(f"_h{h}") / n * 100).alias(f"hit{h}_pct") for h in range(pick + 1)],
    )


def next_step_document(table: StepTable, models: tuple[str, ...], votes: int = 10, consensus: int = 5) -> DataFrame:
    """One row per series with a JSON `document` for its open step: each model's picks, special and tickets, the items with the
    most votes and the consensus (all sized by the models and the vocabulary)."""
    opened, span = table.with_request(), (table.longest, table.longest + 1)
    scores = predictions(opened, models, span)
    made = best_tickets(scores, table.domain).select(SERIES, "ord", "model", "special_pick", "tickets").join(scores.select(SERIES, "ord", "model", "picks"), [SERIES, "ord", "model"])
    counted = made.select(SERIES, F.explode("picks").alias("item")).groupBy(SERIES, "item").agg(F.count("*").alias("votes"))
    ranked = counted.groupBy(SERIES).agg(F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("down"), "item"))).alias("_v"))
    entry = F.struct("model", F.array_sort("picks").alias("items"), F.col("special_pick").alias("special"), "tickets")
    models_of = made.groupBy(SERIES, "ord").agg(F.sort_array(F.collect_list(entry)).alias("models"))
    top = F.transform(F.slice("_v", 1, votes), lambda v: F.struct(v["item"].alias("item"), (-v["down"]).alias("votes")))
    chosen = F.array_sort(F.transform(F.slice("_v", 1, consensus), lambda v: v["item"]))
    return models_of.join(ranked, SERIES).select("ord", F.to_json(F.struct("ord", "models", top.alias("votes"), chosen.alias("consensus"))).alias("document"))


# ---------------------------------------------------------------------------------------------------
# Score quality


def chronological_split(table: StepTable, ratio: float) -> tuple[DataFrame, DataFrame]:
    """First floor(n * ratio) steps of each series, and the rest."""
    lengths = table.df.groupBy(SERIES).agg(F.floor((F.max("ord") + 1) * ratio).alias("_cut"))
    marked = table.df.join(lengths, SERIES)
    return marked.where("ord < _cut").drop("_cut"), marked.where("ord >= _cut").drop("_cut")


def last_steps(table: StepTable, n: int) -> tuple[DataFrame, DataFrame]:
    """Everything before the last `n` steps of each series, and those n steps."""
    lengths = table.df.groupBy(SERIES).agg((F.max("ord") + 1 - n).alias("_cut"))
    marked = table.df.join(lengths, SERIES)
    return marked.where("ord < _cut").drop("_cut"), marked.where("ord >= _cut").drop("_cut")


def item_auc(scores: DataFrame, domain: Domain) -> DataFrame:
    """Rank-sum AUC of each item's score over the steps, ties counted half.

    Equal scores are merged first; the running count of lower negatives is then taken along a range
    partitioning of (item, score), so no task has to hold all steps of an item.
    """
    labels = F.transform(F.sequence(F.lit(1), F.lit(domain.items)), lambda n: F.array_contains("items", n).cast("int"))
    cells = (
        scores.where(F.col("special").isNotNull())
        .select(F.posexplode(F.arrays_zip(normalised(F.col("score")).alias("p"), labels.alias("y"))).alias("_at", "_v"))
        .groupBy((F.col("_at") + 1).alias("item"), F.col("_v.p").alias("p"))
        .agg(F.sum("_v.y").alias("pos"), F.sum(1 - F.col("_v.y")).alias("neg"))
    )
    ranked = running_totals(cells, "item", "p", {"below": "neg"})
    won = F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2))
    return ranked.groupBy("item").agg(
        F.try_divide(won, (F.sum("pos") * F.sum("neg")).cast("double")).alias("auc"),
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
    )


def step_auc(scores: DataFrame, domain: Domain) -> DataFrame:
    """AUC inside each step (the fallback when an item never occurs), from the ranks of its actual items."""
    score = F.col("score")

    def won(a: Column) -> Column:
        s = F.get(score, a - 1)
        rest = F.transform(score, lambda v, i: F.when(F.array_contains("items", i + 1), 0.0).when(v < s, 1.0).when(v == s, 0.5).otherwise(0.0))
        return F.aggregate(rest, F.lit(0.0), lambda acc, x: acc + x)

    total = F.aggregate(F.transform("items", won), F.lit(0.0), lambda acc, x: acc + x)
    n = F.size("items")
    return scores.where(F.col("special").isNotNull()).select(
        SERIES, "ord", "model", (total / (n * (F.lit(domain.items) - n))).alias("auc")
    )


def model_quality(scores: DataFrame, domain: Domain) -> DataFrame:
    """precision@5, macro AUC, random baseline and the improvement over it, for one model's scores."""
    p = outcomes(scores, domain).agg(
        (F.avg("hits") / domain.pick).alias("precision_at_5"), F.avg("hits").alias("avg_hits")
    )
    per_item = item_auc(scores, domain).agg(
        F.avg("auc").alias("_macro"), F.count_if(F.col("auc").isNull()).alias("_missing")
    )
    per_step = step_auc(scores, domain).agg(F.avg("auc").alias("_samples"))
    one_row = F.lit(1)
    return (
        p.withColumn("_k", one_row)
        .join(per_item.withColumn("_k", one_row), "_k")
        .join(per_step.withColumn("_k", one_row), "_k")
        .select(
            "precision_at_5",
            "avg_hits",
            F.when(F.col("_missing") == 0, F.col("_macro")).otherwise(F.col("_samples")).alias("auc_roc_macro"),
            F.lit(domain.pick / domain.items).alias("random_baseline_p5"),
            (F.col("precision_at_5") - F.lit(domain.pick / domain.items)).alias("improvement_over_random"),
        )
    )
