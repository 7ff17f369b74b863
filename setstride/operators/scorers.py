"""Scorers: every candidate item of every step at once, as one score array per step and model.

A scorer returns series_id, ord, step_id, ts, items, special, model, score, ranked, picks, special_pick.
`ranked` lists all items (score descending, item ascending), `picks` its first five; `special_pick` is
null where a model has none.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from setstride.config import MID_WINDOW, SHORT_WINDOW, VOTE_TENTHS
from setstride.functions.arrays import array_total, let, ranked_items
from setstride.operators.kernels import (
    Batches, Shape, average, context_kernel, count_models, joint_kernel, outcome_shape, picks_shape, ranked_shape, ranking_kernel, slot_kernel, votes,
)
from setstride.operators.layout import SERIES, StepTable, by_block, spread
from setstride.operators.pairs import context_rows, joint_rows
from setstride.operators.state import in_span, slot_rows

KEYS = [SERIES, "ord", "step_id", "ts", "items", "special"]
Span = tuple[int, int] | None


def scored(df: DataFrame, table: StepTable, *models: tuple[str, Column, Column]) -> DataFrame:
    """Attach picks to one or more (model, score, special_pick) columns of the same step rows."""
    entry = F.array(
        *[F.struct(F.lit(m).alias("model"), s.alias("score"), p.cast("int").alias("special_pick")) for m, s, p in models]
    )
    rows = df.select(*KEYS, F.explode(entry).alias("_s")).select(*KEYS, "_s.*")
    ranked = rows.withColumn("ranked", ranked_items(F.col("score")))
    return ranked.select(
        *KEYS, "model", "score", "ranked", F.slice("ranked", 1, table.domain.pick).alias("picks"), "special_pick"
    )


#: Weights of the frequency score: 0.5 all + 0.3 last 50 + 0.2 last 20 appearances, times 100 so that ties are exact.
FREQUENCY = {"cnt": 50, f"r{MID_WINDOW}": 30, f"r{SHORT_WINDOW}": 20}
COUNTED = ("frequency", "bayesian", "markov")


RANKED = "score array<double>, ranked array<int>, picks array<int>, special_pick int"


def _counted(
    table: StepTable, span: Span, models: tuple[str, ...], combine: Callable[[dict], dict] | None = None, shape: Shape | None = None,
    made: str = RANKED, keep: list[str] = KEYS, after: Callable[[Batches], Batches] | None = None,
) -> DataFrame:
    """The count models over one pass of the blocks that each needs: state, scores and ranks stay inside the kernel.

    `shape` makes the columns that leave it, `made` names them and `keep` those of the step; `after` is a kernel over its rows in the same task.
    """
    windows = (SHORT_WINDOW, MID_WINDOW) if "frequency" in models else ()
    want, items, specials = ("cnt", "last"), table.domain.items, table.domain.specials
    if models == ("markov",):
        steps, carry = context_rows(table, "next", span)
        rows = by_block(steps.withColumn("own", F.lit(True)).unionByName(carry, allowMissingColumns=True), table.rows)
        state = context_kernel(KEYS, items, specials, "next")
    elif "markov" in models:
        rows = joint_rows(table, windows, want, "next", span)
        state = joint_kernel(KEYS, items, specials, windows, want, "next")
    else:
        rows = by_block(slot_rows(table, windows, want, span), table.rows)
        state = slot_kernel(KEYS, items + specials, windows, want)
    schema = StructType([*rows.select(*keep).schema.fields, StructField("model", StringType()), *StructType.fromDDL(made).fields])

    def score(batch):
        scores = count_models(batch, models, items, FREQUENCY)
        return scores if combine is None else combine(scores)

    kernel = ranking_kernel(state, KEYS if after else keep, max(1, span[0] if span else 1), score, shape or ranked_shape(table.domain.pick))
    return rows.mapInArrow(kernel if after is None else lambda batches: after(kernel(batches)), schema)


def count_scores(table: StepTable, span: Span = None, models: tuple[str, ...] = ("frequency", "bayesian")) -> DataFrame:
    return _counted(table, span, models)


def markov_scores(table: StepTable, span: Span = None) -> DataFrame:
    return _counted(table, span, ("markov",))


def count_ensemble(table: StepTable, span: Span = None, models: tuple[str, ...] = COUNTED) -> DataFrame:
    """`ensemble_votes` of count models, taken beside their scores: no step's models have to be gathered."""
    pick = table.domain.pick
    return _counted(table, span, models, lambda made: votes(made, VOTE_TENTHS, pick))


def average_picks(table: StepTable, span: Span = None, models: tuple[str, ...] = ("frequency", "bayesian"), name: str = "average") -> DataFrame:
    """Picks and largest score of the `average_scores` of count models, taken beside their scores, which stay in the task."""
    return _counted(table, span, models, lambda made: average(made, name), picks_shape(table.domain.pick), "picks array<int>, special_pick int, best_score double", [SERIES, "ord"])


def count_outcomes(table: StepTable, models: tuple[str, ...] = ("frequency", "markov", "bayesian"), span: Span = None) -> DataFrame:
    """hits and mean_rank of every step of count models, taken beside their scores."""
    shape, made = outcome_shape(table.domain.pick), "special_pick int, hits int, mean_rank double"
    return _counted(table, span, tuple(m for m in COUNTED if m in models), None, shape, made, [SERIES, "ord", "step_id", "ts", "special"])


def count_tickets(table: StepTable, models: tuple[str, ...], span: Span, keep: list[str], kernel: Callable[[Batches], Batches]) -> DataFrame:
    """A ticket kernel over the scores of count models, in the task that makes them; steps without a special have none."""

    def revealed(batches: Batches) -> Batches:
        return kernel(b.filter(b.column(b.schema.get_field_index("special")).is_valid()) for b in batches)

    made = "special_pick int, tickets array<array<int>>, ticket_hits array<int>"
    return _counted(table, span, tuple(m for m in COUNTED if m in models), made=made, keep=keep, after=revealed)


def normalised(score: Column) -> Column:
    return let(
        array_total(score), lambda total: F.transform(score, lambda s: F.coalesce(F.try_divide(s, total), F.lit(0.0)))
    )


def ensemble_votes(predictions: DataFrame, table: StepTable, weights: dict[str, int] | None = None) -> DataFrame:
    """Weighted votes for the picks of every model present; the score is the vote in tenths."""
    weights = weights or VOTE_TENTHS
    weight = F.create_map(*[F.lit(v) for pair in weights.items() for v in pair])
    voters = predictions.groupBy(SERIES, "ord").agg(
        *[F.any_value(c).alias(c) for c in KEYS[2:]],
        F.collect_list(F.struct(F.coalesce(F.try_element_at(weight, F.col("model")), F.lit(10)).alias("w"), "picks")).alias("_v"),
    )
    score = F.transform(
        F.sequence(F.lit(1), F.lit(table.domain.items)),
        lambda n: F.aggregate(
            "_v",
            F.lit(0.0),
            lambda acc, v: acc + F.when(F.array_contains(v["picks"], n), v["w"]).otherwise(F.lit(0)),
        ),
    )
    return scored(voters, table, ("ensemble", score, F.lit(None).cast("int")))


def average_scores(predictions: DataFrame, table: StepTable, name: str = "average") -> DataFrame:
    """Mean of the models' normalised scores per candidate."""
    gathered = predictions.groupBy(SERIES, "ord").agg(
        *[F.any_value(c).alias(c) for c in KEYS[2:]],
        F.array_sort(F.collect_list(F.struct("model", normalised(F.col("score")).alias("p")))).alias("_v"),
    )
    score = F.transform(
        F.sequence(F.lit(0), F.lit(table.domain.items - 1)),
        lambda i: F.round(
            F.aggregate("_v", F.lit(0.0), lambda acc, v: acc + F.get(v["p"], i)) / F.size("_v"), 12
        ),
    )
    return scored(gathered, table, (name, score, F.lit(None).cast("int")))


Scorer = Callable[[StepTable, Span], DataFrame]
Refitted = Callable[[StepTable, list[int], int | None], DataFrame]
REGISTRY: dict[str, Scorer] = {}
REFITTED: dict[str, Refitted] = {}


def register(name: str, scorer: Scorer) -> None:
    """Add a scorer: any function (steps, span) -> the scorer columns documented above."""
    REGISTRY[name] = scorer


def register_refitted(name: str, walk: Refitted) -> None:
    """Add a scorer that is fitted: any function (steps, fit ordinals, end) -> scores of the steps from the first fit up to `end`."""
    REFITTED[name] = walk


def refitted(name: str) -> Refitted | None:
    """The walk of a fitted scorer; None for one whose state follows every step."""
    importlib.import_module("setstride.operators.learners")
    return REFITTED.get(name)


def scorer(name: str) -> Scorer:
    importlib.import_module("setstride.operators.learners")  # registers the learned ones and the neighbours
    if name not in REGISTRY:
        raise ValueError(f"unknown scorer {name!r}; known: {', '.join(sorted(REGISTRY))}")
    return REGISTRY[name]


def predictions(table: StepTable, models: tuple[str, ...] = ("frequency", "markov", "bayesian"), span: Span = None) -> DataFrame:
    """All named scorers over the steps; scorers that read the same state share one pass."""
    shared = tuple(m for m in models if m in COUNTED) if set(models) & {"frequency", "bayesian"} else ()
    parts = [count_scores(table, span, shared)] if shared else []
    parts += [scorer(m)(table, span) for m in models if m not in shared]
    return reduce(DataFrame.unionByName, parts)


def block_scorer(name: str, reach: int, score_block: Callable[[pd.DataFrame], pd.DataFrame]) -> Scorer:
    """A scorer from a user's pandas function over one block of steps and the `reach` steps before it.

    `score_block` gets ord, items, special and own (False on the steps that are only context), sorted by
    ord, and returns ord and score (one number per item) for the own steps. A block has a bounded size,
    so a series of any length stays distributed.
    """

    def scores(table: StepTable, span: Span = None) -> DataFrame:
        source = in_span(table.df.select(*KEYS), table, span, reach)
        rows = spread(source, table.block, reach)
        kind = rows.schema[SERIES].dataType.simpleString()

        def run(key, pdf):
            out = score_block(pdf[["ord", "items", "special", "own"]].sort_values("ord"))
            return out.assign(**{SERIES: key[0]})[[SERIES, "ord", "score"]]

        made = rows.groupBy(SERIES, "block").applyInPandas(run, f"{SERIES} {kind}, ord long, score array<double>")
        joined = table.df.select(*KEYS).join(made, [SERIES, "ord"])
        if span is not None:
            joined = joined.where(F.col("ord").between(span[0], span[1] - 1))
        return scored(joined, table, (name, F.col("score"), F.lit(None).cast("int")))

    return scores


register("frequency", lambda table, span=None: count_scores(table, span, ("frequency",)))
register("bayesian", lambda table, span=None: count_scores(table, span, ("bayesian",)))
register("markov", markov_scores)
VOTERS = ("frequency", "markov", "bayesian", "knn", "decision_tree", "genetic")
register("ensemble", lambda table, span=None: ensemble_votes(predictions(table, VOTERS, span), table))
