"""The 18-feature candidate grid and its relation to the label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setstride.functions.stats import student_p
from setstride.operators.kernels import half_up, joint_kernel, left_open_bins, moments_kernel, rates_kernel
from setstride.operators.layout import SERIES, StepTable
from setstride.operators.pairs import joint_rows, joint_state
from setstride.operators.patterns import last_step_features
from setstride.operators.state import average_gap, current_gap, item_grid, item_part

WINDOWS = (5, 10, 30, 100)
WARM_UP = 50
FEATURES = [
    "current_gap", "avg_gap", "gap_ratio", "gap_zscore", "freq_5", "freq_10", "freq_30", "freq_100",
    "freq_ratio_5_30", "appeared_last", "appeared_prev2", "cooccur_last", "last_sum", "last_odd_cnt",
    "last_high_cnt", "last_consec", "ball_is_odd", "ball_zone",
]


def feature_grid(table: StepTable, warm_up: int = WARM_UP, drop_last: bool = False) -> DataFrame:
    """series_id, ord, item, y and the 18 features of every candidate, as of just before the step."""
    state = joint_state(table, WINDOWS, ("cnt", "last", "first", "gsq"), "same").withColumnRenamed("score", "cooc")
    wide = state.where((F.col("ord") >= warm_up) & F.col("prev_items").isNotNull())
    if drop_last:
        ends = table.df.groupBy(SERIES).agg(F.max("ord").alias("_end"))
        wide = wide.join(ends, SERIES).where("ord < _end").drop("_end")
    part = {n: item_part(table, n) for n in ("cnt", "last", "first", "gsq", *[f"r{w}" for w in WINDOWS])}
    arrays = {
        "cnt": part["cnt"],
        "current_gap": current_gap(part["last"]),
        "avg_gap": average_gap(part["cnt"], part["last"], part["first"]),
        "gsq": part["gsq"],
        **{f"r{w}": part[f"r{w}"] for w in WINDOWS},
        "last": part["last"],
        "cooc": F.col("cooc"),
    }
    previous = {n: c for n, c in last_step_features(F.col("prev_items"), table.domain).items()}
    wide = wide.select("*", *[c.alias(n) for n, c in previous.items()])
    keep = [SERIES, "ord", *previous, "prev2_items", "prev_items", "items"]
    grid = item_grid(wide, table, arrays, keep)
    gaps = F.col("cnt") - 1
    spread = F.sqrt(F.greatest(F.col("gsq") / gaps - F.col("avg_gap") * F.col("avg_gap"), F.lit(0.0)))
    f5, f30 = F.col("r5") / 5.0, F.col("r30") / 30.0
    columns = {
        "current_gap": F.col("current_gap").cast("double"),
        "avg_gap": F.col("avg_gap"),
        "gap_ratio": F.when(F.col("avg_gap") > 0, F.col("current_gap") / F.col("avg_gap")).otherwise(1.0),
        "gap_zscore": F.when(
            gaps > 0, (F.col("current_gap") - F.col("avg_gap")) / F.greatest(spread, F.lit(1.0))
        ).otherwise(0.0),
        "freq_5": f5,
        "freq_10": F.col("r10") / 10.0,
        "freq_30": f30,
        "freq_100": F.col("r100") / F.least(F.lit(100), F.col("ord")),
        "freq_ratio_5_30": f5 / F.greatest(f30, F.lit(1e-6)),
        "appeared_last": F.array_contains("prev_items", F.col("item")).cast("int"),
        "appeared_prev2": F.coalesce(F.array_contains("prev2_items", F.col("item")).cast("int"), F.lit(0)),
        "cooccur_last": F.when(F.col("ord") >= 2, F.col("cooc") / F.col("ord")).otherwise(0.0),
        **{n: F.col(n) for n in previous},
        "ball_is_odd": F.col("item") % 2,
        "ball_zone": F.floor((F.col("item") - 1) / 10),
    }
    return grid.select(SERIES, "ord", "item", "y", *[columns[n].cast("double").alias(n) for n in FEATURES])


def correlations(grid: DataFrame) -> DataFrame:
    """Point-biserial correlation of every feature with the label.

    Rows are turned into (feature, x, y) inside the task: one small aggregate over 18 groups compiles,
    54 aggregates side by side do not. Partial sums leave 18 rows per task for the shuffle.
    """
    entries = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("x")) for f in FEATURES])
    long = grid.select("y", F.explode(entries).alias("_e")).select("y", "_e.*")
    y = F.col("y")
    rows = long.groupBy("feature").agg(
        F.count("*").alias("n"),
        F.corr("x", y.cast("double")).alias("corr"),
        F.avg(F.when(y == 1, F.col("x"))).alias("mean_appear"),
        F.avg(F.when(y == 0, F.col("x"))).alias("mean_not_app"),
    )
    return tested(rows)


def tested(rows: DataFrame) -> DataFrame:
    """t, p and significance beside feature, n, corr, mean_appear and mean_not_app."""
    r = F.col("corr")
    t = F.try_divide(r * F.sqrt(F.col("n") - 2), F.sqrt(1 - r * r))
    known = rows.withColumn("t_stat", t).withColumn("p_value", student_p(F.col("t_stat"), F.col("n") - 2))
    p = F.col("p_value")
    return known.select(
        "feature", "corr", F.abs("corr").alias("abs_corr"), "t_stat", "p_value",
        F.round("mean_appear", 4).alias("mean_appear"),
        F.round("mean_not_app", 4).alias("mean_not_app"),
        F.round(F.col("mean_appear") - F.col("mean_not_app"), 4).alias("delta"),
        F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise("").alias("sig"),
        "n",
    )


def _blocks(table: StepTable):
    """The blocks and the state kernel behind the grid of all candidates, for sums that leave no step."""
    want = ("cnt", "last", "first", "gsq")
    keep = [SERIES, "ord", "items", "prev_items", "prev2_items"]
    return joint_rows(table, WINDOWS, want, "same"), joint_kernel(keep, table.domain.items, table.domain.specials, WINDOWS, want, "same")


def grid_correlations(table: StepTable, warm_up: int = WARM_UP) -> DataFrame:
    """`correlations` of the whole grid, from sums of each task: no candidate becomes a row."""
    rows, state = _blocks(table)
    d = table.domain
    centre = dict.fromkeys(FEATURES, 0.0) | {"current_gap": d.items / d.pick, "avg_gap": d.items / d.pick, "last_sum": d.pick * (d.items + 1) / 2}
    sums = rows.mapInArrow(moments_kernel(state, d.items, d.low_max, warm_up, centre), "feature string, n long, sy double, sx double, sxx double, sxy double")
    whole = sums.groupBy("feature").agg(*[F.sum(c).alias(c) for c in ("n", "sy", "sx", "sxx", "sxy")]).where("n > 0")
    n, sy, sx, sxx, sxy = (F.col(c) for c in ("n", "sy", "sx", "sxx", "sxy"))
    middle = F.element_at(F.create_map(*[F.lit(v) for pair in centre.items() for v in pair]), F.col("feature"))
    together = F.sqrt((n * sxx - sx * sx) * (n * sy - sy * sy))
    return tested(
        whole.select(
            "feature", "n", F.try_divide(n * sxy - sx * sy, together).alias("corr"),
            (middle + F.try_divide(sxy, sy)).alias("mean_appear"), (middle + F.try_divide(sx - sxy, n - sy)).alias("mean_not_app"),
        )
    )


def grid_response(table: StepTable, feature: str, edges: list[float] | None = None, digits: int | None = None, warm_up: int = WARM_UP) -> DataFrame:
    """`response` of the whole grid to a feature, a whole number or cut by `edges` after rounding: groups are counted in the tasks."""
    rows, state = _blocks(table)
    d = table.domain

    def group(grid):
        x = grid[feature] if digits is None else half_up(grid[feature], digits)
        return x if edges is None else left_open_bins(x, edges)

    counts = rows.mapInArrow(rates_kernel(state, d.items, d.low_max, warm_up, group), "bin int, n long, hit long")
    return counts.groupBy("bin").agg((F.sum("hit") / F.sum("n")).alias("rate"), F.sum("n").alias("n"))


def binned(column: Column, edges: list[float]) -> Column:
    """Index of the left-open bin; -1 is the bin of values at or below the first edge or above the last."""
    out = F.when(column <= edges[0], -1)
    for i, edge in enumerate(edges[1:]):
        out = out.when(column <= edge, i)
    return out.when(column.isNotNull(), -1)


def response(grid: DataFrame, group: Column) -> DataFrame:
    """Label rate and count per group; rows without a value are the null group."""
    return grid.groupBy(group.alias("bin")).agg(F.avg("y").alias("rate"), F.count("*").alias("n"))
