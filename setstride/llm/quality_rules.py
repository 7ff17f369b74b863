"""Quality rules: counted text features and a hashed n-gram log-likelihood ratio, all as row expressions.

The ratio compares two multinomials over 2^18 cells of hashed n-grams for each n of `orders` (single words and pairs): the trusted target (documents labelled
good and not toxic) and the raw corpus (all documents), both smoothed with `PRIORS` counts laid out as the raw corpus is. Longer n-grams have cells
of their own and are smoothed more, so that rare ones, of which there are very many, stay near 0 and only well-attested ones count. A document's score
is the mean log ratio of its n-grams, so long and short texts compare alike, and one threshold decides every document.
Raw cells are counted over all rows. The target is half of all good documents (by a hash of the id); the other half and all other
labelled documents set the threshold, where the rate of kept good documents, counted `GOOD_WEIGHT` times, and the
rate of dropped others add up to the most. The weights are written as one row of a fixed size and reach the row expressions as a scalar subquery.

Null and blank texts have no words and fail the base rules. Without labels of either kind the ratio or the
threshold takes no part and the base rules decide. Repeated rows count as often as they stand there. Extra columns pass through.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setstride.functions.arrays import let
from setstride.llm.tables import BLANKS, discard, stored

CELLS = 1 << 18
ORDERS = (1, 2)
PRIORS = (8.0, 64.0, 64.0)
GOOD_WEIGHT = 3.0
#: Fixed value: the characters that count as symbols.
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Ratio:
    """Log ratio of every cell (a written table of one row, `w`) and the least mean score of a kept document."""

    table: DataFrame
    threshold: float
    orders: tuple[int, ...] = ORDERS

    @property
    def weights(self) -> list[float]:
        return self.table.first()["w"]


def _words(text: Column) -> Column:
    """Words between blanks; blanks at both ends go first, so that no empty word has to be filtered out."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def _hashes(text: Column) -> Column:
    return F.transform(_words(text), lambda w: F.xxhash64(w))


def _gram(h: Column, w: Column, i: Column, n: int) -> Column:
    """Hash of the n words from place i on, w the first; null where the text ends before."""
    for j in range(1, n):
        w = w.bitwiseXOR(F.shiftleft(F.get(h, i + j), j))
    return w


def _cell(gram: Column, at: int = 0) -> Column:
    """Every n of `orders` has `CELLS` of its own."""
    cell = gram.bitwiseAND(F.lit(CELLS - 1)).cast("int")
    return cell + at * CELLS if at else cell


def _grams(h: Column, n: int) -> Column:
    """Hashes of the n-grams from every place on, with a null where the text is too short."""
    return h if n == 1 else F.transform(h, lambda w, i: _gram(h, w, i, n))


def _repeat_words(h: Column, pairs: Column, window: int = 5) -> Column:
    """Words in windows of five that stand at two places or more; `pairs` holds the hashes of neighbouring words."""
    n = F.size(h)
    seen = F.transform(F.slice(pairs, 1, n - window + 1), lambda p, i: F.xxhash64(p, F.get(pairs, i + 2), F.get(h, i + 4)))

    def covered(v: Column) -> Column:
        placed = F.sort_array(F.transform(v, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        twice = let(placed, lambda s: F.filter(s, lambda e, k: (F.get(s, k - 1)["x"] == e["x"]) | (F.get(s, k + 1)["x"] == e["x"])))
        starts = F.sort_array(F.transform(twice, lambda e: e["i"]))
        return let(starts, lambda s: F.aggregate(
            F.transform(s, lambda e, k: F.least(F.lit(window), F.coalesce(F.get(s, k + 1) - e, F.lit(window)))), F.lit(0), lambda a, b: a + b
        ))

    counted = let(seen, lambda v: F.when(F.size(F.array_distinct(v)) < F.size(v), covered(v)).otherwise(F.lit(0)))
    return F.when(n >= window, counted).otherwise(F.lit(0))


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))
    return let(lines, lambda v: F.size(v) - F.size(F.array_distinct(v)))


def base_features(text: Column, h: Column, pairs: Column) -> dict[str, Column]:
    """The counted features; `h` holds the hashes of the words of `text`, `pairs` those of neighbouring words."""
    return {
        "n_words": F.size(h).cast("long"),
        "word_chars": F.char_length(F.translate(text, BLANKS, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long"),
        "n_dup_lines": _dup_lines(text).cast("long"),
        "n_repeat_words": _repeat_words(h, pairs).cast("long"),
    }


def _score(h: Column, weights: Column, orders: tuple[int, ...], pairs: Column | None = None) -> Column:
    """Mean weight of the n-grams; `pairs` are the hashes of neighbouring words where they are known already."""

    def total(table: Column) -> Column:
        def of(at: int, n: int) -> Column:
            grams = pairs if n == 2 and pairs is not None else _grams(h, n)
            whole = grams if n == 1 else F.slice(grams, 1, F.greatest(F.size(h) - (n - 1), F.lit(0)))
            return F.aggregate(whole, F.lit(0.0), lambda a, g: a + F.get(table, _cell(g, at)))

        return reduce(lambda a, b: a + b, [of(at, n) for at, n in enumerate(orders)])

    count = reduce(lambda a, b: a + b, [F.greatest(F.size(h) - (n - 1), F.lit(0)) for n in orders])
    return let(weights, total) / count


def _sampled(labels: DataFrame, sample: int | None = None) -> DataFrame:
    """The labelled ids of both kinds: doc_id, good; all of them, or at most `sample` of each kind where a caller asks for so many."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"))
    known = known.where("doc_id is not null and good is not null").groupBy("doc_id").agg(F.min("good").alias("good"))
    if sample is None:
        return known
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    return known.where("good").orderBy(*order).limit(sample).unionByName(known.where("not good").orderBy(*order).limit(sample))


def _cells_of(text: Column, rows: DataFrame, orders: tuple[int, ...], target: int) -> DataFrame:
    """(raw, target, cell): one row per n-gram of the texts, counted as raw or as target."""
    hashed = rows.select(_hashes(text).alias("h")).select("h", F.size("h").alias("n"))
    grams = hashed.select("n", F.posexplode(F.concat(*[_grams(F.col("h"), n) for n in orders])).alias("at", "gram")).where("gram is not null")
    cell = _cell(F.col("gram")) + F.call_function("div", F.col("at"), F.col("n")).cast("int") * CELLS
    return grams.select(F.lit(1 - target).alias("raw"), F.lit(target).alias("target"), cell.alias("cell"))


def fit(documents: DataFrame, labels: DataFrame, sample: int | None = None, orders: tuple[int, ...] = ORDERS) -> Ratio:
    """Count the cells of all documents and of the target, then set the threshold on the labelled documents held back.

    Labels may be as many as the documents, so the two meet once by id and only the labelled texts are written.
    """
    chosen = _sampled(labels, sample).withColumn("held", F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(2)) == 1)
    text = F.col("text").cast("string")
    met = stored(documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).join(chosen, "doc_id").select("text", "good", "held"), "quality-labelled")
    cells = _cells_of(text, documents, orders, 0).unionAll(_cells_of(text, met.where("good and not held"), orders, 1))
    counted = cells.groupBy("cell").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    table, known = _weights(counted, orders)
    if not known:
        discard(met)
        return Ratio(table, -math.inf, orders)
    # the weights stay out of the rows (4 MB a row otherwise)
    held = met.where("held or not good").where(F.trim("text", F.lit(BLANKS)) != "").select("good", "text", table.scalar().alias("w"))
    scored = held.select("good", F.round(let(_hashes(F.col("text")), lambda h: _score(h, F.col("w"), orders)), 4).alias("score"))
    bins = scored.groupBy("score").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("other"))
    found = [tuple(r) for r in bins.collect()]
    discard(met)
    return Ratio(table, _best_threshold(found), orders)


def _weights(counted: DataFrame, orders: tuple[int, ...]) -> tuple[DataFrame, bool]:
    """The written row of log ratios, and whether there is a target at all."""
    spark = counted.sparkSession
    cells = spark.range(CELLS * len(orders)).select(F.col("id").cast("int").alias("cell"), F.floor(F.col("id") / CELLS).cast("int").alias("at"))
    every = stored(cells.join(counted, "cell", "left").select("cell", "at", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("target", F.lit(0)).alias("target")), "quality-cells")
    totals = every.groupBy("at").agg(F.sum("raw").alias("all_raw"), F.sum("target").alias("all_target"))  # a row per order
    known = bool(totals.agg(F.sum("all_target")).first()[0])
    prior = F.element_at(F.array(*[F.lit(p) for p in PRIORS[: len(orders)]]), F.col("at") + 1)
    share = F.coalesce(F.try_divide("all_target", "all_raw"), F.lit(0.0))
    weight = F.round(F.log((F.col("target") + prior) / (share * F.col("raw") + prior)), 3) if known else F.lit(0.0)
    weighed = every.join(F.broadcast(totals), "at").select("cell", weight.alias("w"))
    row = weighed.agg(F.sort_array(F.collect_list(F.struct("cell", "w"))).alias("s")).select(F.transform("s", lambda e: e["w"]).alias("w"))
    return stored(row, "quality-weights"), known


def _best_threshold(bins: list[tuple[float, int, int]]) -> float:
    """The score from which on documents are kept: midway between the two bins that part the kinds best."""
    good, other = sum(b[1] for b in bins), sum(b[2] for b in bins)
    if not good or not other:
        return -math.inf
    best, at, lost, dropped, before = GOOD_WEIGHT, -math.inf, 0, 0, None
    for score, g, o in sorted(bins):
        gain = GOOD_WEIGHT * (good - lost) / good + dropped / other
        if before is not None and gain > best:
            best, at = gain, (before + score) / 2
        lost, dropped, before = lost + g, dropped + o, score
    return at


def _rules(text: Column, h: Column, weights: Column, ratio: Ratio) -> Column:
    """Struct of counts, score, base_failed and kept; `h` is a bound variable, so that it is computed once.

    `weights` is a column of the scalar subquery, which the optimiser folds into the one place that reads it if every other column beside it
    is a plain one; `h` has to be a bound variable then, for a column of hashes keeps the projections apart and every row gets a copy (4 MB).
    """
    counts = let(_grams(h, 2), lambda pairs: F.struct(
        *[c.alias(n) for n, c in base_features(text, h, pairs).items()], F.when(F.size(h) > 0, _score(h, weights, ratio.orders, pairs)).alias("score")
    ))

    def decided(c: Column) -> Column:
        failed = (c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"])
        kept = ~failed & (c["score"] >= F.lit(ratio.threshold))
        return c.withField("base_failed", failed).withField("kept", F.coalesce(kept, F.lit(False)))

    return let(counts, decided)


def judged(documents: DataFrame, ratio: Ratio) -> DataFrame:
    """All columns of `documents` and a last struct column: counts, score, base_failed and kept."""
    name = _free(documents.columns, "rules")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    held = _free([*documents.columns, name], "weights")
    rows = documents.withColumn(held, ratio.table.scalar())
    return rows.withColumn(name, let(_hashes(text), lambda h: _rules(text, h, F.col(held), ratio))).drop(held)


def _free(taken: list[str], name: str) -> str:
    """`name`, lengthened until no column has it."""
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def verdicts(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document with its counts, score and verdict."""
    return judged(documents.select("doc_id", "text"), fit(documents, labels)).select("doc_id", "rules.*")


def keep(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with their columns."""
    rows = judged(documents, fit(documents, labels))
    return rows.where(F.col(f"`{rows.columns[-1]}`")["kept"]).select(*[F.col(f"`{n}`") for n in documents.columns])
