"""Personal data by candidate gradient boosting, as row expressions.

1. Base patterns (email, ip, card, phone) with their checks give spans that always stay.
2. High-recall generators propose further, overlapping candidate spans of the same kinds (written-out and bracketed addresses, numbers
   without a plus, other separators, several numbers in a row).
3. Boosted trees, one model per kind, score candidates by format and context features. They are trained on all candidates of the corpus: features
   are small integers, so the candidates collapse into a bounded table of distinct feature rows with counts (`cells`), on which the
   boosting is exact. A candidate that overlaps a base span of its kind counts as a positive, and so do its hidden copies: the same value in its place,
   written in each way that only the generators know (`_hidden`). Other candidates are unlabelled. They count as negatives, except those that
   could not be added (they overlap a base span) and those whose own writing or context vouches for them (`_vouched`), which take no part in the training.
4. The threshold of a kind is calibrated: the lowest score from which on at least `PRECISION` of the candidates are positives and the model gives
   each at least that probability. Candidates from it on that overlap no base span and no better candidate are added. So a form that nothing
   vouches for is added where hidden copies outnumber the unlabelled candidates that look the same nine to one.

Positions are code points, ends exclusive. Null and empty texts have no spans. Patterns start at the beginning of a run and never give characters back,
so that very long texts take linear time. A kind without base spans in the corpus adds nothing. Repeated rows
give equal rows; an empty table gives an empty result; extra columns play no part.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setstride.functions.arrays import let

#: Kinds in order, and their patterns (possessive where giving back could not help; a run is entered at its start).
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GENERATORS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:@|\x20?[(\[]at[)\]]\x20?|\x20at\x20)[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[]dot[)\]]\x20?|\x20dot\x20)[A-Za-z0-9-]++){1,8}",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\x20?(?:\.|[(\[]\.[)\]])\x20?[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20./-]?[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9])\+?(?:\(?[0-9]{1,4}\)?[\x20./-]{1,2}){2,4}[0-9]{2,6}(?![0-9])",
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_CUES = {
    "email": r"mail|contact|write|address",
    "ip": r"\bip\b|host|server|address|login",
    "card": r"card|visa|credit|debit|account|pay",
    "phone": r"tel|phone|call|fax|mobile|dial|contact",
}
PRECISION = 0.9
ROUNDS = 24
DEPTH = 3
RATE = 0.3

_SPANS = "array<struct<start:int,end:int,value:string,before:string>>"


def _occurrences(text: Column, pattern: str, wanted) -> Column:
    """Spans of all matches that `wanted(value)` accepts: what stands between the matches gives their places."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.char_length(pair["gap"])
        end = start + F.char_length(pair["hit"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["hit"].alias("value"), F.lower(F.right(pair["gap"], F.lit(24))).alias("before"))
        held = F.when(wanted(pair["hit"]), F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.struct(end.alias("at"), held.alias("out"))

    pairs = F.arrays_zip(between.alias("gap"), found.alias("hit"))
    pairs = F.filter(pairs, lambda p: p["hit"].isNotNull())
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))
    return F.aggregate(pairs, start, step, lambda acc: acc["out"])


def _none() -> Column:
    return F.array().cast(_SPANS)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Luhn check of a string of digits: from the right, every second digit is doubled, nines cast out."""
    reversed_digits = F.filter(F.split(F.reverse(digits), ""), lambda d: d != "")
    values = F.transform(reversed_digits, lambda d, i: let(d.cast("int") * (1 + i % 2), lambda v: v - F.when(v > 9, 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0


def _octets(value: Column) -> Column:
    return F.rlike(value, F.lit(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$"))


def _accepted(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return _octets(value)
    size = F.char_length(_digits(value))
    if kind == "card":
        return F.when(size.between(16, 19), _luhn(_digits(value))).otherwise(F.lit(False))
    return size.between(8, 15)


def _guard(kind: str, text: Column, has_digit: Column) -> Column:
    """False only where the kind's base pattern cannot match."""
    return {"email": F.contains(text, F.lit("@")), "ip": has_digit, "card": has_digit, "phone": has_digit & F.contains(text, F.lit("+"))}[kind]


def base_spans(text: Column, has_digit: Column) -> dict[str, Column]:
    return {
        kind: F.when(_guard(kind, text, has_digit), _occurrences(text, PATTERNS[kind], lambda v, k=kind: _accepted(k, v))).otherwise(_none())
        for kind in KINDS
    }


FEATURES = ("kind", "digits", "length", "check", "form", "separator", "before", "after", "cue")


def _neighbour(c: Column) -> Column:
    """0 none or blank, 1 a letter or digit, 2 another character."""
    return F.when((c == "") | F.rlike(c, F.lit(r"\s")), 0).when(F.rlike(c, F.lit(r"[\p{L}\p{N}_]")), 1).otherwise(2)


def _address(value: Column) -> Column:
    """An address with its written-out signs put back."""
    at = F.regexp_replace(value, r"\x20?[(\[]at[)\]]\x20?|\x20at\x20", "@")
    return F.regexp_replace(at, r"\x20?[(\[]dot[)\]]\x20?|\x20dot\x20", ".")


def _form(kind: str, value: Column) -> Column:
    """How the value is written: 0 as base patterns read it, else as only the generators do."""
    if kind == "email":
        return F.when(F.rlike(value, F.lit(r"[(\[]")), 1).when(F.contains(value, F.lit(" dot ")), 2).when(F.contains(value, F.lit(" at ")), 3).otherwise(0)
    if kind == "ip":
        return F.when(F.rlike(value, F.lit(r"[(\[]")), 1).when(F.contains(value, F.lit(" ")), 2).otherwise(0)
    if kind == "card":
        return F.when(F.rlike(value, F.lit("[./]")), 1).otherwise(0)
    return F.when(F.startswith(value, F.lit("+")), 0).otherwise(1)


def _hidden(kind: str, value: Column) -> list[Column]:
    """A base value in the ways of writing that its base pattern does not read."""
    if kind == "email":
        name, host = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
        ways = ((" [at] ", " [dot] "), (" at ", " dot "), (" at ", "."))
        return [F.concat(name, F.lit(at), F.replace(host, F.lit("."), F.lit(dot))) for at, dot in ways]
    if kind == "ip":
        return [F.replace(value, F.lit("."), F.lit(dot)) for dot in ("[.]", " . ")]
    if kind == "card":
        return [F.regexp_replace(_digits(value), "([0-9]{4})(?=[0-9])", f"$1{dot}") for dot in "./"]
    whole, home = F.substring(value, 2, 1 << 20), F.regexp_replace(value, r"^\+[0-9]{1,4}[\x20.-]+", "")
    spaced = [F.trim(F.regexp_replace(v, r"[\x20().-]+", " ")) for v in (whole, home)]
    return [whole, home, *[F.replace(v, F.lit(" "), F.lit(sep)) for v in spaced for sep in (" ", "-", ".")]]


def _vouched(kind: str, f: Column) -> Column:
    """The writing itself (brackets, both words, a valid card number) or a contact word says what an unlabelled candidate is."""
    cue, check = f["cue"] == 1, f["check"] == 1
    return {"email": check & (f["form"].isin(1, 2) | cue), "ip": check & ((f["form"] == 1) | cue), "card": check & (f["digits"].between(16, 19) | cue), "phone": cue & f["digits"].between(8, 15)}[kind]


def _features(kind: str, span: Column, text: Column) -> Column:
    value = span["value"]
    digits = _digits(value)
    plain = {"email": _address, "ip": lambda v: F.regexp_replace(v, "[^0-9.]", ""), "card": _digits, "phone": lambda v: v}[kind](value)
    check = {"email": lambda: F.rlike(plain, F.lit(r"\.[A-Za-z]{2,}$")), "ip": lambda: _octets(plain), "card": lambda: _luhn(digits), "phone": lambda: F.lit(True)}[kind]()
    others = F.regexp_replace(value, "[0-9+]", "")
    separator = F.when(others == "", 0).when(F.rlike(others, F.lit(r"^\.+$")), 1).when(F.rlike(others, F.lit(r"^\x20+$")), 2).when(F.rlike(others, F.lit("^-+$")), 3).otherwise(4)
    return F.struct(
        F.lit(KINDS.index(kind)).alias("kind"),
        F.least(F.char_length(digits), F.lit(20)).alias("digits"),
        F.least(F.floor(F.char_length(plain) / 4).cast("int"), F.lit(10)).alias("length"),
        check.cast("int").alias("check"),
        _form(kind, value).alias("form"),
        (separator if kind == "phone" else F.lit(0)).alias("separator"),
        _neighbour(F.right(span["before"], F.lit(1))).alias("before"),
        _neighbour(F.substring(text, span["end"] + 1, F.lit(1))).alias("after"),
        F.rlike(span["before"], F.lit(_CUES[kind])).cast("int").alias("cue"),
        span["start"].alias("start"),
        span["end"].alias("end"),
    )


def _overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _proposed(text: Column, has_digit: Column) -> dict[str, Column]:
    """Spans of the generators by kind."""
    at = F.rlike(text, F.lit(r"@|[(\[]at[)\]]|\x20at\x20"))
    return {
        kind: F.when(at if kind == "email" else has_digit, _occurrences(text, GENERATORS[kind], lambda v: F.lit(True))).otherwise(_none())
        for kind in KINDS
    }


def candidates(text: Column, has_digit: Column, base: dict[str, Column]) -> Column:
    """Candidates of all kinds with features and `taken` (overlaps any base span)."""
    every = F.concat(*base.values())

    def described(kind: str):
        return lambda span: let(_features(kind, span, text), lambda f: F.struct(
            *[f[n].alias(n) for n in (*FEATURES, "start", "end")], F.exists(every, lambda x: _overlaps(f, x)).alias("taken"),
        ))

    return F.concat(*[F.transform(spans, described(kind)) for kind, spans in _proposed(text, has_digit).items()])


def examples(text: Column, has_digit: Column, base: dict[str, Column]) -> Column:
    """What the models are trained on: features and `positive` of candidates and of the hidden copies of base values."""
    every = F.concat(*base.values())

    def row(f: Column, positive: int) -> Column:
        return F.struct(*[f[n].alias(n) for n in FEATURES], F.lit(positive).alias("positive"))

    def told(kind: str):
        def of(span: Column) -> Column:
            copies = F.filter(F.array(*_hidden(kind, span["value"])), lambda v: F.rlike(v, F.lit(f"^(?:{GENERATORS[kind]})$")))
            known = F.concat(
                F.array(row(_features(kind, span, text), 1)),
                F.transform(copies, lambda v: row(_features(kind, span.withField("value", v), text), 1)),
            )
            unknown = let(_features(kind, span, text), lambda f: F.when(~_vouched(kind, f), F.array(row(f, 0))))
            own = F.exists(base[kind], lambda x: _overlaps(span, x))
            return F.when(own, known).when(~F.exists(every, lambda x: _overlaps(span, x)), unknown)

        return of

    made = [F.transform(spans, told(kind)) for kind, spans in _proposed(text, has_digit).items()]
    return F.flatten(F.filter(F.concat(*made), lambda x: x.isNotNull()))


@dataclass(frozen=True)
class Tree:
    """A node: rows with `feature` <= `at` go left; a leaf has a value only."""

    value: float = 0.0
    feature: str | None = None
    at: int = 0
    left: "Tree | None" = None
    right: "Tree | None" = None

    def score(self, row: dict) -> float:
        return self.value if self.feature is None else (self.left if row[self.feature] <= self.at else self.right).score(row)

    def column(self, s: Column) -> Column:
        if self.feature is None:
            return F.lit(self.value)
        return F.when(s[self.feature] <= self.at, self.left.column(s)).otherwise(self.right.column(s))


@dataclass(frozen=True)
class Model:
    trees: list[Tree] = field(default_factory=list)
    threshold: float = math.inf

    def column(self, s: Column) -> Column:
        return sum((t.column(s) for t in self.trees), F.lit(0.0))


def _grow(rows: list[dict], depth: int) -> Tree:
    """Least squares on the second-order expansion of the logistic loss; ties go to the first feature and least cut."""
    g, h = sum(r["g"] for r in rows), sum(r["h"] for r in rows)
    leaf = Tree(value=RATE * g / (h + 1.0))
    if not depth:
        return leaf
    best, cut = 1e-6, None
    for name in FEATURES:
        left_g = left_h = 0.0
        by: dict[int, list[float]] = {}
        for r in rows:
            held = by.setdefault(r[name], [0.0, 0.0])
            held[0] += r["g"]
            held[1] += r["h"]
        for value in sorted(by)[:-1]:
            left_g += by[value][0]
            left_h += by[value][1]
            gain = left_g**2 / (left_h + 1) + (g - left_g) ** 2 / (h - left_h + 1) - g**2 / (h + 1)
            if gain > best:
                best, cut = gain, (name, value)
    if cut is None:
        return leaf
    name, at = cut
    return Tree(0.0, name, at, _grow([r for r in rows if r[name] <= at], depth - 1), _grow([r for r in rows if r[name] > at], depth - 1))


def boost(cells: list[dict]) -> Model:
    """Boosted trees on feature cells with `n` candidates, `positive` of them; the threshold keeps the wanted precision."""
    good, total = sum(c["positive"] for c in cells), sum(c["n"] for c in cells)
    if not good:
        return Model()
    if good == total:  # nothing speaks against any candidate
        return Model([Tree(value=math.log(PRECISION / (1 - PRECISION)))], 0.0)
    score, trees = [0.0] * len(cells), []
    for _ in range(ROUNDS):
        rows = []
        for c, s in zip(cells, score):
            p = 1 / (1 + math.exp(-s))
            rows.append(c | {"g": c["positive"] - c["n"] * p, "h": c["n"] * p * (1 - p)})
        trees.append(_grow(rows, DEPTH))
        score = [s + trees[-1].score(c) for c, s in zip(cells, score)]
    hits = seen = 0
    threshold = math.inf
    ordered = sorted(zip(score, cells), key=lambda x: -x[0])
    for k, (s, c) in enumerate(ordered):
        hits, seen = hits + c["positive"], seen + c["n"]
        last_of_score = k + 1 == len(ordered) or ordered[k + 1][0] < s
        if last_of_score and hits >= PRECISION * seen and s >= math.log(PRECISION / (1 - PRECISION)):
            threshold = s - 1e-9
    return Model(trees, threshold)


def _read(documents: DataFrame) -> DataFrame:
    """doc_id, text, digit, arrays of base spans by kind; every step is a projection of the row."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("digit", F.rlike("text", F.lit("[0-9]")))
    return rows.select("*", *[c.alias(k) for k, c in base_spans(F.col("text"), F.col("digit")).items()])


def cells(documents: DataFrame) -> list[dict]:
    """Distinct feature rows of the examples with their numbers: at most one collected row each."""
    found = examples(F.col("text"), F.col("digit"), {k: F.col(k) for k in KINDS})
    each = _read(documents).select(F.explode(found).alias("c"))
    names = [F.col(f"c.{n}").alias(n) for n in FEATURES]
    counted = each.groupBy(*names).agg(F.count("*").alias("n"), F.sum("c.positive").alias("positive")).collect()
    return sorted((r.asDict() for r in counted), key=lambda r: tuple(r[n] for n in FEATURES))


def fit(documents: DataFrame) -> list[Model]:
    """A model for each kind, trained on all examples of the corpus."""
    every = cells(documents)
    return [boost([c for c in every if c["kind"] == k]) for k in range(len(KINDS))]


def report(documents: DataFrame, models: list[Model] | None = None) -> DataFrame:
    """doc_id, base counts and digest, all spans, and how many of them the models added."""
    models = models or fit(documents)
    rows = _read(documents)
    able = [(k, m) for k, m in enumerate(models) if m.trees and m.threshold < math.inf]
    if able:
        rows = rows.withColumn("found", candidates(F.col("text"), F.col("digit"), {k: F.col(k) for k in KINDS}))

        def reaching(least: float):
            return lambda s: F.when(s >= F.lit(least), s)

        def score(c: Column) -> Column:
            """Null where the candidate is below the threshold of its kind."""
            return F.coalesce(*[F.when(c["kind"] == k, let(m.column(c), reaching(m.threshold))) for k, m in able])

        scored = F.transform(F.filter("found", lambda c: ~c["taken"]), lambda c: c.withField("score", score(c)))
        passing = F.filter(scored, lambda c: c["score"].isNotNull())

        def better(a: Column, b: Column) -> Column:
            """`a` goes before `b`: higher score, then kind, then place."""
            return F.struct(-a["score"], a["kind"], a["start"]) < F.struct(-b["score"], b["kind"], b["start"])

        chosen = let(passing, lambda v: F.filter(v, lambda c: ~F.exists(v, lambda o: _overlaps(o, c) & better(o, c))))
        added = F.transform(chosen, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    else:
        added = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    rows = rows.withColumn("added", added)

    def of_kind(n: int):
        return lambda s: F.struct(F.lit(n).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))

    rows = rows.withColumn("base", F.concat(*[F.transform(k, of_kind(n)) for n, k in enumerate(KINDS)]))
    names = F.array(*[F.lit(k) for k in KINDS])

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")

    return rows.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.array_sort(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_added"),
    )
