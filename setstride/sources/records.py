"""Landed JSON pages of raw records: explode, clean, quarantine, prize lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from setstride.config import DRAWS, Domain
from setstride.functions.casts import date_before_time, safe_float, safe_int

# Every leaf is read as text, so that one odd value spoils its own record and not the page.
BALL = "struct<Number:string,IsSpecial:string>"
PRIZE = (
    "struct<PrizeTypeDescription:string,PrizeDescription:string,Count:string,"
    "NumberOfWinners:string,Amount:string,PrizeAmount:string>"
)
RECORD = (
    "struct<DrawNumber:string,DrawDate:string,"
    f"WinningNumbers:map<string,{BALL}>,"
    "JackpotAmount:string,Jackpot:string,jackpot_amount:string,Prizes:string,PrizePayoutDetails:string>"
)
# A page keeps its records as text: a record of another shape is read, and judged, alone.
PAGE = "PreviousDraws array<string>, TotalPreviousDraws string, _corrupt_record string"


def read_pages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Landed pages with their file; a page that is not JSON keeps its text in `_corrupt_record`."""
    reader = spark.read.schema(PAGE).option("columnNameOfCorruptRecord", "_corrupt_record")
    return reader.option("multiLine", multi_line).json(path).withColumn("page", F.input_file_name())


def _unreadable() -> Column:
    return F.col("_corrupt_record").isNotNull() | F.col("PreviousDraws").isNull()


def raw_records(pages: DataFrame) -> DataFrame:
    """One row per record of the readable pages, with its text and its fields; fields of another shape are null."""
    texts = pages.where(~_unreadable()).select("page", F.explode("PreviousDraws").alias("text"))
    return texts.select("page", "text", F.from_json("text", RECORD).alias("raw"))


def unreadable_pages(pages: DataFrame) -> DataFrame:
    """Quarantine rows of pages that are not JSON or hold no list of records."""
    return pages.where(_unreadable()).select("page", F.lit(None).cast("long").alias("draw_number"), F.lit("page unreadable").alias("reason"), F.col("_corrupt_record").alias("raw"))


def parse_draws(records: DataFrame, domain: Domain = DRAWS) -> DataFrame:
    """All records with cleaned columns and `reason`, the first rule that fails (null when valid)."""
    balls = F.map_values("raw.WinningNumbers")
    parsed = F.transform(
        balls,
        lambda b: F.struct(
            safe_int(b["Number"]).cast("int").alias("n"), (F.lower(b["IsSpecial"]) == "true").alias("special")
        ),
    )
    plain = F.transform(F.filter("_b", lambda b: ~b["special"]), lambda b: b["n"])
    special = F.transform(F.filter("_b", lambda b: b["special"]), lambda b: b["n"])
    staged = records.select(
        *[c for c in records.columns],
        safe_int(F.col("raw.DrawNumber")).alias("draw_number"),
        date_before_time(F.col("raw.DrawDate")).alias("draw_date"),
        parsed.alias("_b"),
    ).select("*", F.array_sort(plain).alias("_white"), special.alias("_special"))

    def rule(bad: Column, name: str) -> Column:
        return F.when(F.coalesce(bad, F.lit(True)), F.lit(name))

    reason = F.coalesce(
        rule(F.col("draw_number").isNull(), "draw number"),
        rule(F.col("draw_date").isNull(), "draw date"),
        rule(F.col("raw.WinningNumbers").isNull(), "numbers missing"),
        rule(F.exists("_b", lambda b: b["n"].isNull() | b["special"].isNull()), "number unreadable"),
        rule(F.size("_special") > 1, "several specials"),
        rule(F.size("_white") != domain.pick, "count of numbers"),
        rule(F.size("_special") == 0, "special missing"),
        rule(~F.forall("_white", lambda n: n.between(1, domain.items)), "number out of range"),
        rule(~F.forall("_special", lambda n: n.between(1, domain.specials)), "special out of range"),
    )
    amount = F.coalesce("raw.JackpotAmount", "raw.Jackpot", "raw.jackpot_amount")
    return staged.select(
        *records.columns,
        "draw_number",
        "draw_date",
        *[F.get("_white", F.lit(j)).alias(f"n{j + 1}") for j in range(domain.pick)],
        F.get("_special", F.lit(0)).alias("mega_number"),
        safe_float(amount).alias("jackpot_amount"),
        reason.alias("reason"),
    )


def valid_draws(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNull()).drop("raw", "reason", "page", "text")


def quarantine(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNotNull()).select("page", "draw_number", "reason", F.col("text").alias("raw"))


def draw_prizes(parsed: DataFrame) -> DataFrame:
    """Prize lines of the valid records: a map or a list, two spellings per field, 0 falls through."""
    def entries(field: str) -> Column:
        text = F.col(f"raw.{field}")
        listed = F.from_json(text, f"array<{PRIZE}>")
        mapped = F.map_values(F.from_json(text, f"map<string,{PRIZE}>"))
        found = F.when(F.ltrim(text).startswith("["), listed).otherwise(mapped)
        return F.when(F.size(found) > 0, found)

    lines = parsed.where(F.col("reason").isNull()).select(
        "draw_number", F.explode(F.coalesce(entries("Prizes"), entries("PrizePayoutDetails"))).alias("p")
    )

    def either(first: str, second: str) -> Column:
        text = F.col(f"p.{first}")
        falsy = (F.trim(text) == "") | (F.trim(text).try_cast("double") == 0)
        return F.coalesce(F.when(~F.coalesce(falsy, F.lit(False)), text), F.col(f"p.{second}"))

    return lines.where(F.col("p").isNotNull()).select(
        "draw_number",
        F.coalesce(either("PrizeTypeDescription", "PrizeDescription"), F.lit("")).alias("prize_description"),
        safe_int(either("Count", "NumberOfWinners")).alias("winner_count"),
        safe_float(either("Amount", "PrizeAmount")).alias("prize_amount"),
    )


def page_report(pages: DataFrame) -> DataFrame:
    """Lineage of a full load: per file, whether it was readable and how many records it held."""
    return pages.groupBy("page").agg(
        F.count_if(F.col("_corrupt_record").isNotNull()).alias("broken"),
        F.sum(F.coalesce(F.size("PreviousDraws"), F.lit(0))).alias("records"),
    )
