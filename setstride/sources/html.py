"""Rows out of HTML pages with built-in regular expressions: tables, links, paragraphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from setstride.config import DRAWS, Domain
from setstride.functions.casts import money, page_date


def elements(html: Column, tag: str) -> Column:
    """Inner HTML of every <tag> element, in document order (the tag must not nest in itself)."""
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>"), F.lit(1))


def inner_text(html: Column, gap: str = "") -> Column:
    return F.trim(F.regexp_replace(html, r"(?s)<[^>]+>", gap))


def table_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """Cells of every row but the first of the first table of each page."""
    table = F.get(elements(F.col(html), "table"), F.lit(0))
    rows = F.slice(elements(table, "tr"), 2, 1 << 30)
    return pages.select("*", F.explode(rows).alias("_row")).select(
        *[c for c in pages.columns if c != html], elements(F.col("_row"), "td").alias("cells")
    )


def parse_table_draws(pages: DataFrame, year: str = "year", domain: Domain = DRAWS) -> DataFrame:
    """Draws from pages (year, html): rows without a date, six numbers or the right ranges fall away."""
    cells = table_rows(pages).where(F.size("cells") >= 2)
    result = F.regexp_replace(inner_text(F.get("cells", F.lit(1)), " "), "Mega Ball", "")
    numbers = F.transform(F.regexp_extract_all(result, F.lit(r"(\d+)"), F.lit(1)), lambda n: n.try_cast("int"))
    staged = cells.select(
        page_date(inner_text(F.get("cells", F.lit(0))), F.col(year)).alias("draw_date"),
        numbers.alias("_n"),
        money(inner_text(F.get("cells", F.lit(2)))).alias("jackpot_amount"),
    )
    white = F.array_sort(F.slice("_n", 1, domain.pick))
    good = (
        F.col("draw_date").isNotNull()
        & (F.size("_n") == domain.pick + 1)
        & F.forall(F.slice("_n", 1, domain.pick), lambda n: F.coalesce(n.between(1, domain.items), F.lit(False)))
        & F.coalesce(F.get("_n", F.lit(domain.pick)).between(1, domain.specials), F.lit(False))
    )
    return staged.where(good).select(
        F.lit(None).cast("long").alias("draw_number"),
        "draw_date",
        *[F.get(white, F.lit(j)).alias(f"n{j + 1}") for j in range(domain.pick)],
        F.get("_n", F.lit(domain.pick)).alias("mega_number"),
        "jackpot_amount",
    )
