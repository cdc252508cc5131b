"""Environmental filings: search windows, result pages, titles, page text and power figures in it."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.functions.ratings import power_mentions
from siteweave.storage import ship

# Development types that are searched, and what a title must contain.
DEVELOPMENT_TYPES = ("Industrial", "Commercial", "Office", "Power")
TITLE = r"(?i)data\s?cent(er|re)|colocation|hyperscale"
CELLS = ("sch_number", "document_type", "lead_agency", "received", "title")


class _Tables(HTMLParser):
    """Rows of the first table, and all visible text."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[list[str]] = []
        self.text: list[str] = []
        self.tables = self.open = self.hidden = 0
        self.cell: list[str] | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("script", "style"):
            self.hidden += 1
        if tag == "table":
            self.tables += 1
            self.open += 1
        if self.tables == 1 and self.open:
            if tag == "tr":
                self.rows.append([])
            elif tag in ("td", "th"):
                self.cell = []

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style") and self.hidden:
            self.hidden -= 1
        if tag in ("td", "th") and self.cell is not None:
            if self.rows and tag == "td":
                self.rows[-1].append(" ".join("".join(self.cell).split()))
            self.cell = None
        if tag == "table" and self.open:
            self.open -= 1

    def handle_data(self, data: str) -> None:
        if self.hidden:
            return
        self.text.append(data)
        if self.cell is not None:
            self.cell.append(data)


def result_rows(page: str | None) -> list[tuple[str, ...]]:
    """Rows of the first table after its header, with at least five cells; the first five of each."""
    parser = _Tables()
    parser.feed(page or "")
    return [tuple(r[:5]) for r in parser.rows[1:] if len(r) >= 5]


def page_text(page: str | None) -> str:
    parser = _Tables()
    parser.feed(page or "")
    return "\n".join(" ".join(line.split()) for line in "".join(parser.text).splitlines() if line.strip())


def month_windows(spark: SparkSession, start: str, end: str) -> DataFrame:
    """(window_start, window_end): calendar months from the start's month, the last one clipped to the end."""
    months = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("INTERVAL 1 MONTH"))).alias("d"))
    return months.select(F.col("d").alias("window_start"), F.least(F.last_day("d"), F.lit(end).cast("date")).alias("window_end"))


def parse_results(pages: DataFrame, page: str = "html") -> DataFrame:
    """Result rows of pages; other columns of a page are kept. Pages are parsed in Arrow batches."""
    ship(pages.sparkSession)
    kept = [f for f in pages.schema.fields if f.name != page]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), *(f"{c} string" for c in CELLS)])

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch.assign(_r=[result_rows(h) for h in batch[page]]).explode("_r").dropna(subset=["_r"])
            cells = pd.DataFrame(out["_r"].tolist(), columns=list(CELLS), index=out.index)
            yield pd.concat([out[[f.name for f in kept]], cells], axis=1)

    return pages.mapInPandas(parse, schema)


def discover(pages: DataFrame) -> DataFrame:
    """Filings whose title fits, one per number: that of the last page in (development type, window)."""
    rows = parse_results(pages).where(F.col("title").rlike(TITLE))
    rest = [c for c in rows.columns if c != "sch_number"]
    place = F.array_position(F.array(*[F.lit(t) for t in DEVELOPMENT_TYPES]), F.col("development_type"))
    return rows.groupBy("sch_number").agg(F.max_by(F.struct(*rest), F.struct(place, "window_start")).alias("r")).select("sch_number", "r.*").orderBy("sch_number")


def harvest(pages: DataFrame) -> DataFrame:
    """Power figures in the text of detail pages (sch_number, title, source_url, html), numbered by their place in it; the day of retrieval is kept where pages have it."""
    ship(pages.sparkSession)

    @F.pandas_udf("string")
    def visible(page: pd.Series) -> pd.Series:
        return page.map(page_text)

    found = pages.select("*", F.posexplode(power_mentions(visible("html"))).alias("place", "m"))
    return found.select("sch_number", "title", "source_url", "m.value_mw", "m.basis", "m.quote", "place", *[c for c in ("retrieved_at",) if c in pages.columns])
