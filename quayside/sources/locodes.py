"""Country codes and sea ports from the rows of stored code lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside import config
from quayside.functions.text import bare_code, is_country_code, locode, strip, unece_coord
from quayside.sources.html import html_rows, table_after

# Layout of the code-list pages.
HEADER_ROWS = 10
CELLS_PER_PORT = 10
CODE, NAME, FUNCTION, STATUS, COORDINATES = 1, 2, 5, 6, 9
COUNTRY_HEADING = "Current_codes"


def raw_locode(pages: DataFrame) -> DataFrame:
    """``(iso, cells)`` of the port rows of pages ``(iso, html)``, page header skipped."""
    return html_rows(pages, keep=("iso",)).where(F.col("row_no") >= HEADER_ROWS).select("iso", "cells")


def normalize_ports(raw: DataFrame) -> DataFrame:
    """Sea ports with a position from ``(iso, cells)``: known status, port function, readable place."""
    cell = [F.get("cells", F.lit(i)) for i in range(CELLS_PER_PORT)]
    rows = raw.where(F.size("cells") >= CELLS_PER_PORT).select(
        "iso",
        bare_code(cell[CODE]).alias("code"),
        cell[NAME].alias("name"),
        cell[FUNCTION].alias("function"),
        F.substring(strip(cell[STATUS]), 1, 2).alias("status"),
        F.split(strip(cell[COORDINATES]), " ").alias("place"),
    )
    place = F.struct(
        unece_coord(F.get("place", F.lit(0))).alias("lat"), unece_coord(F.get("place", F.lit(1))).alias("lon")
    )
    return (
        rows.where(
            (F.length("code") >= 3)
            & F.col("function").contains(config.SEAPORT_FUNCTION)
            & F.col("status").isin(config.PORT_STATUS_CODES)
        )
        # Through a generator, so that the filter below does not parse each place a second time.
        .select(locode(F.col("iso"), F.col("code")).alias("locode"), "name", F.inline(F.array(place)))
        .where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    )


def country_codes(rows: DataFrame) -> DataFrame:
    """Distinct valid codes, sorted, from table rows ``(row_no, cells)``; row 0 is the heading."""
    code = F.get("cells", F.lit(0))
    return (
        rows.where(F.col("row_no") >= 1)
        .select(code.alias("code"))
        .where(is_country_code(F.col("code")))
        .distinct()
        .orderBy("code")
    )


def country_codes_of_pages(pages: DataFrame) -> DataFrame:
    """Codes of the table under the heading on pages ``(html)``; none when it is not there."""
    return country_codes(html_rows(pages, keep=(), html=table_after(F.col("html"), COUNTRY_HEADING)))
