"""Rows and cells of stored web pages: with built-in text functions, but for pages of several tables, where nesting counts."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.text import html_text


def _elements(html: Column, tags: Sequence[str]) -> Column:
    """Inner HTML of every element with one of the tags. Closing tags may be missing."""
    names = "|".join(tags)
    pattern = rf"(?is)<(?:{names})(?:\s[^>]*)?>(.*?)(?=</(?:{names})\s*>|<(?:{names})[\s>]|$)"
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(1))


def table_after(html: Column, heading_id: str) -> Column:
    """The first table after the ``h2`` with an id, tables nested in it included; null when there is no such heading or table."""
    pattern = rf"""(?is)<h2[^>]*\sid=["']?{heading_id}["']?[\s>].*?(<table[\s>].*)"""
    rest = F.nullif(F.regexp_extract(html, pattern, 1), F.lit(""))
    pieces = F.split(rest, r"(?i)(?=<table[\s>]|</table\s*>)")

    def add(seen: Column, piece: Column) -> Column:
        opens, closes = piece.rlike(r"(?i)^<table[\s>]"), piece.rlike(r"(?i)^</table\s*>")
        depth = seen["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        # Behind the end tag that closes the first table nothing is taken.
        text = F.concat(seen["text"], F.when(depth > 0, piece).otherwise("</table>"))
        more = F.struct(depth.alias("depth"), text.alias("text"), (depth <= 0).alias("done"))
        return F.when(seen["done"], seen).otherwise(more)

    nothing = F.struct(F.lit(0).alias("depth"), F.lit("").alias("text"), F.lit(False).alias("done"))
    return F.aggregate(pieces, nothing, add, lambda seen: seen["text"])


def nested_cells(html: str | None, cell_tags: Sequence[str]) -> list[list[str]] | None:
    """Inner HTML of the cells of each ``tr``, rows and cells in the order of their start tags; null without a text.

    A row has the cells of all tables inside it, too. A row or cell without an end tag ends at the next one of its own table, or with the table.
    """
    if html is None:
        return None
    tags = re.compile(rf"<!--.*?-->|<(/?)(table|tr|{'|'.join(map(re.escape, cell_tags))})(?:\s[^>]*)?>", re.I | re.S)
    rows: list[list[int]] = []
    cells: list[list[int]] = []
    # For each open table its open row and cell, -1 if there is none; the first is for what is in no table.
    tables = [[-1, -1]]

    def end_cell(at: int) -> None:
        if tables[-1][1] >= 0:
            cells[tables[-1][1]][1] = at
            tables[-1][1] = -1

    for found in tags.finditer(html):
        if found[2] is None:
            continue
        tag, opens = found[2].lower(), not found[1]
        if tag == "table" and opens:
            tables.append([-1, -1])
            continue
        end_cell(found.start())
        if tag == "table" and len(tables) > 1:
            tables.pop()
        elif tag == "tr":
            tables[-1][0] = len(rows) if opens else -1
            if opens:
                rows.append([])
        elif tag != "table" and opens:
            tables[-1][1] = len(cells)
            for row, _ in tables:
                if row >= 0:
                    rows[row].append(len(cells))
            cells.append([found.end(), len(html)])
    return [[html[slice(*cells[cell])] for cell in row] for row in rows]


def html_rows(
    pages: DataFrame,
    row_tag: str = "tr",
    cell_tags: Sequence[str] = ("td", "th"),
    keep: Sequence[str] = ("page_id",),
    html: Column | None = None,
) -> DataFrame:
    """One line per row element: ``keep`` columns, ``row_no`` from 0, ``cells`` as stripped text.

    A ``tr`` inside a cell is a row of its own, and its cells and their text belong to the outer row as well.
    """
    source = F.col("html") if html is None else html
    if row_tag != "tr":
        rows = pages.select(*keep, F.posexplode(_elements(source, [row_tag])).alias("row_no", "row_html"))
        return rows.select(*keep, "row_no", F.transform(_elements(F.col("row_html"), cell_tags), html_text).alias("cells"))
    tags = list(cell_tags)

    @F.pandas_udf("array<array<string>>")
    def nested(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: nested_cells(text, tags))

    # Only pages with several tables can have one inside another; the others never leave the JVM as text.
    several = F.regexp_count(source, F.lit(r"(?i)<table[\s>]")) > 1
    flat = F.transform(_elements(source, [row_tag]), lambda row: _elements(row, cell_tags))
    rows = pages.select(*keep, F.posexplode(F.coalesce(nested(F.when(several, source)), F.when(~several, flat))).alias("row_no", "cells"))
    return rows.withColumn("cells", F.transform("cells", html_text))
