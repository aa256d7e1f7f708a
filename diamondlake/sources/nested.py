"""Nested JSON and HTML text sources.

Everything is parsed with built-in expressions (``from_json``,
``regexp_extract_all``, ``explode``) inside the scan's tasks, so a landed
file of any size is parsed in parallel; nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from diamondlake.functions.scalars import anchor_text


def json_rows(df: DataFrame, json_col: str, item_schema: StructType, fields: dict, keep: list[str] = (),
              array_field: str = "data") -> DataFrame:
    """Parse ``{"data": [{...}, ...]}`` and emit one row per element with
    the named fields (``fields``: output -> element field).  A payload without
    ``data`` yields no rows instead of failing."""
    schema = StructType().add(array_field, ArrayType(item_schema))
    parsed = df.select(*keep, F.from_json(F.col(json_col), schema).alias("__j"))
    rows = parsed.select(*keep, F.explode(F.col(f"__j.{array_field}")).alias("__e"))
    return rows.select(*keep, *[F.col(f"__e.{src}").alias(out) for out, src in fields.items()])


def boxscore_lineups(df: DataFrame, json_col: str, schema: StructType, keep: list[str] = (),
                     starters_suffix: str = "0") -> DataFrame:
    """Box score JSON -> one row per starting batter of either side with
    side, team abbreviation and lineup slot (hundreds of the order)."""
    j = df.select(*keep, F.from_json(F.col(json_col), schema).alias("__b"))
    sides = F.array(
        F.struct(F.lit("home").alias("side"), F.col("__b.teamInfo.home.abbreviation").alias("team"),
                 F.col("__b.homeBatters").alias("batters")),
        F.struct(F.lit("away").alias("side"), F.col("__b.teamInfo.away.abbreviation").alias("team"),
                 F.col("__b.awayBatters").alias("batters")))
    per_side = j.select(*keep, F.explode(sides).alias("__s"))
    b = per_side.select(*keep, "__s.side", "__s.team", F.explode("__s.batters").alias("__p"))
    b = b.filter(F.col("__p.battingOrder").endswith(starters_suffix))
    return b.select(*keep, "side", "team", F.col("__p.personId").alias("person_id"), F.col("__p.name").alias("name"),
                    F.floor(F.col("__p.battingOrder").try_cast("int") / 100).cast("string").alias("slot"))


def html_rows(df: DataFrame, html_col: str, row_pattern: str, keep: list[str] = (), skip_header: bool = True) -> DataFrame:
    """Rows of an HTML list/table as (row index, row html); the first row
    (header) is skipped."""
    rows = df.select(*keep, F.posexplode(F.regexp_extract_all(F.col(html_col), F.lit(row_pattern), 1)).alias("row_idx", "row_html"))
    return rows.filter(F.col("row_idx") > 0) if skip_header else rows


def html_cells(row_html: Column, cell_pattern: str) -> Column:
    """Positional list of trimmed cell texts of one row."""
    return F.transform(F.regexp_extract_all(row_html, F.lit(cell_pattern), 1), lambda c: F.trim(c))


def cells_typed(df: DataFrame, cells_col: str, positions: dict) -> DataFrame:
    """Positional cells -> named, typed columns (``name: (pos0, type)``)."""
    cols = [F.element_at(F.col(cells_col), p + 1).try_cast(t).alias(n) for n, (p, t) in positions.items()]
    return df.select(*[c for c in df.columns if c != cells_col], *cols)


__all__ = ["json_rows", "boxscore_lineups", "html_rows", "html_cells", "cells_typed", "anchor_text"]
