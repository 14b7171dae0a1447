"""Irregular sheets as grids: rows of cells with an unknown number of lines before the header.

A grid table has ``file_id``, ``row_idx`` and ``cells`` (array of text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions.application import strip

# The text that marks the header row and the positions of the two data cells.
HEADER_TEXT = "application number"
NUMBER_CELL, DECISION_CELL = 3, 4


def _cell(place: int) -> Column:
    return F.try_element_at("cells", F.lit(place))


def header_rows(grid: DataFrame, marker: str = HEADER_TEXT) -> DataFrame:
    """The first row of each file in which any cell contains the marker, whatever its case."""
    hit = F.exists("cells", lambda c: F.lower(c).contains(marker))
    return grid.where(hit).groupBy("file_id").agg(F.min("row_idx").alias("header_row"))


def files_without_header(grid: DataFrame, marker: str = HEADER_TEXT) -> DataFrame:
    return grid.select("file_id").distinct().join(header_rows(grid, marker), "file_id", "left_anti")


def clean_grid(grid: DataFrame, marker: str = HEADER_TEXT) -> DataFrame:
    """Number and decision of every data row: after the header, not empty, not a repeated header, trimmed."""
    number, decision = strip(_cell(NUMBER_CELL)), strip(_cell(DECISION_CELL))
    return (
        grid.join(header_rows(grid, marker), "file_id")
        .where(F.col("row_idx") > F.col("header_row"))
        .select("file_id", "row_idx", number.alias("application_number"), decision.alias("decision"))
        .dropna(how="all", subset=["application_number", "decision"])
        .where(F.coalesce(F.lower("application_number") != marker, F.lit(True)))
    )


def drop_note_row(grid: DataFrame, header_row: int = 0) -> DataFrame:
    """Rows of a titled sheet without the notes line that follows its header."""
    return grid.where(F.col("row_idx") > header_row + 1)


def sheet_table(grid: DataFrame, names: list[str], header_row: int = 0) -> DataFrame:
    """A titled sheet as a table: notes line dropped, cells by position, rows that are entirely null dropped."""
    cells = [_cell(i + 1).alias(name) for i, name in enumerate(names)]
    return drop_note_row(grid, header_row).select("file_id", "row_idx", *cells).dropna(how="all", subset=names)
