"""Spreadsheet grids: ``row_no`` plus text columns, where title rows precede a header row.

``row_no`` is the sheet row and comes with the data; it is never made up after a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matflow.operators.frames import clean_name_list


def drop_leading_rows(grid: DataFrame, count: int) -> DataFrame:
    return grid.filter(F.col("row_no") > count)


def named_sheet(grid: DataFrame, sheet: str) -> DataFrame:
    """Rows of one sheet, without the sheet's name; prunes files where the grid is stored partitioned by ``sheet``."""
    return grid.filter(F.col("sheet") == sheet).drop("sheet")


def promote_header(grid: DataFrame, header_row: int, tops: DataFrame | None = None) -> DataFrame:
    """Use row ``header_row`` as (cleaned) column names and keep the rows after it.

    Only the header row reaches the driver. Two different ones, as in a grid of several files, are an error. ``tops``
    are the rows of ``grid`` down to the header, where these can be had without the others.
    """
    cells = [name for name in grid.columns if name != "row_no"]
    headers = (grid if tops is None else tops).filter(F.col("row_no") == header_row).select(*cells).distinct().take(2)
    if len(headers) != 1:
        raise ValueError(f"row {header_row} should hold one header; found {len(headers) or 'none'}")
    return drop_leading_rows(grid, header_row).select(*cells).toDF(*clean_name_list(headers[0]))


def _bare(name: Column) -> Column:
    """A name's lower-case letters and digits: spelling that ``clean_names`` removes doesn't count."""
    spelled = F.replace(F.replace(F.lower(name), F.lit("%"), F.lit("percent")), F.lit("#"), F.lit("number"))
    return F.regexp_replace(spelled, "[^0-9a-z]+", "")


def header_scores(grid: DataFrame, names: Sequence[str], run: str = "as_of", within: int = 20) -> DataFrame:
    """(run, row_no, score) of the first ``within`` rows: how many of the declared ``names`` are among their cells."""
    cells = [name for name in grid.columns if name not in (run, "row_no")]
    declared = F.array(*(_bare(F.lit(name)) for name in names))
    found = F.array_intersect(declared, F.array(*(_bare(F.col(f"`{c}`")) for c in cells)))
    return grid.filter(F.col("row_no") <= within).select(run, "row_no", F.size(found).alias("score"))


def detect_headers(
    grid: DataFrame, names: Sequence[str], run: str = "as_of", within: int = 20, least: float = 0.5
) -> DataFrame:
    """(run, header_row, score, ties) of every run with a row among the first ``within``.

    The header is the row with the most of the declared names; of rows that tie the first, and ``ties`` counts the
    others. With less than the share ``least`` of the names a row is no header, and header_row is NULL.
    """
    scores = header_scores(grid, names, run, within)
    top = scores.groupBy(run, "score").agg(F.count(F.lit(1)).alias("rows"), F.max(-F.col("row_no")).alias("above"))
    best = top.groupBy(run).agg(F.max(F.struct("score", "above", "rows")).alias("best"))
    row = F.when(F.col("best.score") >= max(1.0, least * len(set(names))), -F.col("best.above"))
    return best.select(run, row.alias("header_row"), "best.score", (F.col("best.rows") - 1).alias("ties"))


def promote_header_per_run(
    grid: DataFrame,
    header_rows: DataFrame | None = None,
    run: str = "as_of",
    names: Sequence[str] = (),
    tops: DataFrame | None = None,
) -> DataFrame:
    """As ``promote_header`` for the grids of many runs: ``header_rows`` (run, header_row) says where each one's is.

    Without ``header_rows`` the header is found by the declared ``names`` (``detect_headers``); a run in which none is
    found is an error.

    All rows are read once, whatever the number of layouts: a run's rows get its header by a join, and every column
    of the result takes the cell that has its name in that layout. A column a layout lacks is NULL. Runs that are not
    listed are left out; a run with two different headers, or none, is an error. The driver reads the different
    layouts only. ``tops`` are the rows of ``grid`` down to the headers, where these can be had without the others.
    """
    cells = [name for name in grid.columns if name not in (run, "row_no")]
    if header_rows is None:
        header_rows = detect_headers(grid if tops is None else tops, names, run)
    placed = grid.join(header_rows.select(run, "header_row"), run)
    above = placed if tops is None else tops.join(header_rows.select(run, "header_row"), run)
    layout = F.array(*(F.coalesce(c, F.lit("NA")) for c in cells))
    headers = above.filter(F.col("row_no") == F.col("header_row")).select(run, layout.alias("__layout")).distinct()
    counts = header_rows.select(run).distinct().join(headers, run, "left").groupBy(run).agg(F.count("__layout").alias("n"))
    if wrong := [row[run] for row in counts.filter("n <> 1").limit(5).collect()]:
        raise ValueError(f"these runs don't have one header: {wrong}")
    layouts = [row["__layout"] for row in headers.select("__layout").distinct().orderBy("__layout").collect()]
    sources: dict[str, Column] = {}
    for names in layouts:
        for cell, name in zip(cells, clean_name_list(names)):
            here = F.when(F.col("__layout") == F.array(*map(F.lit, names)), F.col(cell))
            sources[name] = F.coalesce(sources[name], here) if name in sources else here
    data = placed.filter(F.col("row_no") > F.col("header_row")).join(headers, run)
    return data.select(run, *(source.alias(name) for name, source in sources.items()))
