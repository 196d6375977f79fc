"""Header and title removal on a table of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textforge.operators.ordering import carried


def drop_doc_headers(lines: DataFrame, file: str = "file", lines_per_block: int = 100_000) -> DataFrame:
    """A header line becomes one blank line, the line after it (the title) is dropped
    unseen, closing and empty lines are dropped.

    Whether a line is a title depends on the run of header-like lines just before it: an
    odd run ends in a real header.  The run length is the distance to the last other line,
    so one carried maximum replaces the reader's state, for files of any length.
    """
    has_header = F.contains("line", F.lit("<doc"))
    marked = carried(
        lines, [file], F.floor(F.col("line_no") / lines_per_block), ["line_no"],
        F.when(~has_header, F.col("line_no")), "_last_other")
    first_no = F.lit(-1)
    run_before = F.col("line_no") - 1 - F.coalesce("_last_other", first_no)
    return (marked.where(run_before % 2 == 0)
            .where(has_header | (~F.contains("line", F.lit("</doc>")) & (F.col("line") != "")))
            .withColumn("line", F.when(has_header, F.lit("")).otherwise(F.col("line")))
            .drop("_last_other"))
