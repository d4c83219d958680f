"""Summary questions over a finished star schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.operators.aggregates import row_count, time_interval, top_groups
from martflow.operators.combine import stack_frames


def questions(star: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The standing questions, by name."""
    return {
        "count_songplays": row_count(star["songplays"]),
        "time_interval": time_interval(star["time"], "start_time"),
        "most_repeated_locations": top_groups(star["artists"], "location", "n", 5),
        "years_with_most_productivity": top_groups(star["songs"], "year", "n", 5),
        "payment_analysis": top_groups(star["users"], "level", "n", 2),
    }


def long_form(answers: Mapping[str, DataFrame]) -> DataFrame:
    """All answers in one frame: question, column, and value as text per row.

    Answers are reports of a few rows each; ``key`` is the first column of an
    answer with several.
    """
    return stack_frames(
        *[
            df.select(
                F.lit(name).alias("question"),
                (F.col(df.columns[0]).cast("string") if len(df.columns) > 1 else F.lit(None).cast("string")).alias("key"),
                F.col(df.columns[-1]).cast("string").alias("value"),
            )
            for name, df in answers.items()
        ]
    )
