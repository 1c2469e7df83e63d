"""Historical dashboard cuts over the master view.

Plain grouped aggregates: partial aggregation happens in each task
before the shuffle, so a season, circuit or team holding a third of all
rows costs one partial row per task, not a hot partition. The distinct
race counts are two-level aggregates (group, race) then group, which
also pre-aggregate per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _c(name: str):
    return F.col(f"`{name}`")


def championship_trend(master: DataFrame) -> DataFrame:
    """Per season and team: races, points, wins (finish position 1), DNFs."""
    return master.groupBy(_c("Season").alias("season"), _c("Team ID").alias("team_id")).agg(
        F.countDistinct(_c("Race Key")).alias("races"),
        F.sum(_c("Points")).alias("points"),
        F.count_if(_c("Finish Position") == 1).alias("wins"),
        F.count_if(_c("DNF")).alias("dnfs"),
    )


def circuit_breakdown(master: DataFrame) -> DataFrame:
    """Per circuit country: races, results, average grid, average points."""
    return master.groupBy(_c("Country").alias("country")).agg(
        F.countDistinct(_c("Race Key")).alias("races"),
        F.count(F.lit(1)).alias("results"),
        F.avg(_c("Grid Position")).alias("avg_grid"),
        F.avg(_c("Points")).alias("avg_points"),
    )


def pit_stop_impact(master: DataFrame) -> DataFrame:
    """Per number of pit stops: results, average positions gained, average
    finishing order, DNF rate."""
    return master.groupBy(_c("Pit Stops").alias("pit_stops")).agg(
        F.count(F.lit(1)).alias("results"),
        F.avg(_c("Positions Gained")).alias("avg_positions_gained"),
        F.avg(_c("Position Order")).alias("avg_position_order"),
        F.avg(_c("DNF").cast("int")).alias("dnf_rate"),
    )


def driver_team_comparison(master: DataFrame) -> DataFrame:
    """Per driver and team: starts, points, best finish, average finish."""
    return master.groupBy(_c("Driver ID").alias("driver_id"), _c("Team Nationality").alias("team_nationality")).agg(
        F.count(F.lit(1)).alias("starts"),
        F.sum(_c("Points")).alias("points"),
        F.min(_c("Finish Position")).alias("best_finish"),
        F.avg(_c("Finish Position")).alias("avg_finish"),
    )
