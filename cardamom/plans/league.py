"""League table from match results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Points for a win and a draw.
WIN_POINTS = 3
DRAW_POINTS = 1


def match_goals(matches: DataFrame) -> DataFrame:
    """``2-1`` -> two integers; any other text stops the job."""
    goals = F.split("result", "-", -1)
    bad = F.raise_error(F.concat(F.lit("not a result: "), F.col("result")))
    checked = F.when(F.size(goals) == 2, goals).otherwise(bad)
    return matches.select(
        "home",
        "away",
        checked[0].cast("int").alias("home_goals"),
        checked[1].cast("int").alias("away_goals"),
    )


def _side(team: str, scored: str, conceded: str) -> Column:
    won = (F.col(scored) > F.col(conceded)).cast("int")
    drawn = (F.col(scored) == F.col(conceded)).cast("int")
    lost = (F.col(scored) < F.col(conceded)).cast("int")
    return F.struct(
        F.col(team).alias("team"),
        F.col(scored).alias("goals_for"),
        F.col(conceded).alias("goals_against"),
        won.alias("won"),
        drawn.alias("drawn"),
        lost.alias("lost"),
        (won * WIN_POINTS + drawn * DRAW_POINTS).alias("points"),
    )


def team_rows(matches: DataFrame) -> DataFrame:
    """Two rows per match, one per side, from a single scan."""
    sides = F.array(
        _side("home", "home_goals", "away_goals"), _side("away", "away_goals", "home_goals")
    )
    return match_goals(matches).select(F.inline(sides))


def league_table(matches: DataFrame) -> DataFrame:
    """Goals, matches, wins, draws, losses and points per team, best first."""
    sums = ["goals_for", "goals_against", "won", "drawn", "lost", "points"]
    return (
        team_rows(matches)
        .filter(F.col("team").isNotNull())
        .groupBy("team")
        .agg(*[F.sum(c).alias(c) for c in sums], F.count("*").alias("played"))
        .orderBy(F.col("points").desc(), "team")
    )
