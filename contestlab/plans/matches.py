"""Match feature tables: from a ledger to training and next-round sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from contestlab.operators.scans import BLOCK_ROWS
from contestlab.operators.sides import (
    DEFAULT_PRIOR_POINTS, FORM_GAMES, fitting, game_order, group_of, prior_season_points, race_flags, side_scan, sides, standing)

SIDES = ("home", "away")
FEATURES = ["points_before", "form", "in_title_race", "in_relegation_race", "standing", "prior_year", "was_promo"]


# Fixed value: result of an unplayed match after the literal fill.
UNPLAYED = "0"


def ledger_of(fixtures: DataFrame) -> DataFrame:
    """Ledger columns of a fixture table."""
    return fixtures.select(
        F.col("match_id").alias("contest_id"), "day", F.col("season_start").alias("season"),
        F.col("home_team").alias("home"), F.col("away_team").alias("away"), "winner", "round_no",
        F.col("title").alias("league"))


def match_features(ledger: DataFrame, mode: str = "intended", as_of: str | None = None, *,
                   games: int = FORM_GAMES, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """One row per match with both sides' points, form, race flags, standing and prior season.

    `as_of` is "before" (default) or "after" (default in literal mode, where race flags and
    standing include the match itself)."""
    literal = mode == "literal"
    as_of = as_of or ("after" if literal else "before")
    rows = sides(ledger, keep=["home", "away"])
    order, group = game_order(rows, mode), group_of(rows)
    block_rows = fitting(rows, block_rows)
    options = {"games": games, "mode": mode, "order": order, "block_rows": block_rows}
    # Facts per side and season are joined on the keys of the side windows: one shuffle serves both.
    if literal:
        scanned = side_scan(rows, **options)
        scanned = scanned.join(prior_season_points(scanned, mode, order), group, "left")
    else:
        scanned = side_scan(rows.join(prior_season_points(rows, mode, order), group, "left"), sized_by=rows, **options)
    featured = standing(race_flags(scanned, as_of=as_of), mode, as_of, block_rows=block_rows, sized_by=rows)
    featured = featured.withColumn("was_promo", F.col("prior_year").isNull().cast("int")).withColumn(
        "prior_year", F.coalesce("prior_year", F.lit(DEFAULT_PRIOR_POINTS)))
    if literal:
        featured = featured.na.fill(0, ["points_before", "standing"]).na.fill(UNPLAYED, ["winner"])
    # Fold both sides to one row. The columns of the match are grouping keys, so that the
    # aggregate holds numbers only and stays a hash aggregate.
    at_home = F.col("is_home") == 1
    parts = [F.max(F.when(at_home, F.col("round_no" if "round_no" in rows.columns else "seq"))).alias("round_no")]
    for side, cond in zip(SIDES, (at_home, ~at_home)):
        parts += [F.max(F.when(cond, F.col(c))).alias(f"{side}_{c}") for c in FEATURES]
    league = [c for c in ("league",) if c in rows.columns]
    return featured.groupBy("contest_id", "day", "season", "winner", "home", "away", *league).agg(*parts)


# Whether a side was promoted only says why its points of the year before are the default.
TRAINING_COLUMNS = ["winner", "round_no", *(f"{side}_{c}" for c in FEATURES if c != "was_promo" for side in SIDES)]


def _played() -> Column:
    """Whether the match has a result, in features of either mode."""
    return F.col("winner").isNotNull() & (F.col("winner") != UNPLAYED)


def training_set(features: DataFrame, drop_seasons: Sequence[int] = ()) -> DataFrame:
    """Label and features of the played matches, one row per match. The dropped seasons only
    served the prior-season lookup."""
    kept = features.filter(~F.col("season").isin(*drop_seasons)) if drop_seasons else features
    return kept.filter(_played()).select("contest_id", *TRAINING_COLUMNS)


def next_round(features: DataFrame, round_no: int, drop_seasons: Sequence[int] = ()) -> DataFrame:
    """Unplayed matches of one round whose home side already has points."""
    kept = features.filter(~F.col("season").isin(*drop_seasons)) if drop_seasons else features
    return kept.filter(
        ~_played() & (F.col("home_points_before") != 0) & (F.col("round_no") == round_no)
    ).select("contest_id", *[c for c in TRAINING_COLUMNS if c != "winner"])


__all__ = ["FEATURES", "TRAINING_COLUMNS", "ledger_of", "match_features", "next_round", "training_set"]
