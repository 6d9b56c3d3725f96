"""Declared schemas of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(text: str) -> T.StructType:
    kinds = {"s": T.StringType(), "i": T.IntegerType(), "l": T.LongType(), "d": T.DateType(),
             "f": T.DoubleType(), "a": T.ArrayType(T.StringType())}
    return T.StructType([
        T.StructField(name, kinds[kind]) for name, kind in (field.split(":") for field in text.split())])


FIXTURE = _schema(
    "day:d kickoff:s home_team:s dash:s away_team:s score:s has_finished:i round_no:i ft_home:i ft_away:i "
    "ht_home:i ht_away:i season_id:s season_start:i season_end:i title:s match_id:s winner:s diff:i")

LINEUP = _schema(
    "number:s player:s subbed_time:s is_starting:i team:s is_home:i match_id:s season_id:s player_link:s player_key:s")

BIOGRAPHY = _schema(
    "player:s team:s season_id:s player_slug:s player_link:s dob:d country:s height:s weight:s position:s foot:s "
    "height_cm:f weight_kg:f field_position:s player_key:s")

PLAYER_SEASON = _schema(
    "league:s season:s team:s matches:i goals:i starts:i sub_in:i sub_out:i yellows:i two_yellows:i red:i "
    "player_name:s player_link:s")

PAGES = _schema("page_id:l url:s html:s")

PAGE_ROWS = _schema("page_id:l table_no:i row_no:i cells:a n_rows:i")
