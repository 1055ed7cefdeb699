"""Schemas of the six raw datasets and of the warehouse tables.

Raw files are read with every named column as text; typing happens after
the read with try-casts so a bad cell becomes NULL instead of failing the
job. Columns a file has beyond these pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Typed targets of the tolerant ingest: column -> kind. Kinds are
# "timestamp", "long", "double" and "string" (see functions.coerce).
RAW_TYPES: dict[str, dict[str, str]] = {
    "player_valuations": {
        "player_id": "long",
        "date": "timestamp",
        "market_value_in_eur": "long",
        "current_club_id": "long",
        "player_club_domestic_competition_id": "string",
    },
    "competitions": {
        "competition_id": "string",
        "name": "string",
        "sub_type": "string",
        "country_name": "string",
        "url": "string",
        "date": "timestamp",
    },
    "players": {"player_id": "long", "name": "string"},
    "appearances": {
        "appearance_id": "string",
        "game_id": "long",
        "player_id": "long",
        "player_club_id": "long",
        "player_current_club_id": "long",
        "date": "timestamp",
        "player_name": "string",
        "competition_id": "string",
        "yellow_cards": "long",
        "red_cards": "long",
        "goals": "long",
        "assists": "long",
        "minutes_played": "long",
    },
    "clubs": {
        "club_id": "long",
        "name": "string",
        "domestic_competition_id": "string",
        "total_market_value": "long",
        "average_age": "double",
        "foreigners_percentage": "double",
    },
    "games": {},
}


def _struct(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Warehouse tables with fixed columns. Base tables key months as YYYY-MM,
# rollup tables as YYYY-MM-01; both are kept as text.
PLAYER_VALUATIONS = _struct([
    ("player_id", T.IntegerType()),
    ("date", T.DateType()),
    ("market_value", T.FloatType()),
    ("current_club_id", T.IntegerType()),
    ("competition_id", T.StringType()),
    ("partition_date", T.StringType()),
])

PLAYER_APPEARANCES = _struct([
    ("appearance_id", T.StringType()),
    ("game_id", T.IntegerType()),
    ("player_id", T.IntegerType()),
    ("player_club_id", T.IntegerType()),
    ("player_current_club_id", T.IntegerType()),
    ("date", T.DateType()),
    ("player_name", T.StringType()),
    ("competition_id", T.StringType()),
    ("yellow_cards", T.IntegerType()),
    ("red_cards", T.IntegerType()),
    ("goals", T.IntegerType()),
    ("assists", T.IntegerType()),
    ("minutes_played", T.IntegerType()),
    ("partition_date", T.StringType()),
])

LEAGUE_VALUATION_EVOLUTION = _struct([
    ("domestic_competition_id", T.StringType()),
    ("total_valuation", T.FloatType()),
    ("min_valuation", T.FloatType()),
    ("max_valuation", T.FloatType()),
    ("player_count", T.IntegerType()),
    ("partition_date", T.StringType()),
])

CLUB_VALUATION_EVOLUTION = _struct([
    ("club_name", T.StringType()),
    ("total_valuation", T.FloatType()),
    ("min_valuation", T.FloatType()),
    ("max_valuation", T.FloatType()),
    ("squad_size", T.IntegerType()),
    ("domestic_competition_id", T.StringType()),
    ("partition_date", T.StringType()),
])

TABLE_SCHEMAS = {
    "player_valuations": PLAYER_VALUATIONS,
    "player_appearances": PLAYER_APPEARANCES,
    "league_valuation_evolution": LEAGUE_VALUATION_EVOLUTION,
    "club_valuation_evolution": CLUB_VALUATION_EVOLUTION,
}
