"""Table contracts: raw reader schemas and the bronze / silver / gold layouts.

Raw reader schemas bind **by position** (the CSV header is checked separately,
see ``strata.sources.csv``). Layer contracts are ordered column lists; keys
default to ``int`` as in the modelled data, and ``id_type`` widens them (the
TPC-H stand-ins carry ``bigint`` keys, which must never be narrowed).
"""

from __future__ import annotations

from pyspark.sql import types as T

INT, STR, DBL = T.IntegerType(), T.StringType(), T.DoubleType()
DATE, TS, BOOL, LONG = T.DateType(), T.TimestampType(), T.BooleanType(), T.LongType()

# --- Fixed values: the seven raw inputs, columns in file order -------------------
# (name, type, nullable). These must equal the source files' layout.
RAW_COLUMNS = {
    "circuits": [
        ("circuitId", INT, False), ("circuitRef", STR, True), ("name", STR, True),
        ("location", STR, True), ("country", STR, True), ("lat", DBL, True),
        ("lng", DBL, True), ("alt", INT, True), ("url", STR, True),
    ],
    "constructors": [
        ("constructorId", INT, False), ("constructorRef", STR, True), ("name", STR, True),
        ("nationality", STR, True), ("url", STR, True),
    ],
    "status": [("statusId", INT, False), ("status", STR, True)],
    "drivers": [
        ("driverId", INT, False), ("driverRef", STR, True), ("number", INT, True),
        ("code", STR, True), ("forename", STR, True), ("surname", STR, True),
        ("dob", DATE, True), ("nationality", STR, True),
    ],
    "races": [
        ("raceId", INT, False), ("year", INT, True), ("round", INT, True),
        ("circuitId", INT, True), ("name", STR, True), ("date", DATE, True),
        ("time", STR, True), ("url", STR, True),
    ],
    "results": [
        ("resultId", INT, False), ("raceId", INT, True), ("driverId", INT, True),
        ("constructorId", INT, True), ("number", STR, True), ("grid", INT, True),
        ("position", STR, True), ("positionText", STR, True), ("positionOrder", INT, True),
        ("points", DBL, True), ("laps", INT, True), ("time", STR, True),
        ("milliseconds", STR, True), ("fastestLap", STR, True), ("rank", STR, True),
        ("fastestLapTime", STR, True), ("fastestLapSpeed", STR, True), ("statusId", INT, True),
    ],
    "driver_standings": [
        ("driverStandingsId", INT, False), ("raceId", INT, True), ("driverId", INT, True),
        ("points", DBL, True), ("position", INT, True), ("positionText", STR, True),
        ("wins", INT, True),
    ],
}

# Columns that ``id_type`` widens.
ID_COLUMNS = frozenset({"circuitId", "constructorId", "driverId", "raceId", "resultId",
                        "driverStandingsId"})

# Key columns of each raw input: a null here (unparsable or missing) is a reject.
RAW_KEYS = {
    "circuits": ["circuitId"], "constructors": ["constructorId"], "status": ["statusId"],
    "drivers": ["driverId"], "races": ["raceId"], "results": ["resultId"],
    "driver_standings": ["driverStandingsId"],
}

# Bronze: raw renamed, then ingestion_date. (source column or None, target name)
BRONZE_RENAMES = {
    "circuits": [("circuitId", "circuit_id"), ("circuitRef", "circuit_ref"), ("name", "name"),
                 ("location", "location"), ("country", "country"), ("lat", "latitude"),
                 ("lng", "longitude"), ("alt", "altitude")],
    "races": [("raceId", "race_id"), ("year", "race_year"), ("round", "round"),
              ("circuitId", "circuit_id"), ("name", "name"), ("date", "date_race")],
    "constructors": [("constructorId", "constructor_id"), ("constructorRef", "constructor_ref"),
                     ("name", "name"), ("nationality", "nationality")],
    "drivers": [("driverId", "driver_id"), ("driverRef", "driverRef"),
                ("number", "number_driver"), ("code", "code"), ("forename", "forename"),
                ("surname", "surname"), ("dob", "dob"), ("nationality", "nationality")],
    "results": [("resultId", "result_id"), ("raceId", "race_id"), ("driverId", "driver_id"),
                ("constructorId", "constructor_id"), ("number", "number_results"),
                ("grid", "grid"), ("position", "position"), ("positionText", "position_text"),
                ("positionOrder", "position_order"), ("points", "points"), ("laps", "laps"),
                ("time", "time"), ("milliseconds", "milliseconds"),
                ("fastestLap", "fastest_lap"), ("rank", "rank"),
                ("fastestLapTime", "fastest_lap_time"),
                ("fastestLapSpeed", "fastest_lap_speed"), ("statusId", "status_id")],
    "status": [("statusId", "statusId"), ("status", "status")],
    "driver_standings": [("driverStandingsId", "driverStandingsId"), ("raceId", "raceId"),
                         ("driverId", "driverId"), ("points", "points"),
                         ("position", "position"), ("positionText", "positionText"),
                         ("wins", "wins")],
}

BRONZE_PARTITIONS = {"races": ["race_year"]}

# --- Fixed values: the layouts of the silver and gold tables ---------------------
# Silver and gold: (column, type); "ID" marks key columns that follow id_type.
ID = "ID"
SILVER_COLUMNS = {
    "dim_circuits": [("circuit_id", ID), ("circuit_name", STR), ("location", STR),
                     ("country", STR), ("latitude", DBL), ("longitude", DBL)],
    "dim_drivers": [("driver_id", ID), ("code", STR), ("forename", STR), ("surname", STR),
                    ("full_name", STR), ("date_of_birth", DATE), ("nationality", STR)],
    "dim_constructors": [("constructor_id", ID), ("constructor_name", STR),
                         ("nationality", STR)],
    "dim_status": [("status_id", INT), ("status_description", STR)],
    "dim_races": [("race_id", ID), ("race_year", INT), ("round", INT), ("circuit_id", ID),
                  ("race_name", STR), ("race_date", DATE)],
    "fact_results": [("result_id", ID), ("race_id", ID), ("driver_id", ID),
                     ("constructor_id", ID), ("grid", INT), ("finish_position", INT),
                     ("points", DBL), ("laps", INT), ("status_id", INT), ("race_year", INT),
                     ("circuit_id", ID), ("finished", BOOL), ("is_podium", BOOL),
                     ("is_win", BOOL)],
    "fact_driver_standings": [("driver_standings_id", ID), ("race_id", ID), ("driver_id", ID),
                              ("points", DBL), ("position", INT), ("wins", INT),
                              ("race_year", INT), ("round", INT)],
}
SILVER_PARTITIONS = {"dim_races": ["race_year"], "fact_results": ["race_year"],
                     "fact_driver_standings": ["race_year"]}

GOLD_COLUMNS = {
    "driver_career": [("driver_id", ID), ("full_name", STR), ("nationality", STR),
                      ("total_points", DBL), ("total_wins", INT), ("total_podiums", INT),
                      ("races_disputed", INT), ("first_season", INT), ("last_season", INT)],
    "constructor_career": [("constructor_id", ID), ("constructor_name", STR),
                           ("nationality", STR), ("total_points", DBL), ("total_wins", INT),
                           ("total_podiums", INT), ("first_season", INT),
                           ("last_season", INT)],
    "season_champions": [("race_year", INT), ("driver_id", ID), ("full_name", STR),
                         ("champion_points", DBL)],
    "drivers_without_title": [("driver_id", ID), ("full_name", STR), ("total_wins", INT),
                              ("total_points", DBL), ("rank_by_wins", INT)],
    "constructor_standings": [("race_year", INT), ("constructor_id", ID),
                              ("constructor_name", STR), ("total_points", DBL),
                              ("wins", INT), ("podiums", INT), ("season_rank", INT)],
    "constructor_dominance": [("constructor_id", ID), ("constructor_name", STR),
                              ("streak_start_year", INT), ("streak_end_year", INT),
                              ("streak_length", INT)],
}
GOLD_PARTITIONS = {"constructor_standings": ["race_year"]}


def raw_schema(entity: str, id_type: T.DataType = INT) -> T.StructType:
    return T.StructType([T.StructField(n, id_type if n in ID_COLUMNS else t, nl)
                         for n, t, nl in RAW_COLUMNS[entity]])


def bronze_schema(entity: str, id_type: T.DataType = INT) -> T.StructType:
    raw = raw_schema(entity, id_type)
    fields = [T.StructField(dst, raw[src].dataType, True) for src, dst in BRONZE_RENAMES[entity]]
    return T.StructType([*fields, T.StructField("ingestion_date", TS, True)])


def bronze_keys(entity: str) -> tuple[list[str], list[str]]:
    """Bronze names of the entity's own key columns and of its foreign keys."""
    names = dict(BRONZE_RENAMES[entity])
    own = [names[k] for k in RAW_KEYS[entity]]
    foreign = [dst for src, dst in BRONZE_RENAMES[entity]
               if dst not in own and (src in ID_COLUMNS or src == "statusId")]
    return own, foreign


def _contract(columns, id_type) -> T.StructType:
    return T.StructType([T.StructField(n, id_type if t == ID else t, True) for n, t in columns])


def silver_schema(table: str, id_type: T.DataType = INT) -> T.StructType:
    return _contract(SILVER_COLUMNS[table], id_type)


def gold_schema(table: str, id_type: T.DataType = INT) -> T.StructType:
    return _contract(GOLD_COLUMNS[table], id_type)
