"""Table schemas as StructTypes and DDL.

Snapshot tables are partitioned by their period column, so a load reads
partition p-1 (partition pruning) and overwrites partition p.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
)

FILM = StructType(
    [
        StructField("film", StringType()),
        StructField("votes", IntegerType()),
        StructField("rating", DoubleType()),
        StructField("filmid", StringType()),
    ]
)

SEASON_STATS = StructType(
    [
        StructField("season", IntegerType()),
        StructField("pts", DoubleType()),
        StructField("ast", DoubleType()),
        StructField("reb", DoubleType()),
        StructField("weight", IntegerType()),
    ]
)

# Allowed labels of the two class columns.
QUALITY_CLASSES = ("star", "good", "average", "bad")
SCORING_CLASSES = ("bad", "average", "good", "star")

ACTORS = StructType(
    [
        StructField("actorid", StringType()),
        StructField("actor", StringType(), False),
        StructField("current_year", IntegerType(), False),
        StructField("films", ArrayType(FILM)),
        StructField("quality_class", StringType()),
        StructField("is_active", BooleanType()),
    ]
)

ACTORS_HISTORY_SCD = StructType(
    [
        StructField("actorid", StringType(), False),
        StructField("actor", StringType()),
        StructField("quality_class", StringType()),
        StructField("is_active", BooleanType()),
        StructField("start_year", IntegerType(), False),
        StructField("end_year", IntegerType()),
        StructField("current_year", IntegerType(), False),
    ]
)

PLAYERS = StructType(
    [
        StructField("player_name", StringType()),
        StructField("height", StringType()),
        StructField("college", StringType()),
        StructField("country", StringType()),
        StructField("draft_year", StringType()),
        StructField("draft_round", StringType()),
        StructField("draft_number", StringType()),
        StructField("seasons", ArrayType(SEASON_STATS)),
        StructField("scoring_class", StringType()),
        StructField("is_active", BooleanType()),
        StructField("current_season", IntegerType()),
    ]
)

PLAYERS_GROWTH = StructType(
    [
        StructField("player_name", StringType()),
        StructField("first_active_season", IntegerType()),
        StructField("last_active_season", IntegerType()),
        StructField("activity_state", StringType()),
        StructField("seasons_active", ArrayType(IntegerType())),
        StructField("season", IntegerType()),
    ]
)

USER_DEVICES_CUMULATED = StructType(
    [
        StructField("user_id", LongType()),
        StructField("browser_type", StringType()),
        StructField("device_activity_datelist", ArrayType(DateType())),
        StructField("date", DateType()),
    ]
)

HOSTS_CUMULATED = StructType(
    [
        StructField("host_name", StringType()),
        StructField("host_activity_datelist", ArrayType(DateType())),
        StructField("date", DateType()),
    ]
)

HOST_ACTIVITY_REDUCED = StructType(
    [
        StructField("host", StringType()),
        StructField("hit_array", ArrayType(LongType())),
        StructField("unique_visitors", ArrayType(LongType())),
        StructField("month_start", DateType()),
    ]
)

TEAM_VERTEX = StructType(
    [
        StructField("identifier", LongType()),
        StructField("type", StringType()),
        StructField("properties", MapType(StringType(), StringType())),
    ]
)

# Column comments written into the DDL.
COLUMN_COMMENTS: dict[str, dict[str, str]] = {
    "actors": {"quality_class": "class of the average film rating in the latest active year"},
    "actors_history_scd": {"end_year": "last year of the streak; rows of current streaks end at current_year"},
}

# Columns restricted to a fixed set of labels (the reference's enum types).
ENUM_COLUMNS: dict[str, dict[str, tuple[str, ...]]] = {
    "actors": {"quality_class": QUALITY_CLASSES},
    "actors_history_scd": {"quality_class": QUALITY_CLASSES},
    "players": {"scoring_class": SCORING_CLASSES},
}

# table name -> (schema, partition columns, comment)
TABLES: dict[str, tuple[StructType, tuple[str, ...], str]] = {
    "actors": (ACTORS, ("current_year",), "Yearly cumulative snapshot of actors with their film history"),
    "actors_history_scd": (ACTORS_HISTORY_SCD, ("current_year",), "Type 2 SCD of actor quality class and activity"),
    "players": (PLAYERS, ("current_season",), "Seasonal cumulative snapshot of players"),
    "players_growth": (PLAYERS_GROWTH, ("season",), "Player lifecycle state per season"),
    "user_devices_cumulated": (USER_DEVICES_CUMULATED, ("date",), "Active dates per user and browser"),
    "hosts_cumulated": (HOSTS_CUMULATED, ("date",), "Active dates per host"),
    "host_activity_reduced": (HOST_ACTIVITY_REDUCED, ("month_start",), "Monthly per-day hits and visitors per host"),
    "team_vertex": (TEAM_VERTEX, (), "Graph vertices of teams"),
}


def ddl(name: str, location: str | None = None, table_name: str | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS`` text for one of :data:`TABLES`."""
    schema, parts, comment = TABLES[name]
    data_cols = [f for f in schema.fields if f.name not in parts]
    part_cols = [schema[p] for p in parts]
    schema = StructType(data_cols + part_cols)
    notes = COLUMN_COMMENTS.get(name, {})

    def col(f):
        text = f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
        return text + (f" COMMENT '{notes[f.name]}'" if f.name in notes else "")

    cols = ",\n  ".join(col(f) for f in schema.fields)
    text = f"CREATE TABLE IF NOT EXISTS {table_name or name} (\n  {cols}\n) USING parquet"
    if parts:
        # Overwrites replace only the periods written (a rerun of one period
        # is idempotent and never touches the partition being read).
        text += "\nOPTIONS ('partitionOverwriteMode' 'dynamic')"
        text += f"\nPARTITIONED BY ({', '.join(parts)})"
    if location:
        text += f"\nLOCATION '{location}'"
    return text + f"\nCOMMENT '{comment}'"


def check_enums(df: DataFrame, name: str) -> DataFrame:
    """Fail the job (``raise_error``) on a label outside the allowed set of
    an enum column; NULL passes.  A native expression, evaluated per row in
    the same stage."""
    out = df
    for c, allowed in ENUM_COLUMNS.get(name, {}).items():
        if c in df.columns:
            bad = F.col(c).isNotNull() & ~F.col(c).isin(*allowed)
            msg = F.concat(F.lit(f"{name}.{c}: label not in {list(allowed)}: "), F.col(c))
            out = out.withColumn(c, F.when(bad, F.raise_error(msg)).otherwise(F.col(c)))
    return out


def define_table(spark: SparkSession, name: str, location: str | None = None, table_name: str | None = None) -> str:
    """Create the table (if absent); returns its name."""
    spark.sql(ddl(name, location, table_name))
    return table_name or name
