"""Catalog tables for the results of a batch replay."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.operators.eventtime import final_watermark
from wakeline.operators.minutes import counted, minute_aggregate
from wakeline.plans.replay import Replay, clean_records, detail_columns, rejected_columns
from wakeline.schema import DETAIL, MINUTE, REJECTED
from wakeline.sources.staging import staged

# Table name -> layout. All are partitioned by aircraft.
TABLES = {
    "telemetry_detail": DETAIL,
    "telemetry_rejected": REJECTED,
    "telemetry_minute": MINUTE,
}


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in schema)


def create_tables(spark: SparkSession, database: str, provider: str = "parquet") -> None:
    """Create the tables that do not exist; existing ones are left as they are."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, schema in TABLES.items():
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({_columns(schema)}) "
            f"USING {provider} OPTIONS (compression 'zstd') PARTITIONED BY (aircraft_id)"
        )


def reset_tables(spark: SparkSession, database: str) -> None:
    """Drop the tables and their rows. Nothing else in the package does that."""
    for name in TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")


def list_tables(spark: SparkSession, database: str) -> list[str]:
    """Tables of the database, without the session's temporary views."""
    tables = spark.catalog.listTables(database)
    return sorted(table.name for table in tables if not table.isTemporary)


def list_databases(spark: SparkSession) -> list[str]:
    return sorted(database.name for database in spark.catalog.listDatabases())


def _append(rows: DataFrame, table: str) -> None:
    """Rows by aircraft, a large aircraft split over several files."""
    columns = rows.sparkSession.table(table).columns
    rows.hint("rebalance", "aircraft_id").select(*columns).write.insertInto(table)


def save_replay(replay: Replay, database: str) -> None:
    """Append the three results; the feed is judged once and shared by them."""
    rules = replay.rules
    marked = staged(replay.marked, "marked")
    kept = marked.where(F.col("reason").isNull())
    entered = kept.where(counted(F.col("watermark"), rules))
    closed = F.col("window_end") <= final_watermark(marked, rules)
    _append(detail_columns(kept), f"{database}.telemetry_detail")
    _append(
        rejected_columns(marked.where(F.col("reason").isNotNull())),
        f"{database}.telemetry_rejected",
    )
    _append(minute_aggregate(entered, rules).where(closed), f"{database}.telemetry_minute")


def append_clean_records(replay: Replay, path: str) -> None:
    """Append the reduced records of accepted rows as JSON lines."""
    clean_records(replay.first).write.mode("append").json(path)
