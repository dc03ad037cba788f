"""Typed reads of signal tables, and the gate in front of every job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsignals.sources.schemas import ANY_JSON, CORRUPT, schema, schema_with_corrupt

# Fixed value.
DEFAULT_ENVIRONMENTS = ("production", "staging")


def signal_scan(
    spark: SparkSession, signal: str, path: str, *, fmt: str = "parquet", streaming: bool = False, **options
) -> DataFrame:
    """A signal table under its explicit schema, from Parquet or JSON lines, batch or stream.

    No inference pass reads the data first. A JSON line that doesn't fit keeps its text in
    ``_corrupt_record`` instead of failing the job; column pruning and filters reach Parquet.
    """
    reader = (spark.readStream if streaming else spark.read).options(**options)
    if fmt == "json":
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        return _as_text(reader.schema(schema_with_corrupt(signal)).json(path), signal)
    return reader.schema(schema(signal)).parquet(path)


def parse_lines(lines: DataFrame, column: str, signal: str) -> DataFrame:
    """The same for JSON lines that already sit in a column (a log table, a topic)."""
    parsed = F.from_json(
        F.col(column),
        schema_with_corrupt(signal),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    others = [c for c in lines.columns if c != column]
    rows = lines.select(*others, parsed.alias("row"))
    # A column of the line itself comes before one of the same name beside it.
    own = set(rows.schema["row"].dataType.names)
    return _as_text(rows.select(*[c for c in others if c not in own], "row.*"), signal)


def _as_text(rows: DataFrame, signal: str) -> DataFrame:
    return rows.withColumns({c: F.to_json(c) for c in ANY_JSON.get(signal, ())})


def signal_gate(signals: DataFrame, projects: DataFrame) -> DataFrame:
    """Rows of projects that can send: a DSN with a key, and an enabled environment.

    A semi join on (project, environment). It carries no broadcast hint: Spark broadcasts the
    project side when its measured size allows, and shuffles otherwise.
    """
    default = F.array(*[F.lit(e) for e in DEFAULT_ENVIRONMENTS])
    able = (
        projects.filter(F.col("has_dsn") & F.col("has_key"))
        .select("project_id", F.explode(F.coalesce("enabled_environments", default)).alias("environment"))
        .distinct()
    )
    return signals.join(able, ["project_id", "environment"], "left_semi")
