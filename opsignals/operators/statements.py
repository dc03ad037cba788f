"""SQL statements grouped by shape, and the objects that errors touched."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsignals.functions import sqltext
from opsignals.functions.text import is_blank


def sql_digest(statements: DataFrame) -> DataFrame:
    """Calls, total and largest time per masked statement and database."""
    # Blank statements go before masking: a filter on the masked text would mask twice.
    masked = statements.filter(~is_blank(F.col("statement"))).select(
        sqltext.mask(F.col("statement"), F.col("db_system")).alias("statement"), "db_system", "duration_ms"
    )
    return masked.groupBy("statement", "db_system").agg(
        F.count(F.lit(1)).alias("calls"),
        F.sum("duration_ms").alias("total_ms"),
        F.max("duration_ms").alias("max_ms"),
    )


def sql_touchpoints(errors: DataFrame) -> DataFrame:
    """Errors per table, view or procedure and operation. Statements are masked and counted
    first, so each distinct shape is read for names once."""
    shapes = (
        errors.filter(~is_blank(F.col("statement")))
        .groupBy(sqltext.mask(F.col("statement")).alias("masked"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("found", sqltext.objects(F.col("masked")))
    )

    def named(kind: str, column: str):
        return F.transform(f"found.{column}", lambda n: F.struct(n.alias("name"), F.lit(kind).alias("object_kind")))

    # An inner explode lets Spark infer a filter and push it, and the reading of names with it,
    # below the count, back onto every statement. The outer one is filtered afterwards.
    touched = shapes.select(
        "n",
        F.col("found.operation").alias("operation"),
        F.inline_outer(F.concat(named("relation", "relations"), named("procedure", "procedures"))),
    ).filter(F.col("name").isNotNull())
    return touched.groupBy("name", "object_kind", "operation").agg(F.sum("n").alias("errors"))
