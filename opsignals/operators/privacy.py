"""Personal data and secrets: redacted, counted, and hidden by key."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsignals.functions import pii
from opsignals.shipping import ship


def pii_redact(df: DataFrame, *columns: str) -> DataFrame:
    """The named text columns with every hit replaced by its label; whole texts, no shuffle."""
    return df.withColumns({c: pii.redact(F.col(c)) for c in columns})


def pii_audit(df: DataFrame, text: str, by: str) -> DataFrame:
    """What redaction would change: hits per label and source, and the share of rows hit."""
    redacted = df.select(F.col(by), F.col(text), pii.redact(F.col(text)).alias("redacted"))
    hits = [pii.label_hits(F.col(text), F.col("redacted"), label).alias(label) for label in pii.LABELS]
    counted = redacted.select(by, (F.col(text) != F.col("redacted")).cast("int").alias("hit"), *hits)
    sums = [F.sum(f"`{label}`").alias(label) for label in pii.LABELS]
    totals = counted.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), F.sum("hit").alias("rows_hit"), *sums)
    entries = F.array(*[F.struct(F.lit(x).alias("label"), F.col(f"`{x}`").alias("hits")) for x in pii.LABELS])
    return totals.select(
        by, "rows", "rows_hit", (F.col("rows_hit") / F.col("rows")).alias("share"), F.inline(entries)
    )


@F.pandas_udf(T.StringType())
def _redact_json(texts: pd.Series) -> pd.Series:
    return texts.map(pii.redact_json_text, na_action="ignore")


def redact_fields(column: Column) -> Column:
    """``map<string, string>`` whose values may be JSON text: hidden and redacted at any depth. Only
    rows with a value that looks nested go to Python; call ``ship`` for the session before."""
    nested = F.coalesce(F.exists(F.map_values(column), pii.looks_nested), F.lit(False))
    deep = F.from_json(_redact_json(F.when(nested, F.to_json(column))), "map<string,string>")
    return F.when(nested, deep).otherwise(pii.redact_map(column))


def _walk(c: Column, kind: T.DataType, name: str | None) -> Column:
    if name is not None and pii.key_is_sensitive(name):
        # Only text can hold the mark; any other type is emptied instead.
        mark = F.lit(pii.REDACTED) if isinstance(kind, T.StringType) else F.lit(None).cast(kind)
        return F.when(c.isNotNull(), mark)
    if isinstance(kind, T.StructType):
        fields = [_walk(c[f.name], f.dataType, f.name).alias(f.name) for f in kind.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda e: _walk(e, kind.elementType, name))
    if isinstance(kind, T.MapType) and isinstance(kind.valueType, T.StringType):
        return pii.redact_map(c)
    if isinstance(kind, T.MapType):
        return F.transform_values(
            c,
            lambda k, v: F.when(pii.is_sensitive_key(k), F.lit(None).cast(kind.valueType)).otherwise(
                _walk(v, kind.valueType, None)
            ),
        )
    return pii.redact(c) if isinstance(kind, T.StringType) else c


def sensitive_key_redact(df: DataFrame, column: str, *, json_text: bool = False) -> DataFrame:
    """Values under sensitive keys hidden, at any depth, and the remaining strings redacted.

    A typed column is rewritten along its schema, inside the JVM. JSON text has no known depth:
    it goes through one Arrow batch function.
    """
    if json_text:
        ship(df.sparkSession)
        return df.withColumn(column, _redact_json(F.col(column)))
    return df.withColumn(column, _walk(F.col(column), df.schema[column].dataType, None))
