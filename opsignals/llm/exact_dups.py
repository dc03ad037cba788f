"""Exact duplicates by content hash and bytes (operator 12), in DataFrame functions alone.

Texts are grouped by a 128-bit hash of their content and, within a hash, by their bytes: one
aggregate whose partial step leaves a text once per task, so a text that a third of all documents
share is shuffled once per task and not once per document. A hash that holds one text only, which
is every hash unless two texts collide, then stands for its text, and the rows meet their group by
hash without their texts. Rows of a colliding hash meet their group by bytes.

Rows come to that join as cells, the ids of one hash and one stretch of ``CELL`` ids, so that a hash
of a third of all documents is spread over many tasks before the join and has few rows in it.

The row with the largest (or smallest) id of a group stays. A null text is an empty one; empty texts
are duplicates of one another. A null id is smaller than all others; a group without any id keeps
a row whose id is null. Of rows with the same id and text one stays. Repeated rows stay in the
result, further columns are left behind, an empty table gives an empty result, and texts of any
length are compared whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsignals.llm.common import table, texts, written

CELL = 4096
_NO_ID = -(1 << 63)


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _groups(rows: DataFrame, smallest: bool) -> DataFrame:
    """Each distinct text of a hash: hash, text, keep_id, group_size, text_sha256."""
    pick = F.min if smallest else F.max
    # A null id counts as the smallest: it is what stays only where the smallest does, or no other is.
    keep = F.when(F.max(F.col("doc_id").isNull()), F.lit(None)).otherwise(F.min("doc_id")) if smallest else pick("doc_id")
    grouped = rows.groupBy("hash", "text").agg(keep.alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return grouped.withColumn("text_sha256", F.sha2("text", 256))


def exact_duplicates(docs: DataFrame, *, smallest: bool = False, hashed: Callable[[Column], Column] = content_hash) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row of docs (doc_id, text)."""
    rows = texts(docs).withColumn("hash", hashed(F.col("text")))
    of_hash = _groups(rows, smallest).groupBy("hash").agg(
        F.count(F.lit(1)).alias("texts"),
        *[F.first(c).alias(c) for c in ("keep_id", "group_size", "text_sha256")],
    )
    of_hash = written(of_hash, "content-hashes")
    alone = of_hash.filter("texts = 1").drop("texts")

    counted = rows.groupBy("hash", "doc_id").agg(F.count(F.lit(1)).alias("copies"))
    stretch = F.floor(F.col("doc_id") / CELL)
    cells = counted.groupBy("hash", stretch.alias("stretch")).agg(F.collect_list(F.struct("doc_id", "copies")).alias("ids"))
    found = cells.join(alone, "hash").select("keep_id", "group_size", "text_sha256", F.inline("ids"))

    collided = of_hash.filter("texts > 1").select("hash")
    if not collided.isEmpty():
        apart = rows.join(collided, "hash", "left_semi")
        own = apart.groupBy("hash", "text", "doc_id").agg(F.count(F.lit(1)).alias("copies"))
        found = found.unionByName(
            own.join(_groups(apart, smallest), ["hash", "text"]).select("keep_id", "group_size", "text_sha256", "doc_id", "copies")
        )
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"),
        "text_sha256",
    ).select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256"
    )


def op12_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


ORACLE = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
