"""Where streams keep their checkpoints and carried state."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the session's ``spark.checkpoint.dir``. A local session without that
    setting gets a temporary folder; a cluster without it is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="opsignals-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


class CarriedState:
    """A small table per micro-batch: what the next one starts from.

    The state after batch ``n`` is written as ``<path>/batch=n``; batch ``n`` reads ``n - 1``.
    A batch that is run again after a failure reads the same input state and overwrites its own
    output, so replays give the same rows.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def before(self, batch_id: int) -> DataFrame:
        if batch_id == 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/batch={batch_id - 1}")

    def save(self, batch_id: int, state: DataFrame) -> None:
        state.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")


class GrowingState(CarriedState):
    """One row per key whose values only grow. A batch writes the keys it touched, every ``whole``-th
    one all of them, so what is written follows the batch and what is read stays a few folders."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], whole: int = 16):
        super().__init__(spark, path, schema)
        self.keys, self.whole = keys, whole

    def _largest(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*[F.max(c).alias(c) for c in rows.columns if c not in self.keys])

    def before(self, batch_id: int) -> DataFrame:
        if batch_id == 0:
            return self.spark.createDataFrame([], self.schema)
        first = (batch_id - 1) // self.whole * self.whole
        folders = [f"{self.path}/batch={n}" for n in range(first, batch_id)]
        return self._largest(self.spark.read.schema(self.schema).parquet(*folders))

    def save(self, batch_id: int, state: DataFrame) -> None:
        if batch_id % self.whole == 0:
            state = self._largest(state.unionByName(self.before(batch_id)))
        super().save(batch_id, state)
