"""The folder that the driver and all executors see, and tables staged in it."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark's own removal of a query's shuffle files when it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Rows carry whole texts: batches of this many keep the buffers of a task small.
_BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 2000


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session.

    Where it is unset, a local session (one machine, as in tests) gets a folder
    of its own; a cluster is refused, as its executors share no local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = os.path.join(tempfile.gettempdir(), "orthoscape-checkpoints")
    return base.rstrip("/")


class Stage:
    """A folder of staged tables belonging to one run of one operator, deleted when the driver ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        atexit.register(self._remove)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write df as Parquet, with its shuffle files gone afterwards, and read it back with its schema given."""
        path = f"{self.root}/{name}"
        own = {_CLEANUP: "true", _BATCH: str(min(BATCH_ROWS, int(self.spark.conf.get(_BATCH, "10000")) or BATCH_ROWS))}
        before = {k: self.spark.conf.get(k, None) for k in own}
        for k, v in own.items():
            self.spark.conf.set(k, v)
        try:
            df.write.parquet(path)
        finally:
            for k, v in before.items():
                self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete staged tables that nothing reads any more."""
        for name in names:
            self._delete(f"{self.root}/{name}")

    def _delete(self, path: str) -> None:
        at = self.jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.conf).delete(at, True)

    def _remove(self) -> None:
        try:
            self._delete(self.root)
        except Exception:  # the session's JVM has ended already  # noqa: BLE001, S110
            pass
