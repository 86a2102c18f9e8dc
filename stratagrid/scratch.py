"""Shared-folder tables that cut the lineage of iterative operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_local_dirs: dict[str, str] = {}
_shared: set[tuple[str, str]] = set()
_written: dict[str, list[str]] = {}

PROBE_FILES = 64  # files, each of a task of its own, that show whether a folder is shared


def scratch_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``, else a folder in its warehouse; a temporary one only for a local session.

    A ``file`` folder may be a mount that all machines share or each one's own disk.  Its name does not tell, so
    on a cluster a few rows are written there once and looked for.
    """
    context = spark.sparkContext
    app = context.applicationId
    configured = _configured(spark)
    if context.master == "local" or context.master.startswith("local["):
        if not configured and app not in _local_dirs:
            _local_dirs[app] = tempfile.mkdtemp(prefix="stratagrid-")
        return configured.rstrip("/") if configured else _local_dirs[app]
    folder = (configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/stratagrid-scratch").rstrip("/")
    if (app, folder) not in _shared:
        if _file_system(spark, folder) == "file" and not _is_shared(spark, folder):
            raise RuntimeError(f"{folder} lies on each machine's own disk; set spark.checkpoint.dir to a folder that all share")
        _shared.add((app, folder))
    return folder


def _is_shared(spark: SparkSession, folder: str) -> bool:
    """True when the driver finds there what every task has written."""
    path = f"{folder}/{uuid.uuid4().hex}"
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    try:
        spark.range(0, PROBE_FILES, 1, PROBE_FILES).write.parquet(path)
        files = target.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(target)
        return sum(f.getPath().getName().startswith("part-") for f in files) == PROBE_FILES
    finally:
        remove(spark, path)


def _configured(spark: SparkSession) -> str | None:
    """``spark.checkpoint.dir``, or the folder given to ``SparkContext.setCheckpointDir``."""
    folder = spark.sparkContext._jsc.sc().getCheckpointDir()
    return spark.conf.get("spark.checkpoint.dir", None) or (folder.get() if folder.isDefined() else None)


def _file_system(spark: SparkSession, path: str) -> str:
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()).getScheme()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in any file system that Spark reads."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def clean(spark: SparkSession) -> None:
    """Delete all tables that this session's queries have written; their DataFrames end here."""
    for path in _written.pop(spark.sparkContext.applicationId, []):
        remove(spark, path)


def note_written(spark: SparkSession, path: str) -> None:
    """Let ``clean`` delete a table that was written by other means."""
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)


def materialize(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back.

    The written table survives the loss of executors, ends the lineage and gives the next
    plan true size statistics, so that adaptive execution sees how large a side really is.
    """
    spark = df.sparkSession
    path = path or f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    note_written(spark, path)
    return spark.read.schema(df.schema).parquet(path)


class Rounds:
    """Keeps the newest table of each name in a loop and deletes the one it replaces."""

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._base = f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
        self._live: dict[str, str] = {}
        self._stale: list[str] = []
        self._n = 0
        self.seen = 0

    def put(self, name: str, df: DataFrame, watch: str = "true") -> DataFrame:
        """Write one round; ``seen`` is then the number of rows where ``watch`` is true.

        The number is observed while the table is written, so that a loop needs no second
        job to learn whether it is done.
        """
        self._n += 1
        path = f"{self._base}/{name}-{self._n}"
        observation = Observation()
        table = materialize(df.observe(observation, F.expr(f"count_if({watch})").alias("seen")), path)
        self.seen = observation.get["seen"]
        if name in self._live:
            self._stale.append(self._live[name])
        self._live[name] = path
        return table

    def keep(self, name: str) -> None:
        """Never delete the newest table of this name."""
        self._live.pop(name)

    def sweep(self) -> None:
        """Delete replaced tables; call when no later step reads them."""
        for path in self._stale:
            remove(self._spark, path)
        self._stale = []


TASK_BYTES = 64 << 20  # a left side of this size needs no salts: one task can hold all of it
HOT_KEYS = 10_000  # at most this many keys can be hot: a hot key has over a HOT_KEYS-th of the rows


def leaf_bytes(df: DataFrame) -> int:
    """Bytes of the tables that a plan reads, as far as Spark knows; no job runs."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def hot_keys(left: DataFrame, keys: list[str], task_bytes: int | None = None) -> DataFrame | None:
    """``(keys, _salts)`` for the keys that need more than one task, by their counted rows.

    None when the side is small.  At most ``HOT_KEYS`` rows, whatever the data.
    """
    size = leaf_bytes(left)
    if size <= (TASK_BYTES if task_bytes is None else task_bytes):
        return None
    rows = left.count()
    most = max(1, rows // HOT_KEYS)
    return materialize(
        left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most)
        .select(*keys, F.ceil(F.col("_n") / most).cast("int").alias("_salts"))
    )


def salted(left: DataFrame, right: DataFrame, keys: list[str], hot: DataFrame, salt_by: list[str],
           right_keys: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_salt`` / ``_copy``: left rows of a hot key are dealt out by a hash of their own
    ``salt_by`` columns (a retried task repeats it), right rows of a hot key are copied to each salt."""
    few = F.broadcast(hot)  # at most HOT_KEYS rows
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in salt_by])
    dealt = left.join(few, keys, "left").withColumn(
        "_salt", F.coalesce(F.pmod(hashed, F.col("_salts")), F.lit(0)).cast("int")).drop("_salts")
    named = right_keys or keys
    renamed = F.broadcast(hot.withColumnsRenamed(dict(zip(keys, named))))
    copies = right.join(renamed, named, "left").withColumn(
        "_copy", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return dealt, copies


def lookup(left: DataFrame, right: DataFrame, key: str, salt_by: str | list[str],
           how: str = "inner", task_bytes: int | None = None) -> DataFrame:
    """Join ``left`` to ``right`` on ``key``, which is unique in ``right`` but may be hot in ``left``.

    Only keys whose counted rows need it are salted, each as far as its rows need; without hot keys
    nothing is copied.
    """
    hot = hot_keys(left, [key], task_bytes)
    if hot is None:
        return left.join(right, key, how)
    dealt, copies = salted(left, right, [key], hot, [salt_by] if isinstance(salt_by, str) else salt_by)
    return dealt.join(copies.withColumnRenamed("_copy", "_salt"), [key, "_salt"], how).drop("_salt")
