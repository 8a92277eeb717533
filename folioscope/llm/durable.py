"""Tables that outlive an executor.

Every intermediate result that is read more than once is written as Parquet in
the shared folder that the cluster names in ``spark.checkpoint.dir``. A lost
executor then costs a re-read and never a recomputation or a failure.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; on a local master without one, a temporary folder."""
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or _own.get(context.applicationId)
    if not base:
        current = context._jsc.sc().getCheckpointDir()
        base = current.get() if current.isDefined() else None
    if not base:
        if not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = _own[context.applicationId] = tempfile.mkdtemp(prefix="folioscope-")
        atexit.register(shutil.rmtree, base, True)
        context.setCheckpointDir(base)
    return base.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is None:
        return
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def save(df: DataFrame, name: str, scratch: list[DataFrame] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return it read back; removed when the application ends.

    ``scratch`` collects tables that ``clear`` removes once their last reader is written.
    """
    spark = df.sparkSession
    root = f"{shared_dir(spark)}/folioscope-{spark.sparkContext.applicationId}"
    if root not in _own:
        _own[root] = root
        atexit.register(_remove, spark, root)
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._durable_path = path
    if scratch is not None:
        scratch.append(table)
    return table


def drop(table: DataFrame) -> None:
    """Remove a saved table that no later plan reads."""
    _remove(table.sparkSession, table._durable_path)


def clear(scratch: list[DataFrame]) -> None:
    for table in scratch:
        drop(table)
    scratch.clear()


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, so that very long texts do not fill a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
