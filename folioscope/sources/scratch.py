"""Results that several later steps read, written once.

They go to the shared folder that ``spark.checkpoint.dir`` names; only a local master
may do without one. They are removed when the application ends.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_roots: dict[str, str] = {}


def _root(spark: SparkSession) -> str:
    context = spark.sparkContext
    if context.applicationId not in _roots:
        base = context.getConf().get("spark.checkpoint.dir")
        if not base and context._jsc.sc().getCheckpointDir().isDefined():
            base = context._jsc.sc().getCheckpointDir().get()
        if not base:
            if not context.master.startswith("local["):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            base = tempfile.mkdtemp(prefix="folioscope-")
            atexit.register(shutil.rmtree, base, True)
        _roots[context.applicationId] = f"{base.rstrip('/')}/folioscope-{context.applicationId}"
        atexit.register(_remove, spark, _roots[context.applicationId])
    return _roots[context.applicationId]


def _remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df``, written and read back."""
    path = f"{_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
