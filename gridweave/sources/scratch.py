"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """A folder of this application's own in ``spark.checkpoint.dir``. It goes when Python ends.

    Where that is unset, a temporary folder will do for a local master; a cluster's executors could not reach it, so there this raises.
    """
    app = spark.sparkContext.applicationId
    if app not in _roots:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            base = tempfile.mkdtemp(prefix="gridweave-")
            spark.sparkContext.setCheckpointDir(base)
        _roots[app] = f"{base.rstrip('/')}/gridweave-{uuid.uuid4().hex}"
        atexit.register(_delete, spark, _roots[app])
    return _roots[app]


def _delete(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's own file systems; where the session is gone already, the folder's owner has to."""
    try:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the JVM may end before the interpreter does
        return


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again: cuts its lineage and survives lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
