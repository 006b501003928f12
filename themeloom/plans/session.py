"""Session helpers: table access, materialisation in shared storage."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark so that any Hadoop path works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workers_find_package(spark: SparkSession) -> None:
    """Let Python workers import this package where the driver has it, whatever folder they start in."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    held = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in held:
        env["PYTHONPATH"] = os.pathsep.join([root, *held])


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where none is set: a temporary one in local mode, else one in the warehouse, which
    driver and executors share."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if held.isDefined():
            return held.get()
        one_machine = re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master)
        at = tempfile.mkdtemp(prefix="spark-themeloom-") if one_machine else f"{spark.conf.get('spark.sql.warehouse.dir')}/_themeloom"
        spark.sparkContext.setCheckpointDir(at)
        at = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return at.rstrip("/")


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder, which release() deletes."""
    path = f"{shared_dir(spark)}/themeloom-{os.getpid()}-{uuid.uuid4().hex}"
    _WRITTEN.append((spark, path))
    return path


def materialise(df: DataFrame) -> DataFrame:
    """Write df once to the shared folder and read it back: lineage is cut, lost executors lose nothing."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(df: DataFrame, since: int) -> DataFrame:
    """materialise(df), and then delete what was written between `since`, a value of written(), and df."""
    out = materialise(df)
    kept = _WRITTEN.pop()
    release(since)
    _WRITTEN.append(kept)
    return out


def written() -> int:
    """How many tables materialise() has written that are still there."""
    return len(_WRITTEN)


def release(since: int = 0) -> None:
    """Delete the tables that materialise() wrote after the first `since`; results that read them must be stored before."""
    while len(_WRITTEN) > since:
        spark, path = _WRITTEN.pop()
        try:
            jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)
        except Exception:  # the session is gone; nothing is left to delete it with
            return


atexit.register(release)
