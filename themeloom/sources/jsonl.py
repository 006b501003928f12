"""JSON lines in and out, with explicit schemas."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read(spark: SparkSession, path: str, schema: str | StructType, missing_ok: bool = False) -> DataFrame:
    """One object for each line; a malformed line fails the job, blank lines are skipped.

    A missing path is an error, or no rows if missing_ok.
    """
    try:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    except AnalysisException as e:
        if missing_ok and e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def write(rows: DataFrame, path: str) -> None:
    """Overwrite; nulls are written, characters beyond ASCII stay."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_split(tagged: DataFrame, flag: str, kept: str, dropped: str) -> None:
    """Two sinks by a boolean column, from one evaluation of tagged."""
    held = tagged.persist()
    try:
        write(held.where(flag).drop(flag), kept)
        write(held.where(f"not coalesce({flag}, false)").drop(flag), dropped)
    finally:
        held.unpersist()
