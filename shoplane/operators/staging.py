"""Write an intermediate once and read it back (a lineage cut).

Used where one intermediate feeds several branches of a plan whose columns
Catalyst prunes differently per branch, so exchange reuse cannot apply and the
input would be scanned once per branch. The copy lives in the shared checkpoint
folder (``spark.checkpoint.dir``) and survives executor loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import scratch_path


def stage(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
