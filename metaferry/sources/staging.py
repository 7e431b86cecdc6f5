"""Intermediate tables that several results are computed from."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def staging_folder(spark: SparkSession) -> str:
    """The cluster's shared folder. Where none is set a local session gets its own, and a cluster an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="metaferry-")


def staged(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a DataFrame as Parquet and return the written table. Runs a job."""
    path = f"{folder or staging_folder(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
