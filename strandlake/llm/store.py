"""Tables in the folder that driver and executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.scratch import materialise, shared_dir

__all__ = ["materialise", "materialise_by", "partitions", "shared_dir"]


def materialise_by(df: DataFrame, key: str, name: str = "table") -> DataFrame:
    """materialise(), with the rows in as many files by the hash of key as there are shuffle partitions: a join by key moves the other side alone."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    table = f"strandlake_{folder.rsplit('/', 1)[-1]}"
    df.write.format("parquet").bucketBy(partitions(spark), key).option("path", f"{folder}/{name}").saveAsTable(table)
    return spark.table(table)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
