"""What the text operators share: written tables, and columns that results replace."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievemark.operators.graph import shared_folder as checkpoint_folder
from sievemark.operators.graph import written as checkpointed

__all__ = ["checkpoint_folder", "checkpointed", "dropped", "shuffle_partitions", "without"]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def without(df: DataFrame, added: list[str]) -> DataFrame:
    """df without columns named as those an operator adds: what it adds replaces them."""
    taken = {x.lower() for x in added}
    return df.select(*(df[f"`{c}`"] for c in df.columns if c.lower() not in taken))


def dropped(table: DataFrame) -> None:
    """Deletes a table that checkpointed has written, once nothing reads it any more."""
    spark = table.sparkSession
    for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
