"""Cutting lineage in the shared checkpoint folder, and running sums that no single task has to make."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def cut(df: DataFrame) -> DataFrame:
    """Materialise `df` in the folder of spark.checkpoint.dir. Where none is set a local session makes one; a cluster's
    executors could not read each other's, so there it is an error."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", "")
        if not folder and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="corpusloom-"))
    return df.checkpoint(eager=True)


def sums_before(rows: DataFrame, group: str, order: list[str], value: Column, name: str) -> DataFrame:
    """`rows`, narrow ones, with the sum of `value` over the rows before each in its group, by `order`.

    Rows are dealt to partitions by range, so that a large group lies in several; sums are made within a partition and
    raised by those of the partitions before.
    """
    dealt = cut(rows.withColumn("__value", value).repartitionByRange(F.col(group), *order).withColumn("__part", F.spark_partition_id()))
    ahead = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy(F.col(group).alias("__group"), F.col("__part").alias("__p")).agg(F.sum("__value").alias("__sum"))
    parts = parts.withColumn("__before", F.coalesce(F.sum("__sum").over(ahead(Window.partitionBy("__group").orderBy("__p"))), F.lit(0))).drop("__sum")
    within = F.coalesce(F.sum("__value").over(ahead(Window.partitionBy(group, "__part").orderBy(*order))), F.lit(0))
    met = dealt.withColumn("__within", within).join(parts, F.col(group).eqNullSafe(F.col("__group")) & (F.col("__part") == F.col("__p")))
    return met.withColumn(name, F.col("__before") + F.col("__within")).select(*rows.columns, name)
