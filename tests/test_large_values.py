"""Queries on tables whose values, not whose rows, are those of large inputs."""

from pyspark.sql import functions as F

from kickledger.plans import catalog
from tests.conftest import SF_SMOKE


def _tables(spark, folder, **frames):
    for name, df in frames.items():
        df.write.parquet(f"{folder}/{name}.parquet")


def test_scaled_counts_pass_32_bits(spark, scratch):
    """5,000 valuations of one league and month, times 500,000, are 2.5e9."""
    lines = spark.read.parquet(f"{SF_SMOKE}/lineitem.parquet").limit(5000)
    lines = lines.withColumn("l_suppkey", F.lit(1).cast("bigint")).withColumn("l_shipdate", F.expr("TIMESTAMP_NTZ '1998-03-05 00:00:00'"))
    clubs = spark.createDataFrame([(1, "club", 7, 0.0)], "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double")
    _tables(spark, scratch, lineitem=lines, supplier=clubs)
    row = catalog.QUERIES["humanize_scaled"](spark, scratch).collect()
    assert [(r.domestic_competition_id, r.partition_date, r.count_millions) for r in row] == [("7", "1998-03-01", "2500M")]
