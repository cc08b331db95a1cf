"""The session and the tables of the tests."""

from __future__ import annotations

from pyspark.sql import SparkSession

SF = "/root/testdata/sf0.01"


def session() -> SparkSession:
    spark = (SparkSession.builder.master("local[8]").appName("msglog")
             .config("spark.sql.shuffle.partitions", "4")
             .config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
