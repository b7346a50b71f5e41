"""Source configuration: which databases of which servers belong to which tenant."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

_TEXT = T.StringType()
CONFIG_SCHEMA = T.StructType([
    T.StructField("servers", T.ArrayType(T.StructType([
        T.StructField("serverName", _TEXT),
        T.StructField("tenantName", _TEXT),
        T.StructField("databases", T.ArrayType(_TEXT)),
        T.StructField("useWindowsAuth", T.BooleanType()),
        T.StructField("comment", _TEXT),
    ]))),
    T.StructField("configuration", T.StructType([
        T.StructField("retentionDays", T.IntegerType()),
        T.StructField("bulkCopyTimeout", T.IntegerType()),
        T.StructField("queryTimeout", T.IntegerType()),
        T.StructField("logPath", _TEXT),
        T.StructField("stagingPath", _TEXT),
    ])),
])


def work_items(config: DataFrame) -> DataFrame:
    """One row per (server, database) to extract."""
    server = config.select(F.explode("servers").alias("s"))
    return server.select(
        F.col("s.tenantName").alias("TenantName"),
        F.col("s.serverName").alias("ServerName"),
        F.explode("s.databases").alias("DatabaseName"),
        F.col("s.useWindowsAuth").alias("UseIntegratedAuth"),
    )


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """Read the JSON file. Credentials are not part of the schema, so they are dropped."""
    return spark.read.schema(CONFIG_SCHEMA).json(path, multiLine=True)


def settings(config: DataFrame) -> DataFrame:
    return config.select("configuration.*")
