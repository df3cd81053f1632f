"""The result of a (parameterised) SQL query as a DataFrame.

Bind parameters go through Spark's named parameter markers (never string
formatting); DataFrames referenced by the text are passed by name. External
databases are read with the JDBC source (``query`` option), which pushes the
query to the database.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def param_query(spark: SparkSession, sql: str, params: dict | None = None, **frames: DataFrame) -> DataFrame:
    return spark.sql(sql, args=params or None, **frames)


def jdbc_options(
    url: str, query: str, partition_column: str | None = None, lower=None, upper=None, partitions: int = 1, fetch_rows: int = 10_000
) -> dict[str, str]:
    """Options of the JDBC source. With a partition column and its bounds the
    query is read in ``partitions`` ranges at once; rows beyond the bounds
    are part of the outer ranges, none is left out."""
    out = {"url": url, "fetchsize": str(fetch_rows)}
    if partition_column is None:
        return out | {"query": query}
    if lower is None or upper is None or partitions < 1:
        raise ValueError("a partition column needs its lower and upper bound and a number of partitions")
    return out | {
        "dbtable": f"({query}) q", "partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def jdbc_query(spark: SparkSession, url: str, query: str, properties: dict | None = None, **partitioning) -> DataFrame:
    reader = spark.read.format("jdbc").options(**jdbc_options(url, query, **partitioning))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()
