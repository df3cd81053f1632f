"""Table writes: K1-K8 (+ O2).

Writes go through the session catalog or to paths in shared storage. A full
refresh never truncates a table in place: the new content is written to a
version folder of its own, and the table's location is then changed to it, in
one catalog change. Readers see the old content or the new, never an empty,
half-loaded or missing table, and a retried job does not duplicate rows (C14).
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..functions.sqlexpr import lit
from ..session import materialize_shared, remove_paths

#: folder of a table's versions, beside the database's tables
VERSIONS = "__versions"
#: name that holds a new definition while the table gets it
NEXT = "__next"


def table_exists(spark: SparkSession, name: str) -> bool:
    """O2: existence probe through the catalog (no LIMIT query)."""
    return spark.catalog.tableExists(name)


def _place(spark: SparkSession, name: str) -> str:
    """Where the database would keep a managed table of this name."""
    db, _, table = name.rpartition(".")
    root = spark.catalog.getDatabase(db or spark.catalog.currentDatabase()).locationUri
    return f"{root.rstrip('/')}/{table}"


def location(spark: SparkSession, name: str) -> str:
    return next(r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r.col_name == "Location")


def _shape(df: DataFrame) -> list[tuple[str, str]]:
    return [(n, t) for n, t in df.dtypes]


def _create(spark: SparkSession, name: str, ddl: str, path: str, partition_by=(), bucket_by=None) -> None:
    by = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    if bucket_by:
        by += f" CLUSTERED BY ({bucket_by[1]}) SORTED BY ({bucket_by[1]}) INTO {bucket_by[0]} BUCKETS"
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet {by} LOCATION {lit(path)}")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def _write_version(df: DataFrame, name: str, path: str, partition_by, bucket_by) -> None:
    """The rows as Parquet at ``path``; buckets need a table to be written by,
    which is dropped again (its files stay). The rows are dealt by bucket first:
    one file a bucket, not one for each bucket and task."""
    if not bucket_by:
        df.write.partitionBy(*partition_by).parquet(path)
        return
    n, key = bucket_by
    load = f"{name}__load_{uuid.uuid4().hex[:8]}"
    df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(load)
    df.sparkSession.sql(f"DROP TABLE {load}")


def full_refresh(df: DataFrame, name: str, partition_by=(), expect: int | None = None, bucket_by: tuple[int, str] | None = None) -> None:
    """K1: replace a table's content by one change of its location.

    With ``expect`` the written rows are counted first; another number stops
    the refresh and leaves the table as it was. The version before stays for
    running readers, older ones are deleted. A table of other columns or with
    partitions gets a new definition instead: it is kept under ``NEXT`` while
    the old one is dropped, and ``recover`` finishes such a change.
    ``bucket_by``: number of buckets and the column they are made by."""
    spark = df.sparkSession
    recover(spark, name)
    root = _place(spark, name) + VERSIONS
    path = f"{root}/{time.time_ns()}-{uuid.uuid4().hex[:8]}"
    _write_version(df, name, path, partition_by, bucket_by)
    if expect is not None and (found := spark.read.schema(df.schema).parquet(path).count()) != expect:
        remove_paths(spark, [path])
        raise ValueError(f"{name}: {found} rows out of {expect} records")
    ddl = df._jdf.schema().toDDL()
    keep = {path}
    if not table_exists(spark, name):
        _create(spark, name, ddl, path, partition_by, bucket_by)
    elif _buckets(spark, name) == bucket_by and not partition_by and _shape(spark.table(name)) == _shape(df) and not _partitions(spark, name):
        keep.add(location(spark, name))
        spark.sql(f"ALTER TABLE {name} SET LOCATION {lit(path)}")
        spark.catalog.refreshTable(name)
    else:
        keep.add(location(spark, name))
        _create(spark, name + NEXT, ddl, path, partition_by, bucket_by)
        spark.sql(f"DROP TABLE {name}")
        _create(spark, name, ddl, path, partition_by, bucket_by)
        spark.sql(f"DROP TABLE {name + NEXT}")
    clean_versions(spark, name, keep)


def _partitions(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _buckets(spark: SparkSession, name: str) -> tuple[int, str] | None:
    found = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if found.get("Num Buckets", "0") in ("0", "-1"):
        return None
    return int(found["Num Buckets"]), found["Bucket Columns"].strip("[]`")


def recover(spark: SparkSession, name: str) -> None:
    """Finish a change of definition that broke off: what stands under
    ``NEXT`` is complete, so a missing table is created from it."""
    if not table_exists(spark, name + NEXT):
        return
    if not table_exists(spark, name):
        ddl = spark.table(name + NEXT)._jdf.schema().toDDL()
        _create(spark, name, ddl, location(spark, name + NEXT), _partitions(spark, name + NEXT), _buckets(spark, name + NEXT))
    spark.sql(f"DROP TABLE {name + NEXT}")


def clean_versions(spark: SparkSession, name: str, keep) -> None:
    """Delete the table's folders but ``keep`` (paths)."""
    place = _place(spark, name)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(place).getFileSystem(spark._jsc.hadoopConfiguration())
    plain = lambda p: path(p).toUri().getPath().rstrip("/")
    kept = {plain(k) for k in keep}
    found = [s.getPath().toString() for s in fs.globStatus(path(f"{place}{VERSIONS}/*")) or []]
    remove_paths(spark, [p for p in [*found, place] if plain(p) not in kept])


def drop_table(spark: SparkSession, name: str) -> None:
    """The table and all its versions."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    clean_versions(spark, name, ())


def replace_partitions(df: DataFrame, name: str, part: str, values) -> None:
    """The partitions ``values`` (text) of ``name`` become the rows of ``df``;
    all others stay untouched. The rows are written to the shared checkpoint
    folder first, so they may come from the table itself."""
    spark, values = df.sparkSession, set(values)
    if not table_exists(spark, name):
        df.write.partitionBy(part).saveAsTable(name)
        return
    made: list[str] = []
    staged = materialize_shared(df.select(*spark.table(name).columns), "partitions", made)
    # a session of its own: the mode must not change under another thread's write
    own = spark.newSession()
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    own.read.schema(staged.schema).parquet(made[0]).write.insertInto(name, overwrite=True)
    written = {r[0] for r in staged.select(part).distinct().collect()}  # as many as partitions, not rows
    for value in values - written:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({part} = {lit(value)})")
    spark.catalog.refreshTable(name)
    remove_paths(spark, made)


def append(df: DataFrame, name: str) -> None:
    """K2: append-only load (creates the table on first write)."""
    df.write.mode("append").saveAsTable(name)


def materialize(df: DataFrame, name: str, truncate: bool = True) -> None:
    """K3 + K4: create-as-select when absent, else positional insert
    (``insertInto`` matches columns by position, as INSERT ... SELECT does);
    ``truncate`` replaces the content and keeps the table's definition: values
    are cast to its column types as on any insert. The rows are written to the
    shared checkpoint folder first, so that they may come from the table."""
    spark = df.sparkSession
    if not table_exists(spark, name):
        df.write.saveAsTable(name)
    elif truncate:
        materialize_shared(df, "truncate-insert").write.insertInto(name, overwrite=True)
    else:
        df.write.insertInto(name, overwrite=False)


def write_header_detail(header: DataFrame, detail: DataFrame | None, header_table: str, detail_table: str,
                        truncate: bool = True, expect: int | None = None) -> None:
    """K5: one payload -> header table + detail table; ``expect`` header rows."""
    if truncate:
        full_refresh(header, header_table, expect=expect)
    else:
        append(header, header_table)
    if detail is not None and detail_table:
        (full_refresh if truncate else append)(detail, detail_table)


def append_json_log(df: DataFrame, path: str) -> None:
    """K6: append JSON lines under a shared path: one column of JSON objects
    as text is written as it is, other rows become one object each (nulls
    kept)."""
    if len(df.columns) == 1 and df.dtypes[0][1] == "string":
        df.write.mode("append").text(path)
    else:
        df.write.mode("append").option("ignoreNullFields", False).json(path)


def write_bundle(frames: dict[str, DataFrame], root: str, as_of) -> dict[str, str]:
    """K7: the named result sets of one run under a dated folder."""
    out = {}
    for name, df in frames.items():
        path = f"{root}/as_of={as_of}/name={name}"
        df.write.mode("overwrite").parquet(path)
        out[name] = path
    return out


def analyze(spark: SparkSession, names) -> None:
    """K8: refresh table and column statistics before a heavy query (the
    cost-based optimizer and AQE's initial plan use them)."""
    for n in names:
        spark.sql(f"ANALYZE TABLE {n} COMPUTE STATISTICS FOR ALL COLUMNS")
