"""Session helpers: local session for tests/bench, checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tallyline", extra=None) -> SparkSession:
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def app_id(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        return spark.conf.get("spark.app.id", "app")


def folder_version(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and modification times of a folder's tables: changes when
    one of them is written anew."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/*.parquet")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in found))


def landed_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, size, modification time) of all files at ``path`` (a file, a
    folder or a pattern), hidden ones left out."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    out = []
    for top in fs.globStatus(hadoop) or []:
        files = fs.listFiles(top.getPath(), True)
        while files.hasNext():
            s = files.next()
            if not s.getPath().getName().startswith(("_", ".")):
                out.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return sorted(out)


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set one only when unset
    (local runs and tests), in a fresh scratch folder."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: configuration only
        sc = None
    current = (sc.getCheckpointDir() if sc else None) or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if sc is not None and not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir is not set: a cluster needs a folder that all executors share")
    path = fallback or tempfile.mkdtemp(prefix="tallyline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc is not None:
        sc.setCheckpointDir(path)
    else:
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def shared_stage_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for one materialised stage under the shared
    ``spark.checkpoint.dir`` (never a machine-local temp folder)."""
    import uuid

    root = ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/tallyline-stages/{app_id(spark)}/{name}-{uuid.uuid4().hex}"


def remove_paths(spark: SparkSession, paths) -> None:
    """Delete materialised stages; frames read from them are of no use then."""
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize_shared(df, name: str, made: list[str] | None = None):
    """Cut lineage: write the stage once as parquet in the shared checkpoint
    folder and read it back. Unlike ``checkpoint()`` (which runs the plan
    again to write it) the plan runs once; unlike a cache it survives
    executor loss; unlike ``localCheckpoint`` it is not executor-local. The
    path is added to ``made``, for whoever deletes it in the end."""
    spark = df.sparkSession
    path = shared_stage_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    if made is not None:
        made.append(path)
    return spark.read.parquet(path)

