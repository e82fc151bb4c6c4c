"""Session construction and lineage management."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_CKPT: dict[str, str] = {}
_SHIPPED: set[str] = set()


def get_spark(app: str = "quarry", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    ANSI mode stays on (Spark 4 default): every text→number coercion in
    the library goes through ``try_cast``. AQE is enabled so shuffle
    partition counts coalesce at runtime and skewed joins split.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and persisted artefacts.

    Read from ``spark.checkpoint.dir`` (set by the cluster). Only a
    local-mode session without that setting (tests) gets a private
    folder under the system temp dir; a cluster session without it is
    an error, because a machine-local folder is not visible to all
    executors.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        key = sc.applicationId
        if key not in _LOCAL_CKPT:
            _LOCAL_CKPT[key] = tempfile.mkdtemp(prefix="quarry-ckpt-")
        d = _LOCAL_CKPT[key]
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """`df` as written under the shared folder, compressed and by columns, and where: smaller than
    a checkpoint, and gone with ``discard``."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete stored tables. Files of shuffles and checkpoints that no DataFrame needs any more go
    as well: Spark removes them once the driver's garbage is collected, which else may take long."""
    sc = spark.sparkContext
    for p in paths:
        path = sc._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    sc._jvm.System.gc()


def ship_package(spark: SparkSession) -> None:
    """Make ``quarry`` importable in Python workers (Arrow UDF tasks).

    Zips the package on the driver and registers it with ``addPyFile``,
    Spark's own distribution path (what ``--py-files`` does); executors
    fetch it from the driver. Idempotent per application."""
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import quarry
    pkg = os.path.dirname(os.path.abspath(quarry.__file__))
    root = os.path.dirname(pkg)
    path = os.path.join(tempfile.mkdtemp(prefix="quarry-pyfiles-"), "quarry.zip")
    with zipfile.ZipFile(path, "w") as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(key)
