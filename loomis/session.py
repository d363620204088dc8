"""Spark session construction and the shared checkpoint folder.

Everything in the library takes an existing ``SparkSession``; this module only
builds one for tests / bench and resolves where reliable checkpoints go.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this library relies on.  Adaptive execution re-plans
# joins (broadcast vs sort-merge) from runtime sizes, coalesces small shuffle
# partitions and splits skewed ones; UTC keeps timestamps identical to the
# DuckDB oracle.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Bound for automatic broadcast: only tables whose *measured* size is below
    # this are broadcast; anything larger falls back to a shuffled join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "loomis", extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    conf["spark.driver.memory"] = os.environ.get("LOOMIS_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared (HDFS/object store) folder and we
    only read it.  Only when it is unset -- local tests and bench -- do we create
    a fresh scratch folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path and spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not path:
        path = tempfile.mkdtemp(prefix="loomis-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", path)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return spark.conf.get("spark.checkpoint.dir", None) or path


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for written intermediate tables)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])


def ship_package(spark: SparkSession) -> None:
    """Make ``loomis`` importable in Python workers (pandas UDF / mapInPandas
    / applyInPandasWithState functions are pickled by module reference):
    zip the package once per SparkContext and hand it to ``addPyFile``, the
    programmatic form of ``spark-submit --py-files``.  Spark distributes the
    archive to every executor."""
    import zipfile

    import loomis

    sc = spark.sparkContext
    if getattr(sc, "_loomis_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(loomis.__file__)))
    fd, path = tempfile.mkstemp(prefix="loomis-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(os.path.join(root, "loomis")):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    sc._loomis_shipped = True
