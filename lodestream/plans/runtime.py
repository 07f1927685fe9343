"""What every operator needs from the running session: where shared files go, how workers find
this package, and how a lineage is cut so that a lost executor costs one stage, not the query."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_ROOT = os.path.dirname(_PACKAGE)


def _is_local(spark: SparkSession) -> bool:
    return re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master) is not None


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package: from the driver's path in one process, else from an archive
    that Spark gives to every executor."""
    sc = spark.sparkContext
    env = sc.environment
    have = env.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in have:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, have)])
        if not _is_local(spark):
            sc.addPyFile(_archive())
    return spark


def _archive() -> str:
    """The package as an archive on the driver; Spark copies it from there."""
    name = os.path.basename(_PACKAGE)
    path = os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), f"{name}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(_PACKAGE):
            for f in files:
                if f.endswith(".py"):
                    z.write(os.path.join(folder, f), os.path.relpath(os.path.join(folder, f), _ROOT))
    return path


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session. A folder of
    this machine is made only in local mode, where there is one machine; a cluster without the setting is an error."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not _is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="lodestream-")
        sc.setCheckpointDir(named)
    return named.rstrip("/")


_made: set[str] = set()


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and return the table: the plan is computed once
    and everything after it restarts from the files. The tables are deleted when the driver ends, at the latest."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_remove_all, spark)
    _made.add(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file in any file system that the session knows."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def forget(df: DataFrame) -> None:
    """Delete a table made by :func:`cut` that no later plan reads."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove(df.sparkSession, path)
        _made.discard(next((m for m in _made if m.rsplit("/", 1)[-1] == path.rsplit("/", 1)[-1]), path))


def _remove_all(spark: SparkSession) -> None:
    """The tables that are left, when the driver ends."""
    try:
        for path in sorted(_made):
            remove(spark, path)
    except Exception:  # noqa: BLE001  # the JVM is gone
        pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
