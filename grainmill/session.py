"""What operators need of a session: the package on executors, and scratch tables in the shared folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
_SCRATCH: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="grainmill-code-")  # the driver's; addPyFile serves it to executors
    target = os.path.join(folder, "grainmill_src.zip")
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent).as_posix())
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def scratch_dir(spark: SparkSession) -> str:
    """A folder of this application inside ``spark.checkpoint.dir``.

    Only a local master may run without that setting: there the driver and the tasks share one
    disk and a temporary folder is set. On a cluster the setting is required.
    """
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            root = "file://" + tempfile.mkdtemp(prefix="grainmill-scratch-")
            if not spark.sparkContext.getCheckpointDir():
                spark.sparkContext.setCheckpointDir(root)
        _SCRATCH[app] = f"{root.rstrip('/')}/grainmill-{uuid.uuid4().hex}"
        atexit.register(_remove_at_exit, spark, _SCRATCH[app])
    return _SCRATCH[app]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any store that Spark knows."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    """Delete the scratch folder when the driver ends; a driver that has lost its JVM leaves it."""
    try:
        remove(spark, path)
    except Exception:  # noqa: BLE001  the session may be stopped already
        pass


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared scratch folder and read it back.

    A lost executor then costs a read of a shared file, not a new run of everything before.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
