"""Session settings for local runs. On a cluster the caller's session is used as it is."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shipped: set[str] = set()


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", checkpoint_dir: str | None = None
) -> SparkSession:
    """A session of one machine; intermediate tables go below ``checkpoint_dir``, else below the warehouse."""
    builder = SparkSession.builder
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    spark = (
        builder.master(f"local[{cores}]")
        .appName("isochron")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Put this repository's Python code on every worker, once per application.

    Passes in Python refer to it by module name, which a worker resolves only if it has the modules. The zip is made on
    the driver and handed out by Spark's own file server.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="isochron-"), "isochron-code.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for top in ("isochron", "catalog"):
            for folder, _, names in os.walk(os.path.join(ROOT, top)):
                for name in (n for n in names if n.endswith(".py")):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, ROOT))
    context.addPyFile(path)
    _shipped.add(context.applicationId)
