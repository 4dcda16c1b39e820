"""Session used by tests, the bench and the command line; a cluster brings its own."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable in the executors' Python, once per application.

    Nothing happens where PYTHONPATH already leads to it; else Spark's file server hands out a zip of it.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    app = spark.sparkContext.applicationId
    on_path = {os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    if app not in _SHIPPED and root not in on_path:
        base = os.path.join(tempfile.mkdtemp(prefix="linkspan-"), "linkspan")
        spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", root, "linkspan"))
    _SHIPPED.add(app)
    return spark


def local_session(cpus: str = "8", name: str = "linkspan", memory: str = "8g", spill_dir: str | None = None) -> SparkSession:
    """A session on this machine; shuffles and spills go to spill_dir if it is given."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    return (builder.config("spark.local.dir", spill_dir) if spill_dir else builder).getOrCreate()
