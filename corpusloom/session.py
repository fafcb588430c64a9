"""Session settings shared by tests, the benchmark and the command line."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A local session with the settings every plan here assumes: UTC, AQE and Arrow on."""
    os.environ.setdefault("PYSPARK_SUBMIT_ARGS", f"--driver-memory {memory} pyspark-shell")
    builder = SparkSession.builder.master(f"local[{cores}]").appName("corpusloom")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each Spark context, so that their Python workers can import it."""
    sc = spark.sparkContext
    root = Path(__file__).resolve().parent
    if getattr(sc, "_corpusloom_shipped", False) or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="corpusloom-")) / "corpusloom.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, f"corpusloom/{path.relative_to(root)}")
    sc.addPyFile(str(archive))
    sc._corpusloom_shipped = True
