"""Sessions, and shipping this package to Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def local_session(cores: int | str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """A local session in UTC with Arrow, AQE and few shuffle partitions."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tessera")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    return builder.config(map=settings | conf).getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Makes this package importable in the session's Python workers, wherever they run. Once per application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parent
        fd, name = tempfile.mkstemp(prefix="tessera-", suffix=".zip")
        os.close(fd)
        with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as out:
            for path in sorted(root.rglob("*.py")):
                out.write(path, path.relative_to(root.parent))
        spark.sparkContext.addPyFile(name)
        _shipped.add(app)
    return spark
