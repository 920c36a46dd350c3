"""Session helper for tests, bench runs and notebooks.

On a cluster the caller's own session is used as it is; nothing in the library
needs a particular setting beyond Spark's defaults (adaptive execution on).
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(name: str = "lexiloom", cpus: int | str = "*", memory: str = "8g") -> SparkSession:
    """Local session with adaptive execution, UTC timestamps and small shuffles."""
    # Python workers import the package by name, whatever folder the session was started in.
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        os.environ["PYTHONPATH"] = os.pathsep.join([home, *paths])
    partitions = os.cpu_count() if cpus == "*" else int(cpus)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
