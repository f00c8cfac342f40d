"""Session helpers for tests, the bench and local runs.

Library code never builds a session; it takes the caller's. The only shared
location it uses is the folder named by ``spark.checkpoint.dir``, read from
the session (``sources.store.ensure_shared_dir``). ``local_session`` sets one in a fresh
temporary folder only when the setting is absent, as in tests.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app: str = "ticketlens",
    driver_memory: str = "8g",
) -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not (spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()):
        # Only where the setting is absent, as in tests: a fresh local folder.
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp")))
    return spark
