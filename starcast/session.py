"""Session construction and shared-storage helpers.

On a cluster the session is built by the job launcher; the library only
reads its settings. ``build_session`` is for local runs (tests, bench).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC for date arithmetic, AQE for runtime
# broadcast / partition coalescing / skew-join splitting.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "starcast", extra: dict | None = None) -> SparkSession:
    """Local session for tests and benchmarks (UI off, UTC, AQE on, half of
    the machine's memory)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app_name)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    conf["spark.driver.memory"] = f"{max(1, os.sysconf('SC_PAGE_SIZE') * os.sysconf('SC_PHYS_PAGES') // 2 ** 31)}g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled"):
        spark.conf.set(k, conf[k])
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).
    Only a local-mode session without one gets a fresh folder under the
    system temp dir; a cluster session without one is a configuration
    error, because executor-local folders do not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - conf absent
            configured = None
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) "
                           "before running starcast jobs on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="starcast-ckpt-"))
    return sc.getCheckpointDir()


def ship_by_value(module_name: str) -> None:
    """Serialize the named module's functions and classes by value when
    they are sent to Python workers (``mapInPandas`` bodies, broadcast
    models), so executors need no installed copy of ``starcast``."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
