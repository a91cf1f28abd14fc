"""SparkSession profiles: what differs between a laptop, a test run and a cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings that every profile shares: UTC days, runtime re-planning, one thread per Python worker.
BASE = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.executorEnv.OMP_NUM_THREADS": "1",
}

PROFILES: dict[str, dict[str, str]] = {
    "test": {"spark.master": "local[*]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"},
    "local": {"spark.master": "local[*]"},
    # The cluster manager gives master and sizes; partitions start high and are coalesced at run time.
    "cluster": {"spark.sql.shuffle.partitions": "4000", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m", "spark.sql.files.maxPartitionBytes": "256m"},
}


def session(profile: str = "local", app: str = "terrafield", **settings: str) -> SparkSession:
    """A session of the profile; keyword settings (with ``__`` for dots) override it."""
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}; there are {sorted(PROFILES)}")
    conf = BASE | PROFILES[profile] | {k.replace("__", "."): v for k, v in settings.items()}
    return SparkSession.builder.appName(app).config(map=conf).getOrCreate()
