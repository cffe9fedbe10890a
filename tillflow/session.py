"""Session settings the jobs rely on. On a cluster the launcher's own settings win."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Applied only where the session or the launcher has not set them already.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split skewed joins also where a later step wants their partitioning and is shuffled once more for it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "tillflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above. ``conf`` keys use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is made only where the setting is absent, i.e. in local tests; the
    choice is stored back so that one session keeps using one folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    made = tempfile.mkdtemp(prefix="tillflow-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made
