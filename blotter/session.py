"""Session helpers.

Library code never creates or reconfigures a session: every operator takes the
caller's DataFrames. The helpers here are for tests, the bench and scripts, and
for reading the one setting the library needs (the shared checkpoint folder).
"""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "blotter") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on).

    The checkpoint folder is set only when the caller's environment has none,
    mirroring how a cluster would hand one in through ``spark.checkpoint.dir``.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # No broadcast from plan estimates; AQE may still broadcast a side whose
        # *measured* shuffle output is small. Library joins carry proof-based hints.
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a local one only for local masters.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/object store)
    folder and is used as is; a cluster session without it is an error, since
    a machine-local folder would not survive the loss of an executor. Only a
    local-mode session without the setting (a test run) gets a fresh folder
    under /tmp.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder (HDFS, object store) for this cluster")
        configured = tempfile.mkdtemp(prefix="blotter-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage by a reliable checkpoint into the session's checkpoint folder.

    Used for small intermediate tables that are both size-checked and reused
    (candidate tables, restricted dimension keys), so a lost executor does not
    force recomputing the loop that built them.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize_counted(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """``materialize`` that also returns the row count (``rows``) and ``metrics``, gathered by the same job.

    The metrics ride along the checkpoint job (``DataFrame.observe``), so no
    second pass reads the result. A retried task can only add to a count,
    never drop from it, so ``rows`` is safe as an upper bound for a size proof.
    """
    obs = Observation()
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()])
    out = materialize(observed)
    return out, dict(obs.get)
