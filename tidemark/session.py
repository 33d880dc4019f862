"""Session construction and the few cluster settings the operators depend on."""

from __future__ import annotations

import os
import re
import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (DEFAULTS | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``; a folder of our own is set only where that is
    unset and all tasks run in this process, as in tests. On a cluster without the setting this raises, as executors
    couldn't read what others wrote to a folder of their own machine.
    """
    jsc = spark.sparkContext._jsc.sc()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not jsc.getCheckpointDir().isDefined():
        if not named and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidemark-ckpt-"))
    return jsc.getCheckpointDir().get()


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """``checkpoint()`` into the shared folder, so that a lost executor costs no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager)


def spread(df: DataFrame) -> DataFrame:
    """``df`` in at least as many partitions as there are cores, for work that is heavy per row. Inputs of several splits a
    core, as all large ones are, stay as they are; a small file in one split is dealt out."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def session_params(prefix: str = "TIDEMARK_", required: tuple[str, ...] = (), env: dict[str, str] | None = None) -> dict[str, str]:
    """Settings from environment variables: ``PREFIX`` + ``SPARK__SQL__ANSI__ENABLED`` gives ``spark.sql.ansi.enabled``. The names
    in ``required`` must be there."""
    env = dict(os.environ) if env is None else env
    found = {k[len(prefix) :].lower(): v for k, v in env.items() if k.startswith(prefix) and v}
    absent = [r for r in required if not found.get(r.lower())]
    if absent:
        raise OSError("not set: " + ", ".join(prefix + r.upper() for r in absent))
    return found


@contextmanager
def managed_session(app: str = "tidemark", master: str | None = None, **conf: str):
    """A session for a block, stopped at its end unless it was there before."""
    before = SparkSession.getActiveSession()
    spark = build_session(app, master, **conf)
    try:
        yield spark
    finally:
        if before is None:
            spark.stop()


def health_check(spark: SparkSession) -> bool:
    """``SELECT 1`` answers."""
    try:
        return spark.sql("SELECT 1").first()[0] == 1
    except Exception:
        return False
