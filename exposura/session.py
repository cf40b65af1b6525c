"""Session settings shared by the library, the tests and the bench."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEMO_PEPPER = "demo-pepper"


def build_session(app: str = "exposura", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs assume; cluster settings win where given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pepper(spark: SparkSession, unset: str | None = None) -> str:
    """Secret prefix of the identifier hash, as spark.exposura.pepper names it.

    Where none is named it is `unset`; without that the demonstration's in a local session,
    and an error on a cluster. The registered queries run on supplied tables of invented
    people and their SQL names the demonstration's, so they give that.
    """
    named = spark.conf.get("spark.exposura.pepper", None) or unset
    if named is None and not _one_process(spark):
        raise RuntimeError("set spark.exposura.pepper")
    return named or DEMO_PEPPER


def _one_process(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    A machine-local folder is used only where driver and executors are one process
    and none is named; a folder named later takes over.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not _one_process(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    made = spark.conf.get("spark.exposura.localDir", None)
    if not made:
        made = tempfile.mkdtemp(prefix="exposura-")
        spark.conf.set("spark.exposura.localDir", made)
    return made


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/exposura/{label}-{uuid.uuid4().hex[:12]}"
