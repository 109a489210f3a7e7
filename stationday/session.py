"""Session helpers: a configured session, legacy text encodings, the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_JAVA_CHARSETS = "spark.sql.legacy.javaCharsets"
_CODING_ERRORS = "spark.sql.legacy.codingErrorAction"
_CHECKPOINT_DIR = "spark.checkpoint.dir"


def configured(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Settings the engine's plans are made for; cluster sizing stays with the caller."""
    return (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )


@contextmanager
def java_charsets(spark: SparkSession, strict: bool = True):
    """Allow Shift_JIS and Windows-31J while an expression is put into a plan.

    ``decode`` and ``encode`` keep the settings they were analysed under, so these are set
    back right away and the action may run later. Bytes that are no text of the charset are an error, or,
    without ``strict``, become the replacement character.
    """
    wanted = {_JAVA_CHARSETS: "true", _CODING_ERRORS: "false" if strict else "true"}
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared folder the cluster names in ``spark.checkpoint.dir``.

    Where the setting is absent a local session gets a temporary folder; a cluster session
    has to name a shared one, since executors cannot see each other's local disks.
    """
    context = spark.sparkContext
    root = spark.conf.get(_CHECKPOINT_DIR, None) or context.getConf().get(_CHECKPOINT_DIR)
    root = root or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError(f"{_CHECKPOINT_DIR} must name a shared folder on a cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="stationday-"))
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
