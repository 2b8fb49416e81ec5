"""Session settings and lineage cutting."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build(app: str = "shelfcast", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution; partition counts are left to AQE to coalesce or split."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names; without one, a cluster is an error.

    A local session, which has one process, then takes a folder in its warehouse.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/shelfcast-checkpoints"
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named


def scratch_dir(spark: SparkSession) -> str:
    """This application's own folder in the checkpoint folder; the session removes it when it ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/shelfcast-{spark.sparkContext.applicationId}"
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(place)
    store.deleteOnExit(place)
    return path


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the scratch folder and read it from there.

    Later readers outlive lost executors, read only the columns they need, and know the table's size
    when choosing joins.  This is an action: calling it starts jobs.  The table lasts as long as the
    application, since the frames that read it are lazy.
    """
    path = f"{scratch_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
