"""Session settings, package shipping and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# AQE re-plans joins from measured sizes: it broadcasts a side only when its shuffle output is below the
# threshold and splits partitions that a hot key makes too large.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    "spark.sql.python.filterPushdown.enabled": "true",
}


def build_session(app_name: str = "pagemill", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings above; ``conf`` keys use ``__`` for the dot."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the settings on a session somebody else built and ship this package to its Python workers."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """``addPyFile`` of this package, once per application, so executors can import the archive reader.

    The zip is made on the driver; Spark copies it to the executors.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="pagemill-"), "pagemill.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)


_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only a local session may fall back to a temp folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="pagemill-shared-")
    return _LOCAL_FOLDERS[application]


def new_table_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one written table, below a folder per application that can be dropped when it is over."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def is_small(table: DataFrame, max_bytes: int = 32 << 20) -> bool:
    """Whether the measured size of a table is at most ``max_bytes``."""
    row_bytes = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in table.columns), F.lit(32))
    return table.agg(F.coalesce(F.sum(row_bytes), F.lit(0))).first()[0] <= max_bytes


def broadcast_if_small(table: DataFrame, max_bytes: int = 32 << 20) -> DataFrame:
    """Broadcast hint for a table whose measured size is at most ``max_bytes``; a larger one is joined by shuffle."""
    return F.broadcast(table) if is_small(table, max_bytes) else table


def lookup_join(rows: DataFrame, table: DataFrame, on: str, max_bytes: int = 32 << 20, salts: int = 16, common: Column | None = None) -> DataFrame:
    """Many ``rows`` with the one row of ``table`` for their ``on``; rows without one go.

    The table is what is broadcast, if it is small, never the rows. A larger table meets them by shuffle, each of its
    rows ``salts`` times, so that a common key is dealt over as many tasks. ``common``, over the key, says which keys may be
    common; the others meet their row as it is.
    """
    if is_small(table, max_bytes):
        return rows.join(F.broadcast(table), on)
    salt, common = "_salt", F.lit(True) if common is None else common
    salted = rows.withColumn(salt, F.when(common, F.floor(F.rand() * salts).cast("int")).otherwise(0))
    copies = table.withColumn(salt, F.explode(F.sequence(F.lit(0), F.when(common, salts - 1).otherwise(0))))
    return salted.hint("merge").join(copies, [on, salt]).drop(salt)


def written(table: DataFrame, label: str) -> DataFrame:
    """Write a DataFrame to the shared folder once and read it back, so later jobs do not compute it again."""
    spark = table.sparkSession
    path = new_table_path(spark, label)
    table.write.parquet(path)
    return spark.read.schema(table.schema).parquet(path)
