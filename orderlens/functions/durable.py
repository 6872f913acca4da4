"""Cutting lineage through the shared checkpoint folder."""

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark's switch for deleting the shuffle files of a query when the query ends.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _checkpoint_folder(df: DataFrame) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; a temporary one only in local mode."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="orderlens-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


@contextmanager
def _dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files behind a table are of no use once it is written, and go at once."""
    before = spark.conf.get(CLEAN_SHUFFLES, "false")
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_SHUFFLES, before)


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the session's checkpoint folder and go on from there.

    Used where later steps need the very same rows in the very same partitions, also after
    an executor is lost. The folder is the one the cluster names in ``spark.checkpoint.dir``.
    """
    _checkpoint_folder(df)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet under the checkpoint folder and read it from there.

    For narrow tables that several passes read: columns are compressed, the partitions are not kept.
    """
    folder = f"{_checkpoint_folder(df).rstrip('/')}/{uuid.uuid4()}"
    with _dropping_shuffles(df.sparkSession):
        df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def stored_by(df: DataFrame, key: str, within: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """As ``stored``, in as many buckets of ``key`` as shuffle partitions: one shuffle here, none for
    what groups or joins by ``key`` later. The rows of one key meet in one bucket.

    ``within`` makes what is stored from the dealt rows and keeps ``key``; its groups by ``key`` and
    other columns, such as the removal of copies, need no shuffle of their own.
    """
    spark, name = df.sparkSession, f"orderlens_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartition(buckets, key)
    writer = (within(dealt) if within else dealt).write.bucketBy(buckets, key).option("compression", "zstd")
    with _dropping_shuffles(spark):
        writer.option("path", f"{_checkpoint_folder(df).rstrip('/')}/{name}").saveAsTable(name)
    return spark.table(name)
