"""Input tables, and work tables in the folder that driver and executors share."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder name under ``spark.checkpoint.dir``; a temporary one only in local mode."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="orderlens-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4()}"


#: Spark's switch for deleting the shuffle files of a query when the query ends.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet into a shared folder and read it again: the lineage ends there.

    Shuffle files behind it are of no use any more and go at once.
    """
    spark, folder = df.sparkSession, shared_folder(df.sparkSession)
    before = spark.conf.get(CLEAN_SHUFFLES, "false")
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        df.write.option("compression", codec).parquet(folder)
    finally:
        spark.conf.set(CLEAN_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(folder)


def drop_stored(df: DataFrame) -> None:
    """Delete the folders of a frame made by ``stored``, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {path.rsplit("/", 1)[0] for path in df.inputFiles()}:
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def in_slices(texts: list[str], most_chars: int = 1 << 22):
    """Index ranges of consecutive texts with about ``most_chars`` characters in all, one text at least."""
    start, chars = 0, 0
    for i, text in enumerate(texts):
        if i > start and chars + len(text) > most_chars:
            yield start, i
            start, chars = i, 0
        chars += len(text)
    if start < len(texts):
        yield start, len(texts)
