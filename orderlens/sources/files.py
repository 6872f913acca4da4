"""Reading and writing order files and marts."""

import csv
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions.times import parse_invoice_date
from orderlens.schema import CSV_ENCODING, LINE_COLUMNS

# Quotes inside a quoted field are doubled, as other tools write and read them.
CSV_FORM = {"header": True, "quote": '"', "escape": '"'}


def header_of(spark: SparkSession, file: str) -> tuple[str, ...]:
    """The names in a CSV file's first line; none for an empty file. Only that line is read."""
    hadoop = spark._jvm.org.apache.hadoop
    conf = spark._jsc.hadoopConfiguration()
    place = hadoop.fs.Path(file)
    stream = place.getFileSystem(conf).open(place)
    codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
    source = codec.createInputStream(stream) if codec else stream
    reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(source, CSV_ENCODING))
    try:
        line = reader.readLine()
    finally:
        reader.close()
    return tuple(next(csv.reader([line]), ())) if line else ()


def read_text_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A CSV file, or a folder of them, as it is: every field as text under its name in the header.

    Each file goes by its own header: files with equal headers are read together, and a field that a
    file lacks is null. ``multi_line`` allows line breaks inside quotes; such a file is read by one
    task, so leave it off for large files without them.
    """
    reader = spark.read.options(encoding=CSV_ENCODING, multiLine=multi_line, **CSV_FORM)
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file in sorted(spark.read.text(path).inputFiles()):
        by_header.setdefault(header_of(spark, unquote(file)), []).append(unquote(file))
    by_header.pop((), None)
    if len(by_header) <= 1:
        return reader.csv(path)
    parts = [reader.csv(files) for _, files in sorted(by_header.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def line_fields(found: Sequence[str]) -> dict[str, Column]:
    """Typed order-line columns from text columns ``found`` by name; a missing column is null."""

    def field(name: str) -> Column:
        return F.col(name) if name in found else F.lit(None).cast("string")

    def number(name: str) -> Column:
        value = field(name).try_cast("double")
        return F.when(~F.isnan(value), value)

    def whole(name: str, form: str) -> Column:
        value = number(name)
        return F.when(value == F.floor(value), F.coalesce(field(name).try_cast(form), value.try_cast(form)))

    typed = {
        "Quantity": whole("Quantity", "bigint"),
        "InvoiceDate": parse_invoice_date(field("InvoiceDate")),
        "UnitPrice": number("UnitPrice"),
        "CustomerID": whole("CustomerID", "bigint"),
    }
    return {c: typed.get(c, field(c)) for c in LINE_COLUMNS}


def typed_lines(text: DataFrame) -> DataFrame:
    """Order lines from text columns found by name, in any order.

    Fields that cannot be read and ``NaN`` become null; ``unreadable_fields`` counts the former.
    """
    return text.select(*[value.alias(name) for name, value in line_fields(text.columns).items()])


def unreadable_fields(text: DataFrame) -> DataFrame:
    """column, n: fields per column that hold text but neither a value nor ``NaN``."""

    def lost(name: str, value: Column) -> Column:
        return F.count_if(F.col(name).isNotNull() & (F.lower(F.trim(F.col(name))) != "nan") & value.isNull())

    fields = {c: v for c, v in line_fields(text.columns).items() if c in text.columns}
    counts = text.agg(*[lost(c, v).alias(c) for c, v in fields.items()])
    rows = [F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in fields]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def read_lines_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Order lines from CSV, by header name."""
    return typed_lines(read_text_csv(spark, path, multi_line))


def read_mart(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}")


def write_mart(
    df: DataFrame, folder: str, name: str, partition_by: Sequence[str] = (), form: str = "parquet"
) -> None:
    """Write one table, replacing the last run's; ``form`` is parquet or csv."""
    if partition_by:
        # Adaptive execution sizes the writers: small folders share one, hot folders are split.
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    if form == "csv":
        writer.csv(f"{folder}/{name}", **CSV_FORM)
    else:
        writer.parquet(f"{folder}/{name}")


def write_jdbc(
    tables: Mapping[str, DataFrame], url: str, properties: Mapping[str, str] | None = None
) -> None:
    """Load tables into the caller's database; partitions insert side by side."""
    for name, table in tables.items():
        table.write.jdbc(url, name, mode="overwrite", properties=dict(properties or {}))
