"""Column contracts of the raw order lines and of the tables derived from them."""

from pyspark.sql import types as T

RAW_LINES = T.StructType(
    [
        T.StructField("InvoiceNo", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.LongType()),
        T.StructField("InvoiceDate", T.TimestampType()),
        T.StructField("UnitPrice", T.DoubleType()),
        T.StructField("CustomerID", T.LongType()),
        T.StructField("Country", T.StringType()),
    ]
)
LINE_COLUMNS = RAW_LINES.fieldNames()

CSV_ENCODING = "ISO-8859-1"

DUPLICATE_KEYS = ["InvoiceNo", "StockCode", "Quantity", "InvoiceDate"]
NUMERIC_COLUMNS = ["Quantity", "UnitPrice", "CustomerID"]
TEXT_COLUMNS = ["InvoiceNo", "StockCode", "Description", "InvoiceDate", "Country"]
