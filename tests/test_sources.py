import gzip
from datetime import datetime

import pytest
from conftest import rows

from orderlens.operators import cleaning, star
from orderlens.plans import marts
from orderlens.schema import LINE_COLUMNS
from orderlens.sources import files, retail

SMALL = "/root/testdata/sf0.001"


def test_csv_in_latin_1_with_float_customers(spark, tmp_path):
    text = (
        "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
        "1,A,café £,6,12/1/2010 8:26,2.55,17850.0,United Kingdom\n"
        "C2,B,,-1,2010-12-01 08:26:00,1.0,,EIRE\n"
    )
    path = tmp_path / "lines.csv"
    path.write_bytes(text.encode("latin-1"))
    df = files.read_lines_csv(spark, str(path))
    assert df.columns == LINE_COLUMNS
    at = datetime(2010, 12, 1, 8, 26)
    assert rows(df) == [
        ("1", "A", "café £", 6, at, 2.55, 17850, "United Kingdom"),
        ("C2", "B", None, -1, at, 1.0, None, "EIRE"),
    ]


HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"


def lines_of(spark, tmp_path, text, **options):
    path = tmp_path / "lines.csv"
    path.write_bytes(text.encode("latin-1"))
    return files.read_lines_csv(spark, str(path), **options)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    text = "StockCode,InvoiceNo,Quantity,UnitPrice,CustomerID,Country,InvoiceDate\nA,1,6,2.5,7,X,1/3/2011 10:30:15\n"
    assert rows(lines_of(spark, tmp_path, text)) == [("1", "A", None, 6, datetime(2011, 1, 3, 10, 30, 15), 2.5, 7, "X")]


def test_csv_quotes_and_line_breaks(spark, tmp_path):
    text = HEADER + '1,A,"12"" RULER, STEEL",6,1/3/2011,2.5,7,X\n2,B,"two\nlines",1,2011-01-03,1.0,8,X\n'
    found = rows(lines_of(spark, tmp_path, text, multi_line=True), "Description", "CustomerID", "InvoiceDate")
    assert found == [('12" RULER, STEEL', 7, datetime(2011, 1, 3)), ("two\nlines", 8, datetime(2011, 1, 3))]


def test_csv_bad_fields_are_null_and_counted(spark, tmp_path):
    text = HEADER + "1,A,x,six,1/3/2011 9:05,NaN,NaN,X\n2,B,y,7,soon,1.5,12.5,X\n"
    df = lines_of(spark, tmp_path, text)
    assert rows(df, "Quantity", "UnitPrice", "CustomerID") == [(7, 1.5, None), (None, None, None)]
    lost = files.unreadable_fields(files.read_text_csv(spark, str(tmp_path / "lines.csv")))
    assert {r["column"]: r["n"] for r in lost.collect() if r["n"]} == {"Quantity": 1, "InvoiceDate": 1, "CustomerID": 1}


def test_schema_check_of_a_file(spark, tmp_path):
    (tmp_path / "lines.csv").write_text("StockCode,InvoiceNo,Note\nA,1,\n")
    found = cleaning.schema_check(files.read_text_csv(spark, str(tmp_path / "lines.csv"))).collect()
    status = {r["column"]: (r["status"], r["order_ok"], r["nulls"]) for r in found}
    assert status["StockCode"] == ("ok", False, 0)
    assert status["Note"] == ("extra", False, 1)
    assert status["Country"] == ("missing", False, None)


def test_csv_round_trip(spark, tmp_path):
    data = [('a "quoted", name', 1.5), (None, None), ("comma, end", 0.25)]
    files.write_mart(spark.createDataFrame(data, "name string, x double"), str(tmp_path), "t", form="csv")
    assert rows(files.read_text_csv(spark, f"{tmp_path}/t"), "name", "x") == sorted(
        [('a "quoted", name', "1.5"), (None, None), ("comma, end", "0.25")], key=lambda r: (r[0] is None, str(r[0])))


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("marts"))
    raw = retail.raw_lines(spark, SMALL)
    files.write_mart(raw, folder, marts.RAW)
    raw = files.read_mart(spark, folder, marts.RAW)
    marts.build_star(raw, folder)
    marts.build_line_marts(raw, folder)
    marts.build_customer_marts(files.read_mart(spark, folder, marts.SALES), folder)
    return folder


def test_stored_tables_hold_what_was_computed(spark, store):
    inputs = marts.StoredInputs(spark, SMALL, store)
    counts = [
        inputs.raw.count(), inputs.fact.count(), inputs.sales.count(), inputs.customers.count(),
        inputs.features.count(), inputs.segments.count(), inputs.customer_360.count(),
    ]
    assert counts == [6165, 4463, 4347, 150, 150, 150, 150]
    assert inputs.fact.filter("YearMonth = '1997-03'").count() > 0


def test_date_slice_reads_only_its_months(spark, store):
    fact = marts.StoredInputs(spark, SMALL, store).fact.filter("YearMonth = '1997-03'")
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(YearMonth" in plan


def test_csv_sink(spark, tmp_path):
    fact = cleaning.fact_transactions(retail.raw_lines(spark, SMALL))
    files.write_mart(star.dim_date(fact), str(tmp_path), "dim_date", form="csv")
    stored = spark.read.csv(f"{tmp_path}/dim_date", header=True)
    assert rows(stored, "DateKey") == rows(fact.select("DateKey").distinct())


def test_a_folder_of_files_with_headers_of_their_own(spark, tmp_path):
    folder = tmp_path / "a folder"
    folder.mkdir()
    (folder / "1.csv").write_text("InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n1,A,\"x, y\",2,2010-12-01 08:26:00,1.5,7,France\n")
    (folder / "2.csv").write_text("StockCode,InvoiceNo,Country,Quantity,Extra\nB,2,Spain,3,e\nC,3,Italy,4,e\n")
    with gzip.open(folder / "3.csv.gz", "wt") as f:
        f.write('"Quantity",UnitPrice,"StockCode",InvoiceNo\n5,2.5,D,4\n')
    (folder / "4.csv").write_text("StockCode,InvoiceNo,Country,Quantity,Extra\nE,5,Malta,6,e\n")
    (folder / "5.csv").write_text("")
    found = files.read_lines_csv(spark, str(folder))
    assert found.columns == LINE_COLUMNS
    got = sorted((r["InvoiceNo"], r["StockCode"], r["Quantity"], r["Country"], r["UnitPrice"], r["Description"]) for r in found.collect())
    assert got == [
        ("1", "A", 2, "France", 1.5, "x, y"),
        ("2", "B", 3, "Spain", None, None),
        ("3", "C", 4, "Italy", None, None),
        ("4", "D", 5, None, 2.5, None),
        ("5", "E", 6, "Malta", None, None),
    ]
    assert {r["column"]: r["n"] for r in files.unreadable_fields(files.read_text_csv(spark, str(folder))).collect()}["Quantity"] == 0
