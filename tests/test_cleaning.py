import pytest
from conftest import rows
from pyspark.sql import functions as F

from orderlens.operators import cleaning, orders, profiling, star, warehouse
from orderlens.schema import LINE_COLUMNS

D = "2011-01-03 10:30:00"


@pytest.fixture(scope="module")
def raw(make_lines):
    return make_lines(
        ("1", "A1", "tea", 2, D, 1.5, 7, " EIRE "),
        ("1", "A1", "tea", 2, D, 1.5, 7, " EIRE "),
        ("1", "A2", None, 1, D, 3.0, 7, "rsa"),
        ("C2", "A1", "tea", -2, D, 1.5, 7, "Unspecified"),
        ("C2", "A3", "pot", -1, D, 0.0, 8, "United Kingdom"),
        ("3", "A3", "pot", 1, D, 0.0, 8, "United Kingdom"),
        ("4", "A3", "pot", 1, D, None, 8, "United Kingdom"),
        ("5", "A3", "pot", 4, D, 2.0, None, "United Kingdom"),
        ("5", "A3", "pot", 4, D, 2.0, None, "United Kingdom"),
        ("6", "A3", "pot", -4, D, 2.0, 9, "United Kingdom"),
    )


def test_fact_keeps_cancellations_returns_and_missing_prices(raw):
    fact = cleaning.fact_transactions(raw)
    assert rows(fact, "InvoiceNo", "StockCode", "Country", "IsCancellation", "IsReturn") == [
        ("1", "A1", "Ireland", 0, 0),
        ("1", "A2", "South Africa", 0, 0),
        ("4", "A3", "United Kingdom", 0, 0),
        ("6", "A3", "United Kingdom", 0, 1),
        ("C2", "A1", "Unspecified", 1, 1),
        ("C2", "A3", "United Kingdom", 1, 1),
    ]
    assert rows(fact.filter("StockCode = 'A2'"), "Description") == [("UNKNOWN",)]
    first = fact.filter("StockCode = 'A2'").first()
    assert (first["Year"], first["Month"], first["DayOfWeek"], first["Hour"], first["Quarter"]) == (
        2011, 1, "Monday", 10, 1)
    assert (first["YearMonth"], first["DateKey"]) == ("2011-01", "2011-01-03")
    types = dict(fact.dtypes)
    assert types["IsReturn"] == "tinyint" and types["Year"] == "smallint"


def test_sales_and_cancellation_populations(raw):
    assert rows(cleaning.clean_sales(raw), "InvoiceNo", "StockCode", "TotalAmount", "Country") == [
        ("1", "A1", 3.0, " EIRE "), ("1", "A2", 3.0, "rsa")]
    assert cleaning.lines_with_cancellations(raw).count() == 7


def test_audit_adds_up(raw):
    a = cleaning.etl_audit(raw).first().asDict()
    assert a == {
        "input_rows": 10, "cancellations": 2, "returns": 3, "duplicates_removed": 2,
        "null_customers_dropped": 1, "descriptions_filled": 1, "bad_prices_removed": 1, "final_rows": 6,
    }
    assert a["final_rows"] == cleaning.fact_transactions(raw).count()
    empty = cleaning.etl_audit(raw.filter("false")).first()
    assert set(empty) == {0}


def test_schema_check_reports_missing_extra_and_order(raw):
    odd = raw.drop("Country").withColumn("Note", F.lit(1)).select("StockCode", "InvoiceNo", "Note")
    got = {r["column"]: tuple(r)[1:] for r in cleaning.schema_check(odd).collect()}
    assert got["Country"] == ("missing", False, None)
    assert got["Note"] == ("extra", False, 0)
    assert got["StockCode"] == ("ok", False, 0)
    nulls = {r["column"]: r["nulls"] for r in cleaning.schema_check(raw).collect()}
    assert (nulls["CustomerID"], nulls["UnitPrice"], nulls["Country"]) == (2, 1, 0)
    assert all(r["order_ok"] for r in cleaning.schema_check(raw).collect())


def test_duplicates_compare_nulls_as_equal(make_lines):
    df = make_lines(
        ("1", "A", None, 1, D, 1.0, None, "X"),
        ("1", "A", None, 1, D, 1.0, None, "X"),
        ("1", "A", "b", 1, D, 1.0, None, "X"),
    )
    got = profiling.duplicate_report(df).first()
    assert (got["exact_dups"], got["partial_dups"], got["extra"]) == (1, 2, 1)


def test_profile_and_top_values(raw):
    profile = {r["column"]: r for r in profiling.profile_columns(raw).collect()}
    assert set(profile) == set(LINE_COLUMNS)
    c = profile["CustomerID"]
    assert (c["non_null"], c["nulls"], c["null_pct"], c["n_distinct"], c["cardinality"]) == (8, 2, 20.0, 3, "MEDIUM")
    assert profile["InvoiceNo"]["cardinality"] == "HIGH"
    top = rows(profiling.top_values(raw, ["Description"], k=1), "value", "n", "pct")
    assert top == [("pot", 6, 60.0)]


def test_cancellation_rate_is_mixed_grain(raw):
    got = orders.cancellation_rate_monthly(cleaning.lines_with_cancellations(raw)).first()
    assert (got["total_invoices"], got["cancelled"]) == (5, 2)
    assert (got["cancel_rate"], got["cancel_invoice_rate"]) == (40.0, 20.0)


def test_slicers_include_both_ends(make_lines):
    df = make_lines(
        ("1", "A", "a", 1, "2011-01-01 00:00:00", 1.0, 1, "X"),
        ("2", "A", "a", 1, "2011-01-02 23:59:00", 1.0, 1, "Y"),
        ("3", "A", "a", 1, "2011-01-03 00:00:00", 1.0, 1, "X"),
    )
    assert rows(star.in_period(df, "2011-01-01", "2011-01-02"), "InvoiceNo") == [("1",), ("2",)]
    assert rows(star.in_period(df, countries=["X"]), "InvoiceNo") == [("1",), ("3",)]


def test_product_name_is_most_frequent_ties_to_smallest(make_lines):
    df = make_lines(*[(str(i), "A", n, 1, D, 1.0, 1, "X") for i, n in enumerate("babac")])
    got = star.dim_products(cleaning.fact_transactions(df)).first()
    assert (got["Description"], got["TimesOrdered"], got["TotalQtySold"]) == ("a", 5, 5)


def test_documented_orders_keep_free_lines_and_fill_discount(spark):
    df = spark.createDataFrame(
        [(2, 0.0, 0.5, 1.0), (2, 10.0, None, 4.0), (None, 1.0, 0.1, 0.0), (2, -1.0, 0.1, 0.0)],
        "Quantity long, UnitPrice double, discount double, cost double",
    )
    got = warehouse.line_economics(warehouse.clean_orders(df), "cost")
    assert rows(got, "sales", "discount_amount", "profit") == [(0.0, 0.0, -1.0), (20.0, 0.0, 16.0)]
    assert "profit" not in warehouse.line_economics(df).columns
