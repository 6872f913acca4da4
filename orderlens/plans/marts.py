"""Stored tables: built once per load, then read by every report.

Fact lines are partitioned by month so a date filter reads only its months; reports that need
few columns read only those.
"""

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from orderlens.operators import cleaning, dashboard, features, rfm, sketches, star
from orderlens.plans.inputs import Inputs
from orderlens.sources.files import read_mart, write_mart

FACT = "fact_transactions"
RAW = "raw_lines"
SALES = "sales_lines"
SKETCHES = "monthly_sketches"
WITH_CANCELLATIONS = "lines_with_cancellations"


def build_star(raw: DataFrame, folder: str, form: str = "parquet") -> None:
    """Clean the raw lines and write the fact table and its three dimensions."""
    spark = raw.sparkSession
    write_mart(cleaning.fact_transactions(raw), folder, FACT, ["YearMonth"], form)
    fact = (
        read_mart(spark, folder, FACT) if form == "parquet" else cleaning.fact_transactions(raw)
    )
    write_mart(star.dim_customers(fact), folder, "dim_customers", form=form)
    write_mart(star.dim_products(fact), folder, "dim_products", form=form)
    write_mart(star.dim_date(fact), folder, "dim_date", form=form)


def build_line_marts(raw: DataFrame, folder: str) -> None:
    """Write the two other line populations; their reports always read all months."""
    write_mart(cleaning.clean_sales(raw), folder, SALES)
    write_mart(cleaning.lines_with_cancellations(raw), folder, WITH_CANCELLATIONS)


def build_sketches(sales: DataFrame, folder: str) -> None:
    """Write the monthly sketches; approximate reports read these instead of lines."""
    write_mart(sketches.monthly_sketches(sales), folder, SKETCHES)


def build_customer_marts(sales: DataFrame, folder: str, form: str = "parquet") -> None:
    write_mart(features.customer_features(sales), folder, "customer_features", form=form)
    write_mart(rfm.segments_of_sales(sales), folder, "rfm_segments", form=form)


@dataclass
class StoredInputs(Inputs):
    """Query inputs read from stored marts."""

    marts: str

    def _stored(self, name: str) -> DataFrame:
        return read_mart(self.spark, self.marts, name)

    @cached_property
    def raw(self) -> DataFrame:
        return self._stored(RAW)

    @cached_property
    def sales(self) -> DataFrame:
        return self._stored(SALES)

    @cached_property
    def sketches(self) -> DataFrame:
        return self._stored(SKETCHES)

    @cached_property
    def fact(self) -> DataFrame:
        return self._stored(FACT)

    @cached_property
    def with_cancellations(self) -> DataFrame:
        return self._stored(WITH_CANCELLATIONS)

    @cached_property
    def customers(self) -> DataFrame:
        return self._stored("dim_customers")

    @cached_property
    def products(self) -> DataFrame:
        return self._stored("dim_products")

    @cached_property
    def dates(self) -> DataFrame:
        return self._stored("dim_date")

    @cached_property
    def star_tables(self) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        return self.fact, self.customers, self.products, self.dates

    @cached_property
    def features(self) -> DataFrame:
        return self._stored("customer_features")

    @cached_property
    def segments(self) -> DataFrame:
        return self._stored("rfm_segments")

    @cached_property
    def rfm(self) -> DataFrame:
        return self.segments.select("CustomerID", "Recency", "Frequency", "Monetary")

    @cached_property
    def customer_360(self) -> DataFrame:
        return dashboard.customer_360(self.segments, self.features, self.customers)
