"""The tables a query may start from, each derived on demand from one folder of source tables."""

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from orderlens.functions.durable import durable, stored, stored_by
from orderlens.operators import cleaning, dashboard, features, rfm, sketches, star
from orderlens.sources import retail


@dataclass
class Inputs:
    spark: SparkSession
    folder: str

    @cached_property
    def raw(self) -> DataFrame:
        return retail.raw_lines(self.spark, self.folder)

    @cached_property
    def sales(self) -> DataFrame:
        return cleaning.clean_sales(self.raw)

    @cached_property
    def sketches(self) -> DataFrame:
        return sketches.monthly_sketches(self.sales)

    @cached_property
    def fact(self) -> DataFrame:
        return cleaning.fact_transactions(self.raw)

    @cached_property
    def with_cancellations(self) -> DataFrame:
        return cleaning.lines_with_cancellations(self.raw)

    @cached_property
    def orders(self) -> DataFrame:
        return retail.warehouse_orders(self.spark, self.folder)

    @cached_property
    def customers(self) -> DataFrame:
        return star.dim_customers(self.fact)

    @cached_property
    def products(self) -> DataFrame:
        return star.dim_products(self.fact)

    @cached_property
    def dates(self) -> DataFrame:
        return star.dim_date(self.fact)

    @cached_property
    def star_tables(self) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        """Fact lines, customers, products and dates of the star join, all from one stored table.

        The lines are not stored by customer, so those of a hot one stay spread over many tasks.
        """
        fact = cleaning.fact_transactions_of(stored(cleaning.customer_lines(self.raw)))
        return fact, star.dim_customers(fact), star.dim_products(fact), star.dim_date(fact)

    @cached_property
    def features(self) -> DataFrame:
        return features.customer_features(self.sales)

    @cached_property
    def rfm(self) -> DataFrame:
        return rfm.rfm_base(self.sales)

    @cached_property
    def segments(self) -> DataFrame:
        return rfm.rfm_segments(rfm.rfm_scores(self.rfm))

    @cached_property
    def customer_360(self) -> DataFrame:
        """Written once, as a dashboard reads one stored table many times.

        Its three parts group by customer, so the lines are dealt by customer once; their copies are
        removed within the buckets, where the distinct lines are stored.
        """
        lines = stored_by(self.raw, "CustomerID", lambda raw: cleaning.customer_lines(raw).drop("Description"))
        sales, fact = cleaning.sales_of(lines), cleaning.fact_of(lines)
        return durable(
            dashboard.customer_360(
                rfm.segments_of_sales(sales),
                features.customer_features(sales, in_buckets=True),
                star.dim_customers(fact, in_buckets=True),
            )
        )

    @cached_property
    def selection(self) -> DataFrame:
        """The dashboard's default view: all segments, the five largest countries."""
        return dashboard.filtered(self.customer_360)
