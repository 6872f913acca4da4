"""Every query by name: what it starts from and which operator answers it."""

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.operators import (
    anomaly,
    basket,
    cleaning,
    cluster,
    cohort,
    correlation,
    customers,
    dashboard,
    forecast,
    kpi,
    measures,
    orders,
    pareto,
    products,
    profiling,
    rfm,
    sales,
    sketches,
    star,
    warehouse,
)
from orderlens.plans.inputs import Inputs
from orderlens.sources.files import write_mart

Query = Callable[[Inputs], DataFrame]

# Figures that merge floating-point parts in no fixed order differ in their last bits from run
# to run; they are shown to this many places.
PLACES = 6


def shown(df: DataFrame, places: int = PLACES) -> DataFrame:
    return df.select(
        *[
            F.round(c, places).alias(c) if t == "double" else F.col(c)
            for c, t in df.dtypes
        ]
    )

RAW: dict[str, Query] = {
    "schema_check": lambda i: cleaning.schema_check(i.raw),
    "etl_audit": lambda i: cleaning.etl_audit(i.raw),
    "profile_columns": lambda i: profiling.profile_columns(i.raw),
    "missing_overall": lambda i: profiling.missing_overall(i.raw),
    "duplicate_report": lambda i: profiling.duplicate_report(i.raw),
    "numeric_describe": lambda i: shown(profiling.numeric_describe(i.raw), 4),
    "anomaly_flags": lambda i: profiling.anomaly_flags(i.raw),
    "top_values": lambda i: profiling.top_values(i.raw),
    "cancellation_share": lambda i: profiling.cancellation_share(i.raw),
    "country_dominance": lambda i: profiling.country_dominance(i.raw),
    "date_range": lambda i: profiling.date_range(i.raw),
    "monthly_volume": lambda i: profiling.monthly_volume(i.raw),
    "first_rows": lambda i: profiling.first_rows(i.raw),
}

STAR: dict[str, Query] = {
    "fact_transactions": lambda i: i.fact,
    "fact_calendar": lambda i: cleaning.calendar(i.raw),
    "clean_sales": lambda i: i.sales,
    "lines_with_cancellations": lambda i: i.with_cancellations,
    "dim_customers": lambda i: i.customers,
    "dim_products": lambda i: i.products,
    "dim_date": lambda i: i.dates,
    "star_join": lambda i: star.star_join(*i.star_tables),
}

SALES: dict[str, Query] = {
    "sales_totals": lambda i: sales.sales_totals(i.sales),
    "monthly_revenue": lambda i: sales.monthly_revenue(i.sales),
    "peak_month": lambda i: sales.peak_month(i.sales),
    "revenue_by_country_top10": lambda i: sales.revenue_by_country_top10(i.sales),
    "revenue_by_weekday": lambda i: sales.revenue_by_weekday(i.sales),
    "revenue_by_hour": lambda i: sales.revenue_by_hour(i.sales),
    "monthly_orders": lambda i: sales.monthly_orders(i.sales),
    "customer_loyalty": lambda i: customers.customer_loyalty(i.sales),
    "customers_by_country_top10": lambda i: customers.customers_by_country_top10(i.sales),
    "order_frequency_hist": lambda i: shown(customers.order_frequency_hist(i.sales)),
    "order_frequency_stats": lambda i: shown(customers.order_frequency_stats(i.sales)),
    "top_customers": lambda i: customers.top_customers(i.sales),
    "new_vs_returning": lambda i: customers.new_vs_returning(i.sales),
    "product_count": lambda i: products.product_count(i.sales),
    "top_products_revenue": lambda i: products.top_products_revenue(i.sales),
    "top_products_quantity": lambda i: products.top_products_quantity(i.sales),
    "price_hist": lambda i: shown(products.price_hist(i.sales)),
    "price_stats": lambda i: shown(products.price_stats(i.sales)),
    "products_per_invoice_hist": lambda i: shown(products.products_per_invoice_hist(i.sales)),
    "products_per_invoice_stats": lambda i: shown(products.products_per_invoice_stats(i.sales)),
    "aov_monthly": lambda i: orders.aov_monthly(i.sales),
    "aov_overall": lambda i: orders.aov_overall(i.sales),
    "order_size_hist": lambda i: shown(orders.order_size_hist(i.sales)),
    "order_size_stats": lambda i: shown(orders.order_size_stats(i.sales)),
    "monthly_customers_approx": lambda i: sketches.monthly_customers(i.sketches),
    "yearly_customers_approx": lambda i: sketches.yearly_customers(i.sketches),
    "price_quantiles_approx": lambda i: sketches.price_quantiles(i.sketches),
    "cancellation_rate_monthly": lambda i: orders.cancellation_rate_monthly(i.with_cancellations),
    "cancellation_rate_summary": lambda i: shown(orders.cancellation_rate_summary(i.with_cancellations)),
}

CUSTOMERS: dict[str, Query] = {
    "customer_features": lambda i: i.features,
    "rfm_base": lambda i: i.rfm,
    "rfm_scores": lambda i: rfm.rfm_scores(i.rfm),
    "rfm_segments": lambda i: i.segments,
    "rfm_segment_summary": lambda i: rfm.rfm_segment_summary(i.segments),
    "rfm_highlights": lambda i: rfm.rfm_highlights(i.segments),
    "segment_revenue": lambda i: rfm.segment_revenue(i.segments),
    "feature_corr_all": lambda i: shown(correlation.feature_corr_all(i.features)),
    "strong_correlations": lambda i: shown(correlation.strong_correlations(i.features)),
}

KPI: dict[str, Query] = {
    "executive_kpis": lambda i: kpi.executive_kpis(i.sales),
    "cohort_counts": lambda i: cohort.cohort_counts(i.sales),
    "cohort_retention": lambda i: cohort.cohort_retention(i.sales),
    "cohort_matrix": lambda i: cohort.cohort_matrix(i.sales),
    "clv_hist": lambda i: shown(kpi.clv_hist(i.sales)),
    "clv_stats": lambda i: shown(kpi.clv_stats(i.sales)),
    "revenue_vs_orders": lambda i: shown(kpi.revenue_vs_orders(i.sales)),
    "revenue_by_country_top15": lambda i: sales.revenue_by_country_top15(i.sales),
    "pareto": lambda i: pareto.pareto(i.sales),
    "pareto_80": lambda i: pareto.pareto_80(i.sales),
}

ADVANCED: dict[str, Query] = {
    "rfm_scaled": lambda i: shown(cluster.rfm_scaled(i.rfm)),
    "kmeans_elbow": lambda i: cluster.kmeans_elbow(i.rfm),
    "kmeans_segments": lambda i: cluster.kmeans_segments(i.rfm),
    "kmeans_profiles": lambda i: cluster.kmeans_profiles(i.rfm),
    "rfm_pca": lambda i: shown(cluster.rfm_pca(i.rfm)),
    "revenue_sma": lambda i: shown(forecast.revenue_sma(i.sales)),
    "revenue_ema": lambda i: shown(forecast.revenue_ema(i.sales)),
    "revenue_forecast": lambda i: shown(forecast.revenue_forecast(i.sales)),
    "daily_anomalies": lambda i: shown(anomaly.daily_anomalies(i.sales)),
    "iqr_outliers": lambda i: anomaly.iqr_outliers(i.sales),
    "amount_hist": lambda i: shown(anomaly.amount_hist(i.sales)),
    "feature_corr_7": lambda i: shown(correlation.feature_corr_7(i.sales)),
    "top_correlations": lambda i: shown(correlation.top_correlations(i.sales)),
    "product_pairs": lambda i: basket.product_pairs(i.sales),
    "product_pairs_first10": lambda i: basket.product_pairs(i.sales, max_items=10),
    "product_pairs_sampled": lambda i: basket.product_pairs(i.sales, sample=10_000),
}

DASHBOARD: dict[str, Query] = {
    "dash_customer_360": lambda i: i.customer_360,
    "dash_filtered": lambda i: i.selection,
    "dash_totals": lambda i: dashboard.totals(i.customers, i.features),
    "dash_default_countries": lambda i: dashboard.default_countries(i.customer_360),
    "dash_cards": lambda i: dashboard.cards(i.selection),
    "dash_segment_counts": lambda i: dashboard.segment_counts(i.selection),
    "dash_segment_revenue": lambda i: dashboard.segment_revenue(i.selection),
    "dash_recency_revenue": lambda i: dashboard.recency_revenue(i.selection),
    "dash_geo": lambda i: dashboard.geo(i.selection),
    "dash_cards_all": lambda i: dashboard.cards(i.customer_360),
    "dash_geo_all": lambda i: dashboard.geo(i.customer_360),
    "dash_preferred_day": lambda i: dashboard.preferred_day(i.selection),
    "dash_preferred_hour": lambda i: dashboard.preferred_hour(i.selection),
    "dash_aov_hist": lambda i: shown(dashboard.aov_hist(i.selection)),
    "dash_items_box": lambda i: shown(dashboard.items_box(i.selection)),
    "dash_tenure_hist": lambda i: dashboard.tenure_hist(i.selection),
}

MEASURES: dict[str, Query] = {
    "line_economics": lambda i: warehouse.line_economics(i.orders, "cost"),
    "clean_orders_doc": lambda i: warehouse.clean_orders(i.orders),
    "dim_location": lambda i: warehouse.dim_location(i.orders),
    "dim_product_doc": lambda i: warehouse.dim_product(i.orders),
    "dim_date_doc": lambda i: warehouse.dim_date_doc(i.orders),
    "fact_orders": lambda i: warehouse.fact_orders(i.orders, "cost"),
    "revenue_by_region": lambda i: warehouse.revenue_by_region(i.orders),
    "top_products_profit": lambda i: warehouse.top_products_profit(i.orders, "cost"),
    "sales_profit_totals": lambda i: warehouse.sales_profit_totals(i.orders, "cost"),
    "pbi_measures": lambda i: measures.pbi_measures(i.fact),
    "pbi_orders_by_status": lambda i: measures.orders_by_status(i.fact),
    "pbi_segment_matrix": lambda i: measures.segment_matrix(i.fact, i.segments),
    "pbi_top10_products": lambda i: measures.top_products(i.fact),
    "pbi_bottom_products": lambda i: measures.bottom_products(i.fact),
    "revenue_by_category": lambda i: measures.revenue_by_category(i.fact),
    "revenue_by_date": lambda i: measures.revenue_by_date(i.fact),
    "revenue_by_month": lambda i: measures.revenue_by_date(i.fact, "month"),
    "revenue_geo": lambda i: measures.revenue_geo(i.fact, i.customers),
    "pbi_sliced_measures": lambda i: measures.pbi_measures(
        star.in_period(i.fact, "1996-01-01", "1998-12-31", ["Ireland", "South Africa", "Nation_7"])
    ),
}

GROUPS = {
    "profile": RAW,
    "star": STAR,
    "sales": SALES,
    "customers": CUSTOMERS,
    "kpi": KPI,
    "advanced": ADVANCED,
    "dashboard": DASHBOARD,
    "measures": MEASURES,
}


def write_reports(inputs: Inputs, folder: str, groups: Iterable[str] = GROUPS, form: str = "parquet") -> list[str]:
    """Write the result of every query of ``groups`` to a table of its name; returns the names."""
    names = []
    for group in groups:
        for name, query in GROUPS[group].items():
            write_mart(query(inputs), folder, name, form=form)
            names.append(name)
    return names


def _on_folder(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: query(Inputs(spark, folder))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _on_folder(q) for group in GROUPS.values() for name, q in group.items()}
