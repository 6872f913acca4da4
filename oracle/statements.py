"""The SQL twin of each query, for a single-node engine on the same tables."""

from itertools import combinations

from oracle.base import CTES, LINE, exact, histogram, mean, pct, with_ctes

COLUMNS = LINE.split(", ")
TYPES = dict(
    zip(COLUMNS, ["string", "string", "string", "bigint", "timestamp", "double", "bigint", "string"])
)
TEXT = ["InvoiceNo", "StockCode", "Description", "InvoiceDate", "Country"]
NUMERIC = ["Quantity", "UnitPrice", "CustomerID"]
SEVEN = ["Recency", "Frequency", "Monetary", "AvgOrderValue", "TotalItems", "UniqueProducts", "AvgUnitPrice"]
FEATURES = [
    "total_revenue", "total_items", "total_orders", "unique_products", "avg_unit_price",
    "avg_order_value", "avg_items_per_order", "customer_tenure_days", "recency_days",
    "revenue_per_item", "is_repeat_customer", "purchase_frequency", "unique_categories",
    "preferred_day", "preferred_hour",
]


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def profile() -> str:
    rows = union([
        f"""SELECT '{c}' AS "column", '{TYPES[c]}' AS dtype, count({c}) AS non_null,
  count(*) - count({c}) AS nulls, {pct(f'count(*) - count({c})', 'count(*)')} AS null_pct,
  count(DISTINCT {c}) AS n_distinct,
  CASE WHEN count(DISTINCT {c}) / count(*) > 0.5 THEN 'HIGH'
       WHEN count(DISTINCT {c}) / count(*) > 0.05 THEN 'MEDIUM' ELSE 'LOW' END AS cardinality
FROM raw_lines"""
        for c in COLUMNS
    ])
    return rows


def describe() -> str:
    return union([
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean,
  round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min,
  round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
  round(quantile_cont({c}, 0.75), 4) AS q75, CAST(max({c}) AS DOUBLE) AS max,
  round(skewness({c}), 4) AS skew, round(kurtosis({c}), 4) AS kurtosis FROM raw_lines"""
        for c in NUMERIC
    ])


def top_values() -> str:
    return union([
        f"""SELECT '{c}' AS "column", CAST(rank AS INT) AS rank, value, n, {pct('n', '(SELECT count(*) FROM raw_lines)')} AS pct
FROM (SELECT CAST({c} AS VARCHAR) AS value, count(*) AS n,
             row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) AS rank
      FROM raw_lines WHERE {c} IS NOT NULL GROUP BY 1) WHERE rank <= 10"""
        for c in TEXT
    ])


def correlation(table: str, columns: list[str]) -> str:
    return union([
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, "
        f"CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END AS r FROM {table}"
        for a, b in combinations(columns, 2)
    ])


def top(select: str, k: int, order: str) -> str:
    return f"SELECT * FROM ({select}) ORDER BY {order} LIMIT {k}"


def kpi() -> str:
    order_count = "(SELECT count(DISTINCT InvoiceNo) FROM sales)"
    customer_count = "(SELECT count(DISTINCT CustomerID) FROM sales)"
    revenue = f"(SELECT {exact('TotalAmount')} FROM sales)"
    repeat = "(SELECT count(*) FROM ordfreq WHERE x > 1)"
    first, last = (
        f"(SELECT revenue FROM months ORDER BY month {way} LIMIT 1)" for way in ("", "DESC")
    )
    numbers = {
        "revenue": revenue,
        "orders": order_count,
        "customers": customer_count,
        "aov": f"{revenue} / {order_count}",
        "revenue_per_customer": f"{revenue} / {customer_count}",
        "repeat_pct": pct(repeat, customer_count),
        "items_per_order": f"CAST((SELECT sum(Quantity) FROM sales) AS DOUBLE) / {order_count}",
        "growth_pct": f"({last} - {first}) * 100.0::DOUBLE / {first}",
        "retention_proxy_pct": pct(repeat, customer_count),
    }
    names = {
        k: f"(SELECT {c} FROM sales WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY {exact('TotalAmount')} DESC, {c} LIMIT 1)"
        for k, c in (("top_country", "Country"), ("top_product", "Description"))
    }
    return union(
        [f"SELECT '{k}' AS kpi, CAST({v} AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS label" for k, v in numbers.items()]
        + [f"SELECT '{k}' AS kpi, CAST(NULL AS DOUBLE) AS value, {v} AS label" for k, v in names.items()]
    )


def profile_bodies() -> dict[str, str]:
    return {
        "schema_check": union([
            f"""SELECT '{c}' AS "column", 'ok' AS status, true AS order_ok,
  count(*) - count({c}) AS nulls FROM raw_lines"""
            for c in COLUMNS
        ]),
        "etl_audit": """
SELECT (SELECT count(*) FROM raw_lines) AS input_rows,
  (SELECT count(*) FROM raw_lines WHERE starts_with(InvoiceNo, 'C')) AS cancellations,
  (SELECT count(*) FROM raw_lines WHERE Quantity < 0) AS returns,
  (SELECT count(*) FROM raw_lines) - count(*) AS duplicates_removed,
  count(*) FILTER (CustomerID IS NULL) AS null_customers_dropped,
  count(*) FILTER (CustomerID IS NOT NULL AND Description IS NULL) AS descriptions_filled,
  count(*) FILTER (CustomerID IS NOT NULL AND UnitPrice <= 0 AND NOT starts_with(InvoiceNo, 'C')) AS bad_prices_removed,
  (SELECT count(*) FROM fact) AS final_rows
FROM distinct_lines""",
        "profile_columns": profile(),
        "missing_overall": f"""
SELECT missing_cells, total_cells, {pct('missing_cells', 'total_cells')} AS pct
FROM (SELECT {' + '.join(f'count(*) - count({c})' for c in COLUMNS)} AS missing_cells, count(*) * 8 AS total_cells FROM raw_lines)""",
        "duplicate_report": f"""
SELECT exact_dups, {pct('exact_dups', 'n')} AS exact_pct, partial_dups, partial_dups - exact_dups AS extra
FROM (SELECT (SELECT count(*) FROM raw_lines) AS n,
  (SELECT count(*) FROM raw_lines) - (SELECT count(*) FROM distinct_lines) AS exact_dups,
  (SELECT count(*) FROM raw_lines) - (SELECT count(*) FROM (SELECT DISTINCT InvoiceNo, StockCode, Quantity, InvoiceDate FROM raw_lines)) AS partial_dups)""",
        "numeric_describe": describe(),
        "anomaly_flags": """
SELECT count(*) FILTER (Quantity < 0) AS neg_qty, count(*) FILTER (Quantity = 0) AS zero_qty,
  count(*) FILTER (UnitPrice < 0) AS neg_price, count(*) FILTER (UnitPrice = 0) AS zero_price FROM raw_lines""",
        "top_values": top_values(),
        "cancellation_share": f"""
SELECT count(*) FILTER (starts_with(InvoiceNo, 'C')) AS n,
  {pct("count(*) FILTER (starts_with(InvoiceNo, 'C'))", 'count(*)')} AS pct FROM raw_lines""",
        "country_dominance": f"""
SELECT (SELECT count(DISTINCT Country) FROM raw_lines) AS n_countries, Country AS country, count(*) AS n,
  {pct('count(*)', '(SELECT count(*) FROM raw_lines)')} AS pct
FROM raw_lines WHERE Country IS NOT NULL GROUP BY Country ORDER BY n DESC, Country LIMIT 1""",
        "date_range": """
SELECT first, last, date_sub('day', first, last) AS days, date_sub('day', first, last) // 30 AS months
FROM (SELECT min(InvoiceDate) AS first, max(InvoiceDate) AS last FROM raw_lines)""",
        "monthly_volume": "SELECT strftime(InvoiceDate, '%Y-%m') AS YearMonth, count(*) AS n FROM raw_lines GROUP BY 1",
        "first_rows": f"SELECT * FROM raw_lines ORDER BY {', '.join(f'{c} NULLS FIRST' for c in COLUMNS)} LIMIT 5",
    }


def star_bodies() -> dict[str, str]:
    return {
        "fact_transactions": "SELECT * FROM fact",
        "fact_calendar": """
SELECT *, CAST(year(InvoiceDate) AS SMALLINT) AS Year, CAST(month(InvoiceDate) AS TINYINT) AS Month,
       dayname(InvoiceDate) AS DayOfWeek, CAST(hour(InvoiceDate) AS TINYINT) AS Hour,
       CAST(quarter(InvoiceDate) AS TINYINT) AS Quarter, strftime(InvoiceDate, '%Y-%m') AS YearMonth,
       strftime(InvoiceDate, '%Y-%m-%d') AS DateKey FROM raw_lines""",
        "clean_sales": "SELECT * FROM sales",
        "lines_with_cancellations": "SELECT * FROM cxl",
        "dim_customers": "SELECT * FROM dimc",
        "dim_products": "SELECT * FROM dimp",
        "dim_date": "SELECT * FROM dimd",
        "star_join": """
SELECT dimd.Date, fact.InvoiceNo, fact.StockCode, fact.CustomerID, fact.Quantity, fact.TotalAmount,
  dimd.MonthName, dimd.IsWeekend, dimp.Description AS ProductName, dimc.Country AS CustomerCountry,
  dimc.TotalOrders AS CustomerOrders
FROM fact JOIN dimd ON date_trunc('day', fact.InvoiceDate) = dimd.Date
JOIN dimp ON fact.StockCode = dimp.StockCode JOIN dimc ON fact.CustomerID = dimc.CustomerID""",
    }


def sales_bodies() -> dict[str, str]:
    revenue = exact("TotalAmount")
    whole = f"(SELECT {revenue} FROM sales)"
    by_day = f"""SELECT CAST(isodow(InvoiceDate) - 1 AS INT) AS weekday_no, dayname(InvoiceDate) AS DayOfWeek,
  {revenue} AS revenue FROM sales GROUP BY 1, 2"""
    by_hour = f"SELECT CAST(hour(InvoiceDate) AS INT) AS Hour, {revenue} AS revenue FROM sales GROUP BY 1"
    per_month = f"SELECT strftime(InvoiceDate, '%Y-%m') AS YearMonth, {revenue} AS revenue FROM sales GROUP BY 1"
    per_country = f"SELECT Country, {revenue} AS revenue FROM sales WHERE Country IS NOT NULL GROUP BY Country"
    per_product = "FROM sales WHERE Description IS NOT NULL GROUP BY StockCode, Description"
    stats = "SELECT round(quantile_cont(x, 0.5), 6) AS median, round({m}, 6) AS mean FROM {t}"
    clip = "SELECT least({x}, (SELECT quantile_cont({x}, 0.95) FROM {t})) AS x FROM {t}"
    rate = f"""
SELECT YearMonth, count(DISTINCT InvoiceNo) AS total_invoices, CAST(sum(IsCancelled) AS BIGINT) AS cancelled,
  {pct('sum(IsCancelled)', 'count(DISTINCT InvoiceNo)')} AS cancel_rate,
  {pct('count(DISTINCT InvoiceNo) FILTER (IsCancelled = 1)', 'count(DISTINCT InvoiceNo)')} AS cancel_invoice_rate
FROM (SELECT *, strftime(InvoiceDate, '%Y-%m') AS YearMonth FROM cxl) GROUP BY YearMonth"""
    return {
        "sales_totals": f"""
SELECT revenue, orders, items, revenue / orders AS aov FROM (SELECT {revenue} AS revenue,
  count(DISTINCT InvoiceNo) AS orders, CAST(sum(Quantity) AS BIGINT) AS items FROM sales)""",
        "monthly_revenue": per_month,
        "peak_month": top(per_month, 1, "revenue DESC, YearMonth"),
        "revenue_by_country_top10": f"""
SELECT Country, revenue, {pct('revenue', whole)} AS pct_of_total,
  CAST(row_number() OVER (ORDER BY revenue DESC, Country) AS INT) AS rank
FROM ({per_country}) ORDER BY revenue DESC, Country LIMIT 10""",
        "revenue_by_weekday": f"SELECT *, row_number() OVER (ORDER BY revenue DESC, weekday_no) = 1 AS is_best FROM ({by_day})",
        "revenue_by_hour": f"SELECT *, row_number() OVER (ORDER BY revenue DESC, Hour) = 1 AS is_peak FROM ({by_hour})",
        "monthly_orders": "SELECT strftime(InvoiceDate, '%Y-%m') AS YearMonth, count(DISTINCT InvoiceNo) AS orders FROM sales GROUP BY 1",
        "customer_loyalty": f"""
SELECT customers, repeat, one_time, {pct('repeat', 'customers')} AS repeat_pct, {pct('one_time', 'customers')} AS one_time_pct,
  CASE WHEN repeat / customers > 0.5 THEN 'strong' ELSE 'moderate' END AS label
FROM (SELECT count(*) AS customers, count(*) FILTER (x > 1) AS repeat, count(*) FILTER (x = 1) AS one_time FROM ordfreq)""",
        "customers_by_country_top10": top(
            "SELECT Country, count(DISTINCT CustomerID) AS customers FROM sales WHERE Country IS NOT NULL GROUP BY Country",
            10, "customers DESC, Country"),
        "order_frequency_hist": histogram("SELECT least(x, 30) AS x FROM ordfreq", 30),
        "order_frequency_stats": stats.format(m="avg(x)", t="ordfreq"),
        "top_customers": f"""
SELECT CustomerID, x AS revenue, {pct('x', whole)} AS pct_of_total,
  {pct('CAST(sum(CAST(x AS DECIMAL(28,4))) OVER () AS DOUBLE)', whole)} AS top_k_pct
FROM (SELECT * FROM custrev ORDER BY x DESC, CustomerID LIMIT 10)""",
        "new_vs_returning": """
SELECT YearMonth, count(*) FILTER (YearMonth = FirstMonth) AS new, count(*) FILTER (YearMonth <> FirstMonth) AS returning
FROM active GROUP BY YearMonth""",
        "product_count": "SELECT count(DISTINCT StockCode) AS products FROM sales",
        "top_products_revenue": top(
            f"SELECT StockCode, Description, {revenue} AS revenue {per_product}", 20, "revenue DESC, StockCode, Description"),
        "top_products_quantity": top(
            f"SELECT StockCode, Description, CAST(sum(Quantity) AS BIGINT) AS quantity {per_product}",
            20, "quantity DESC, StockCode, Description"),
        "price_hist": histogram(clip.format(x="UnitPrice", t="sales"), 50),
        "price_stats": f"""
SELECT round(quantile_cont(UnitPrice, 0.5), 6) AS median, round({mean('UnitPrice')}, 6) AS mean,
  min(UnitPrice) AS min, max(UnitPrice) AS max FROM sales""",
        "products_per_invoice_hist": histogram("SELECT least(x, 50) AS x FROM prodinv", 50),
        "products_per_invoice_stats": stats.format(m="avg(x)", t="prodinv"),
        "aov_monthly": f"""
SELECT YearMonth, {mean('amount')} AS aov FROM (
  SELECT strftime(InvoiceDate, '%Y-%m') AS YearMonth, InvoiceNo, {revenue} AS amount FROM sales GROUP BY 1, 2) GROUP BY YearMonth""",
        "aov_overall": f"SELECT {mean('x')} AS aov FROM ordval",
        "order_size_hist": histogram(clip.format(x="x", t="ordval"), 50),
        "order_size_stats": stats.format(m=mean("x"), t="ordval"),
        "cancellation_rate_monthly": rate,
        "cancellation_rate_summary": f"""
SELECT round(avg(cancel_rate), 6) AS mean_cancel_rate, arg_max(YearMonth, (cancel_rate, -month_no)) AS worst_month
FROM (SELECT *, row_number() OVER (ORDER BY YearMonth) AS month_no FROM ({rate}))""",
    }


def customer_bodies() -> dict[str, str]:
    return {
        "customer_features": "SELECT * FROM features",
        "rfm_base": "SELECT * FROM rfm",
        "rfm_scores": "SELECT * FROM scores",
        "rfm_segments": "SELECT * FROM segs",
        "rfm_segment_summary": f"""
SELECT Segment, count(*) AS Count, CAST(sum(Recency) AS DOUBLE) / count(*) AS Avg_Recency,
  CAST(sum(Frequency) AS DOUBLE) / count(*) AS Avg_Frequency, {mean('Monetary')} AS Avg_Monetary
FROM segs GROUP BY Segment""",
        "rfm_highlights": f"""
SELECT champions, champion_revenue, {pct('champion_revenue', 'whole')} AS champion_pct, at_risk FROM (
  SELECT count(*) FILTER (Segment = 'Champions') AS champions,
    coalesce({exact("CASE WHEN Segment = 'Champions' THEN Monetary END")}, 0) AS champion_revenue,
    {exact('Monetary')} AS whole, count(*) FILTER (Segment IN ('At Risk', 'Cant Lose Them')) AS at_risk FROM segs)""",
        "segment_revenue": f"SELECT Segment, count(*) AS count, {exact('Monetary')} AS revenue FROM segs GROUP BY Segment",
        "feature_corr_all": f"SELECT feature_a, feature_b, round(r, 6) AS r FROM ({correlation('features', FEATURES)})",
        "strong_correlations": f"""
SELECT feature_a, feature_b, round(r, 6) AS r FROM ({correlation('features', FEATURES)}) WHERE abs(r) > 0.7""",
    }


def kpi_bodies() -> dict[str, str]:
    placed = f"""
SELECT CustomerID, x AS revenue,
  {pct('sum(CAST(x AS DECIMAL(28,4))) OVER (ORDER BY x DESC, CustomerID ROWS UNBOUNDED PRECEDING)',
       '(SELECT sum(CAST(x AS DECIMAL(28,4))) FROM custrev)')} AS cum_pct,
  {pct('row_number() OVER (ORDER BY x DESC, CustomerID)', '(SELECT count(*) FROM custrev)')} AS pct_customers
FROM custrev"""
    return {
        "executive_kpis": kpi(),
        "cohort_counts": "SELECT * FROM cohorts",
        "cohort_retention": "SELECT * FROM retention",
        # A stored view needs its columns named: the months that orders of the smaller test tables span.
        "cohort_matrix": f"""
SELECT * FROM (PIVOT retention ON CohortIndex IN ({", ".join(map(str, range(79)))}) USING first(retention_pct) GROUP BY CohortMonth)""",
        "clv_hist": histogram("SELECT x FROM custrev WHERE x <= (SELECT quantile_cont(x, 0.99) FROM custrev)", 50),
        "clv_stats": f"SELECT round(quantile_cont(x, 0.5), 6) AS median, round({mean('x')}, 6) AS mean FROM custrev",
        "revenue_vs_orders": """
SELECT custrev.CustomerID, round(custrev.x, 6) AS Revenue, ordfreq.x AS Orders,
  round((SELECT quantile_cont(x, 0.99) FROM custrev), 6) AS revenue_limit,
  round((SELECT quantile_cont(x, 0.99) FROM ordfreq), 6) AS orders_limit
FROM custrev JOIN ordfreq ON custrev.CustomerID = ordfreq.CustomerID""",
        "revenue_by_country_top15": top(
            f"SELECT Country, {exact('TotalAmount')} AS revenue FROM sales WHERE Country IS NOT NULL GROUP BY Country",
            15, "revenue DESC, Country"),
        "pareto": placed,
        "pareto_80": f"""
SELECT count(*) FILTER (cum_pct < 80) AS customers_below, count(*) AS customers,
  {pct('count(*) FILTER (cum_pct < 80)', 'count(*)')} AS pct_customers FROM ({placed})""",
    }


def advanced_bodies() -> dict[str, str]:
    scaled = ", ".join(
        f"round((ln(1 + {c}) - avg(ln(1 + {c})) OVER ()) / stddev_pop(ln(1 + {c})) OVER (), 6) AS {c}_scaled"
        for c in ("Recency", "Frequency", "Monetary")
    )
    days = f"""SELECT CAST(date_trunc('day', InvoiceDate) AS TIMESTAMP) AS day, {exact('TotalAmount')} AS revenue
FROM sales GROUP BY 1"""
    return {
        "rfm_scaled": f"SELECT CustomerID, {scaled} FROM rfm",
        "rfm_pca": PCA,
        "revenue_sma": "SELECT month, round(revenue, 6) AS revenue, round(sma, 6) AS sma FROM sma",
        "revenue_ema": "SELECT month, round(revenue, 6) AS revenue, round(ema, 6) AS ema FROM ema",
        "revenue_forecast": """
SELECT CAST((SELECT max(month) FROM months) + to_months(CAST(i AS INT)) AS TIMESTAMP) AS month,
  round((SELECT arg_max(sma, month) FROM sma), 6) AS sma_forecast,
  round((SELECT arg_max(ema, month) FROM ema), 6) AS ema_forecast FROM range(1, 4) t(i)""",
        "daily_anomalies": f"""
SELECT day, round(revenue, 6) AS revenue, round((revenue - m) / s, 6) AS z,
  abs((revenue - m) / s) > 2.5::DOUBLE AS is_anomaly,
  round(m - 2.5::DOUBLE * s, 6) AS band_low, round(m + 2.5::DOUBLE * s, 6) AS band_high
FROM (SELECT *, avg(revenue) OVER () AS m, stddev_samp(revenue) OVER () AS s FROM ({days}))""",
        "iqr_outliers": """
SELECT InvoiceNo, StockCode, CustomerID, InvoiceDate, Quantity, UnitPrice, TotalAmount
FROM sales, fence WHERE TotalAmount < lower_fence OR TotalAmount > upper_fence""",
        "amount_hist": histogram(
            "SELECT TotalAmount AS x FROM sales, fence WHERE TotalAmount <= upper_fence", 100),
        "feature_corr_7": f"SELECT feature_a, feature_b, round(r, 6) AS r FROM ({correlation('seven', SEVEN)})",
        "top_correlations": f"""
SELECT feature_a, feature_b, round(r, 6) AS r FROM ({correlation('seven', SEVEN)})
WHERE r IS NOT NULL ORDER BY abs(r) DESC, feature_a, feature_b LIMIT 5""",
        "product_pairs": pairs_of("basket"),
        "product_pairs_first10": pairs_of("basket10"),
        "product_pairs_sampled": pairs_of("basket_sample"),
    }


# The covariance matrix (a b c; b d e; c e f) of the scaled measures has its eigenvalues by the
# trigonometric formula; a vector of one is the longest cross product of two rows of the matrix less
# that value, its largest entry positive.
PCA = """
SELECT CustomerID,
  round(x * v1[1] + y * v1[2] + z * v1[3], 6) AS PC1, round(x * v2[1] + y * v2[2] + z * v2[3], 6) AS PC2,
  round(share1, 6) AS PC1_ratio, round(share2, 6) AS PC2_ratio
FROM pca_points, (
  SELECT max(vector) FILTER (k = 1) AS v1, max(vector) FILTER (k = 2) AS v2,
         max(share) FILTER (k = 1) AS share1, max(share) FILTER (k = 2) AS share2 FROM pca_vectors)"""


def pairs_of(basket: str) -> str:
    return f"""
SELECT a.Description AS item_a, b.Description AS item_b, count(*) AS n
FROM {basket} a JOIN {basket} b ON a.InvoiceNo = b.InvoiceNo AND a.Description < b.Description
GROUP BY 1, 2 ORDER BY n DESC, item_a, item_b LIMIT 20"""


BASKET = {
    "basket": "SELECT DISTINCT InvoiceNo, Description FROM sales WHERE Description IS NOT NULL",
    "basket10": """
SELECT InvoiceNo, Description FROM (
  SELECT InvoiceNo, Description, row_number() OVER (PARTITION BY InvoiceNo ORDER BY Description) AS place
  FROM basket) WHERE place <= 10""",
    "basket_sample": """
SELECT basket.* FROM basket JOIN (
  SELECT InvoiceNo FROM (SELECT DISTINCT InvoiceNo FROM sales WHERE Description IS NOT NULL)
  ORDER BY md5(InvoiceNo), InvoiceNo LIMIT 10000) picked ON basket.InvoiceNo = picked.InvoiceNo""",
}


def dashboard_bodies() -> dict[str, str]:
    revenue = exact("total_revenue")
    return {
        "dash_customer_360": "SELECT * FROM c360",
        "dash_filtered": "SELECT * FROM sel",
        "dash_totals": f"""
SELECT (SELECT count(*) FROM dimc) AS customers, {revenue} AS revenue, {revenue} / sum(total_orders) AS aov,
  CAST(sum(total_orders) AS BIGINT) AS orders,
  {pct('count(*) FILTER (is_repeat_customer = 1)', 'count(*)')} AS repeat_pct FROM features""",
        "dash_default_countries": "SELECT * FROM largest",
        "dash_cards": f"""
SELECT {revenue} AS revenue, CAST(sum(total_orders) AS BIGINT) AS orders, count(*) AS customers,
  {revenue} / sum(total_orders) AS aov, {pct('count(*) FILTER (is_repeat_customer = 1)', 'count(*)')} AS repeat_pct FROM sel""",
        "dash_segment_counts": "SELECT Segment, count(*) AS Count FROM sel GROUP BY Segment",
        "dash_segment_revenue": f"""
SELECT Segment, {revenue} AS total_revenue, {pct(revenue, f'(SELECT {revenue} FROM sel)')} AS share FROM sel GROUP BY Segment""",
        "dash_recency_revenue": "SELECT CustomerID, Recency, total_revenue, Segment, total_orders FROM sel",
        "dash_geo": f"SELECT Country, {revenue} AS total_revenue, count(*) AS customers FROM sel GROUP BY Country",
        "dash_cards_all": f"""
SELECT {revenue} AS revenue, CAST(sum(total_orders) AS BIGINT) AS orders, count(*) AS customers,
  {revenue} / sum(total_orders) AS aov, {pct('count(*) FILTER (is_repeat_customer = 1)', 'count(*)')} AS repeat_pct FROM c360""",
        "dash_geo_all": f"SELECT Country, {revenue} AS total_revenue, count(*) AS customers FROM c360 GROUP BY Country",
        "dash_preferred_day": "SELECT preferred_day AS day, count(*) AS customers FROM sel GROUP BY 1",
        "dash_preferred_hour": "SELECT preferred_hour AS hour, count(*) AS customers FROM sel GROUP BY 1",
        "dash_aov_hist": histogram(
            "SELECT avg_order_value AS x FROM sel", 50,
            ", round((SELECT quantile_cont(avg_order_value, 0.95) FROM sel), 6) AS view_limit"),
        "dash_items_box": """
SELECT Segment, round(quantile_cont(avg_items_per_order, 0.25), 6) AS q1,
  round(quantile_cont(avg_items_per_order, 0.5), 6) AS median,
  round(quantile_cont(avg_items_per_order, 0.75), 6) AS q3,
  round(min(avg_items_per_order), 6) AS min, round(max(avg_items_per_order), 6) AS max,
  round((SELECT quantile_cont(avg_items_per_order, 0.95) FROM sel), 6) AS view_limit FROM sel GROUP BY Segment""",
        "dash_tenure_hist": """
SELECT Segment, CAST(least(floor((customer_tenure_days - lo) / w), 49) AS INT) AS bin, count(*) AS n
FROM sel, (SELECT CASE WHEN min(customer_tenure_days) = max(customer_tenure_days)
                       THEN min(customer_tenure_days) - 0.5::DOUBLE ELSE min(customer_tenure_days) END AS lo,
  CASE WHEN min(customer_tenure_days) = max(customer_tenure_days) THEN 1.0::DOUBLE
       ELSE CAST(max(customer_tenure_days) - min(customer_tenure_days) AS DOUBLE) END / 50.0::DOUBLE AS w FROM sel)
GROUP BY 1, 2""",
    }


def measure_bodies() -> dict[str, str]:
    revenue = exact("TotalAmount")
    measures = f"""
SELECT revenue, orders, revenue / orders AS aov, customers, CAST(items AS DOUBLE) / orders AS avg_qty_per_order
FROM (SELECT {revenue} AS revenue, count(DISTINCT InvoiceNo) AS orders, count(DISTINCT CustomerID) AS customers,
  sum(Quantity) AS items FROM fact{{where}})"""
    by_product = f"SELECT Description, {revenue} AS revenue, count(DISTINCT InvoiceNo) AS orders FROM fact GROUP BY Description"
    return {
        "line_economics": """
SELECT *, Quantity * UnitPrice AS sales, Quantity * UnitPrice * discount AS discount_amount,
  Quantity * UnitPrice - cost AS profit FROM worders""",
        "clean_orders_doc": "SELECT * FROM corders",
        "dim_location": "SELECT DISTINCT region, country, region || '/' || country AS location_id FROM worders",
        "dim_product_doc": "SELECT DISTINCT StockCode AS product_id, category, sub_category FROM worders",
        "dim_date_doc": f"""
SELECT *, CAST(strftime(Date, '%Y%m%d') AS INT) AS date_id FROM ({CTES['dimd'].replace('FROM fact', 'FROM corders')})""",
        "fact_orders": """
SELECT InvoiceNo AS order_id, CustomerID AS customer_id, StockCode AS product_id,
  CAST(strftime(InvoiceDate, '%Y%m%d') AS INT) AS date_id, region || '/' || country AS location_id,
  Quantity, UnitPrice, discount, sales, discount_amount, profit FROM econ""",
        "revenue_by_region": f"SELECT region, {exact('sales')} AS revenue FROM econ GROUP BY region",
        "top_products_profit": top(
            f"SELECT StockCode, {exact('profit')} AS profit FROM econ GROUP BY StockCode", 10, "profit DESC, StockCode"),
        "sales_profit_totals": f"SELECT {exact('sales')} AS total_sales, {exact('profit')} AS total_profit FROM econ",
        "pbi_measures": measures.format(where=""),
        "pbi_orders_by_status": "SELECT IsCancellation, count(DISTINCT InvoiceNo) AS orders FROM fact GROUP BY 1",
        "pbi_segment_matrix": f"""
SELECT Segment, customers, revenue, revenue / orders AS aov FROM (
  SELECT Segment, count(DISTINCT fact.CustomerID) AS customers, {revenue} AS revenue, count(DISTINCT InvoiceNo) AS orders
  FROM fact JOIN segs ON fact.CustomerID = segs.CustomerID GROUP BY Segment)""",
        "pbi_top10_products": top(by_product, 10, "revenue DESC, Description"),
        "pbi_bottom_products": top(by_product, 10, "revenue, Description"),
        "revenue_by_category": f"SELECT substr(StockCode, 1, 2) AS category, {revenue} AS revenue FROM fact GROUP BY 1",
        "revenue_by_date": f"SELECT DateKey AS period, {revenue} AS revenue FROM fact GROUP BY 1",
        "revenue_by_month": f"SELECT YearMonth AS period, {revenue} AS revenue FROM fact GROUP BY 1",
        "revenue_geo": f"""
SELECT dimc.Country, {revenue} AS revenue FROM fact JOIN dimc ON fact.CustomerID = dimc.CustomerID GROUP BY dimc.Country""",
        "pbi_sliced_measures": measures.format(where="""
  WHERE InvoiceDate >= TIMESTAMP '1996-01-01' AND InvoiceDate < TIMESTAMP '1999-01-01'
    AND Country IN ('Ireland', 'South Africa', 'Nation_7')"""),
    }


def statements() -> dict[str, str]:
    bodies = {
        **profile_bodies(),
        **star_bodies(),
        **sales_bodies(),
        **customer_bodies(),
        **kpi_bodies(),
        **advanced_bodies(),
        **dashboard_bodies(),
        **measure_bodies(),
    }
    done = {}
    for name, body in bodies.items():
        if body.startswith("WITH "):
            done[name] = body
        else:
            done[name] = with_ctes(body, BASKET)
    return done
