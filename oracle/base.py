"""Common table expressions the statements build on."""

import re


def exact(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(28,4))) AS DOUBLE)"


def mean(x: str) -> str:
    return f"{exact(x)} / count({x})"


def pct(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) * 100.0::DOUBLE / CAST({whole} AS DOUBLE)"


def mode(table: str, key: str, value: str, name: str) -> str:
    return f"""SELECT {key}, {value} AS {name} FROM (
        SELECT {key}, {value}, row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, {value}) AS rn
        FROM {table} WHERE {value} IS NOT NULL GROUP BY {key}, {value}) WHERE rn = 1"""


LINE = "InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country"

CTES = {
    "joined": """
SELECT l_orderkey AS ok, l_linenumber AS ln, l_partkey AS pk, l_quantity AS q, l_extendedprice AS ep,
       l_discount AS discount, o_custkey AS ck, o_orderdate AS od, p_name, p_brand, p_type,
       p_retailprice, c_nationkey AS nk, n_name, n_regionkey
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "once": """
SELECT CASE WHEN ok % 50 = 0 THEN 'C' || ok ELSE CAST(ok AS VARCHAR) END AS InvoiceNo,
       lpad(substr(p_brand, 7), CAST(greatest(2, length(substr(p_brand, 7))) AS INT), '0')
         || lpad(CAST(pk AS VARCHAR), CAST(greatest(5, length(CAST(pk AS VARCHAR))) AS INT), '0') AS StockCode,
       CASE WHEN pk % 200 = 0 THEN NULL WHEN (ok + ln) % 29 = 0 THEN upper(p_name) ELSE p_name END AS Description,
       CAST(q * (CASE WHEN ok % 50 = 0 THEN -1 ELSE 1 END)
              * (CASE WHEN (ok + pk) % 97 = 0 THEN 40 ELSE 1 END) AS BIGINT) AS Quantity,
       od + to_hours(6 + ok % 15) + to_minutes((ok * 7) % 60) AS InvoiceDate,
       CAST(CASE WHEN pk % 100 = 1 AND ln = 7 THEN 0 ELSE floor(ep / q * 100) / 100 END AS DOUBLE) AS UnitPrice,
       CASE WHEN ok % 4 = 1 THEN NULL ELSE ck END AS CustomerID,
       CASE nk WHEN 0 THEN ' EIRE ' WHEN 1 THEN 'rsa' WHEN 2 THEN 'UNITED KINGDOM' ELSE n_name END AS Country,
       ok, discount, p_brand, p_type, p_retailprice, n_regionkey, n_name
FROM joined""",
    "lines": "SELECT * FROM once UNION ALL SELECT * FROM once WHERE ok % 100 IN (0, 7, 9)",
    "raw_lines": f"SELECT {LINE} FROM lines",
    "distinct_lines": "SELECT DISTINCT * FROM raw_lines",
    "sales": """
SELECT *, Quantity * UnitPrice AS TotalAmount FROM distinct_lines
WHERE CustomerID IS NOT NULL AND NOT starts_with(InvoiceNo, 'C') AND Quantity > 0 AND UnitPrice > 0""",
    "cxl": """
SELECT *, Quantity * UnitPrice AS TotalAmount,
       CAST(starts_with(InvoiceNo, 'C') AS TINYINT) AS IsCancelled
FROM distinct_lines WHERE CustomerID IS NOT NULL""",
    "titled": r"""
SELECT * REPLACE (array_to_string(list_transform(
         regexp_extract_all(lower(trim(Country)), '(\p{L}+|\P{L}+)', 1),
         lambda x: upper(left(x, 1)) || substr(x, 2)), '') AS Country)
FROM distinct_lines
WHERE CustomerID IS NOT NULL
  AND NOT (coalesce(UnitPrice <= 0, false) AND NOT starts_with(InvoiceNo, 'C'))""",
    "fact": """
SELECT InvoiceNo, StockCode, coalesce(Description, 'UNKNOWN') AS Description, Quantity, InvoiceDate,
       UnitPrice, CustomerID,
       CASE Country WHEN 'Eire' THEN 'Ireland' WHEN 'Rsa' THEN 'South Africa' ELSE Country END AS Country,
       CAST(starts_with(InvoiceNo, 'C') AS TINYINT) AS IsCancellation,
       CAST(coalesce(Quantity < 0, false) AS TINYINT) AS IsReturn,
       Quantity * UnitPrice AS TotalAmount,
       CAST(year(InvoiceDate) AS SMALLINT) AS Year, CAST(month(InvoiceDate) AS TINYINT) AS Month,
       dayname(InvoiceDate) AS DayOfWeek, CAST(hour(InvoiceDate) AS TINYINT) AS Hour,
       CAST(quarter(InvoiceDate) AS TINYINT) AS Quarter,
       strftime(InvoiceDate, '%Y-%m') AS YearMonth, strftime(InvoiceDate, '%Y-%m-%d') AS DateKey
FROM titled""",
    "dimc": f"""
SELECT f.CustomerID, min(c.Country) AS Country, min(InvoiceDate) AS FirstPurchaseDate,
       max(InvoiceDate) AS LastPurchaseDate, count(DISTINCT InvoiceNo) AS TotalOrders,
       CAST(sum(Quantity) AS BIGINT) AS TotalItems, {exact('TotalAmount')} AS TotalRevenue,
       {mean('TotalAmount')} AS AvgOrderValue, count(DISTINCT StockCode) AS UniqueProducts,
       date_sub('day', min(InvoiceDate), max(InvoiceDate)) AS CustomerTenureDays
FROM fact f JOIN (
  SELECT CustomerID, Country FROM (
    SELECT CustomerID, Country, row_number() OVER (PARTITION BY CustomerID ORDER BY min(InvoiceDate), Country) AS rn
    FROM fact GROUP BY CustomerID, Country) WHERE rn = 1) c ON f.CustomerID = c.CustomerID
GROUP BY f.CustomerID""",
    "dimp": f"""
SELECT f.StockCode, min(n.Description) AS Description, {mean('UnitPrice')} AS AvgUnitPrice,
       min(UnitPrice) AS MinUnitPrice, max(UnitPrice) AS MaxUnitPrice,
       CAST(sum(Quantity) AS BIGINT) AS TotalQtySold, {exact('TotalAmount')} AS TotalRevenue,
       count(DISTINCT InvoiceNo) AS TimesOrdered
FROM fact f JOIN ({mode('fact', 'StockCode', 'Description', 'Description')}) n ON f.StockCode = n.StockCode
GROUP BY f.StockCode""",
    "dimd": """
SELECT Date, CAST(year(Date) AS INT) AS Year, CAST(month(Date) AS INT) AS Month, monthname(Date) AS MonthName,
       CAST(quarter(Date) AS INT) AS Quarter, dayname(Date) AS DayOfWeek,
       CAST(day(Date) AS INT) AS DayOfMonth, CAST(weekofyear(Date) AS INT) AS WeekOfYear,
       CAST(isodow(Date) IN (6, 7) AS INT) AS IsWeekend, strftime(Date, '%Y-%m-%d') AS DateKey
FROM (SELECT DISTINCT CAST(date_trunc('day', InvoiceDate) AS TIMESTAMP) AS Date FROM fact)""",
    "ref": "SELECT max(InvoiceDate) + INTERVAL 1 DAY AS as_of FROM sales",
    "rfm": f"""
SELECT CustomerID, date_sub('day', max(InvoiceDate), (SELECT as_of FROM ref)) AS Recency,
       count(DISTINCT InvoiceNo) AS Frequency, {exact('TotalAmount')} AS Monetary
FROM sales GROUP BY CustomerID""",
    "scored": """
SELECT CustomerID, Recency, Frequency, Monetary,
       CAST(5 - (CAST(Recency > e[1] AS INT) + CAST(Recency > e[2] AS INT)
               + CAST(Recency > e[3] AS INT) + CAST(Recency > e[4] AS INT)) AS INT) AS R_Score,
       CAST(greatest(1, (5 * (fr - 1) + (n - 2)) // (n - 1)) AS INT) AS F_Score,
       CAST(greatest(1, (5 * (mr - 1) + (n - 2)) // (n - 1)) AS INT) AS M_Score
FROM (SELECT *, row_number() OVER (ORDER BY Frequency, CustomerID) AS fr,
             row_number() OVER (ORDER BY Monetary, CustomerID) AS mr FROM rfm),
     (SELECT count(*) AS n, quantile_cont(Recency, [0.2, 0.4, 0.6, 0.8]) AS e FROM rfm)""",
    "scores": """
SELECT *, CAST(R_Score AS VARCHAR) || F_Score || M_Score AS RFM_Score,
       CAST(R_Score + F_Score + M_Score AS INT) AS RFM_Total FROM scored""",
    "segs": """
SELECT *, CASE
    WHEN R_Score >= 4 AND F_Score >= 4 AND M_Score >= 4 THEN 'Champions'
    WHEN R_Score >= 3 AND F_Score >= 3 AND M_Score >= 3 THEN 'Loyal Customers'
    WHEN R_Score >= 4 AND F_Score <= 2 THEN 'New Customers'
    WHEN R_Score >= 3 AND M_Score >= 2 THEN 'Potential Loyalists'
    WHEN R_Score >= 3 AND F_Score <= 2 AND M_Score <= 2 THEN 'Promising'
    WHEN R_Score = 3 AND F_Score = 3 THEN 'Need Attention'
    WHEN R_Score <= 2 AND F_Score >= 3 AND M_Score >= 3 THEN 'At Risk'
    WHEN R_Score <= 2 AND F_Score >= 4 AND M_Score >= 4 THEN 'Cant Lose Them'
    WHEN R_Score <= 2 AND F_Score <= 2 THEN 'Lost'
    WHEN R_Score <= 2 AND F_Score >= 2 THEN 'Hibernating'
    ELSE 'About to Sleep' END AS Segment
FROM scores""",
    "features": f"""
SELECT s.CustomerID, total_revenue, total_items, total_orders, unique_products, avg_unit_price,
       total_revenue / total_orders AS avg_order_value,
       CAST(total_items AS DOUBLE) / total_orders AS avg_items_per_order,
       date_sub('day', first_at, last_at) AS customer_tenure_days,
       date_sub('day', last_at, (SELECT as_of FROM ref)) AS recency_days,
       total_revenue / total_items AS revenue_per_item,
       CAST(total_orders > 1 AS INT) AS is_repeat_customer,
       CASE WHEN date_sub('day', first_at, last_at) > 0
            THEN CAST(total_orders AS DOUBLE) / (date_sub('day', first_at, last_at) / 30.44::DOUBLE)
            ELSE total_orders END AS purchase_frequency,
       unique_categories, d.preferred_day, h.preferred_hour, c.country
FROM (SELECT CustomerID, {exact('TotalAmount')} AS total_revenue, CAST(sum(Quantity) AS BIGINT) AS total_items,
             count(DISTINCT InvoiceNo) AS total_orders, count(DISTINCT StockCode) AS unique_products,
             {mean('UnitPrice')} AS avg_unit_price, min(InvoiceDate) AS first_at, max(InvoiceDate) AS last_at,
             count(DISTINCT substr(StockCode, 1, 2)) AS unique_categories
      FROM sales GROUP BY CustomerID) s
JOIN ({mode('(SELECT CustomerID, CAST(isodow(InvoiceDate) - 1 AS INT) AS day FROM sales)', 'CustomerID', 'day', 'preferred_day')}) d ON s.CustomerID = d.CustomerID
JOIN ({mode('(SELECT CustomerID, CAST(hour(InvoiceDate) AS INT) AS hour FROM sales)', 'CustomerID', 'hour', 'preferred_hour')}) h ON s.CustomerID = h.CustomerID
JOIN ({mode('sales', 'CustomerID', 'Country', 'country')}) c ON s.CustomerID = c.CustomerID""",
    "c360": """
SELECT segs.*, f.* EXCLUDE (CustomerID, country), f.country AS feature_country, dimc.* EXCLUDE (CustomerID)
FROM segs JOIN features f ON segs.CustomerID = f.CustomerID JOIN dimc ON segs.CustomerID = dimc.CustomerID""",
    "largest": "SELECT Country, count(*) AS n FROM c360 GROUP BY Country ORDER BY n DESC, Country LIMIT 5",
    "sel": "SELECT * FROM c360 WHERE Country IN (SELECT Country FROM largest)",
    "worders": """
SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, discount,
       Quantity * p_retailprice AS cost, p_brand AS category, p_type AS sub_category,
       r_name AS region, n_name AS country
FROM lines JOIN region ON n_regionkey = r_regionkey""",
    "corders": "SELECT DISTINCT * FROM worders WHERE Quantity > 0 AND UnitPrice >= 0",
    "econ": """
SELECT *, Quantity * UnitPrice AS sales, Quantity * UnitPrice * discount AS discount_amount,
       Quantity * UnitPrice - cost AS profit FROM corders""",
    "active": """
SELECT *, min(YearMonth) OVER (PARTITION BY CustomerID) AS FirstMonth
FROM (SELECT DISTINCT CustomerID, strftime(InvoiceDate, '%Y-%m') AS YearMonth FROM sales)""",
    "cohorts": """
SELECT FirstMonth AS CohortMonth, YearMonth AS OrderMonth,
       CAST(date_diff('month', CAST(FirstMonth || '-01' AS DATE), CAST(YearMonth || '-01' AS DATE)) AS INT) AS CohortIndex,
       count(*) AS n_customers
FROM active GROUP BY FirstMonth, YearMonth""",
    "retention": f"""
SELECT CohortMonth, CohortIndex,
       {pct('n_customers', 'max(CASE WHEN CohortIndex = 0 THEN n_customers END) OVER (PARTITION BY CohortMonth)')} AS retention_pct
FROM cohorts""",
    "months": f"""
SELECT CAST(date_trunc('month', InvoiceDate) AS TIMESTAMP) AS month, {exact('TotalAmount')} AS revenue
FROM sales GROUP BY 1""",
    "ema_steps": """
SELECT month, revenue, row_number() OVER (ORDER BY month) AS rn FROM months""",
    "sma": """
SELECT month, revenue, avg(revenue) OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS sma FROM months""",
    "ema": """
SELECT month, revenue,
       list_reduce(list_slice(all_revenue, 1, rn), lambda s, x: 0.3::DOUBLE * x + 0.7::DOUBLE * s) AS ema
FROM ema_steps, (SELECT list(revenue ORDER BY month) AS all_revenue FROM months)""",
    "seven": f"""
SELECT CustomerID, date_sub('day', max(InvoiceDate), (SELECT as_of FROM ref)) AS Recency,
       count(DISTINCT InvoiceNo) AS Frequency, {exact('TotalAmount')} AS Monetary,
       {mean('TotalAmount')} AS AvgOrderValue, CAST(sum(Quantity) AS BIGINT) AS TotalItems,
       count(DISTINCT StockCode) AS UniqueProducts, {mean('UnitPrice')} AS AvgUnitPrice
FROM sales GROUP BY CustomerID""",
    "pca_points": """
SELECT CustomerID, (r - avg(r) OVER ()) / stddev_pop(r) OVER () AS x, (f - avg(f) OVER ()) / stddev_pop(f) OVER () AS y,
       (m - avg(m) OVER ()) / stddev_pop(m) OVER () AS z
FROM (SELECT CustomerID, ln(1 + Recency) AS r, ln(1 + Frequency) AS f, ln(1 + Monetary) AS m FROM rfm)""",
    "pca_matrix": """
SELECT covar_pop(x, x) AS a, covar_pop(x, y) AS b, covar_pop(x, z) AS c, covar_pop(y, y) AS d,
       covar_pop(y, z) AS e, covar_pop(z, z) AS f FROM pca_points""",
    "pca_scale": """
SELECT *, (a + d + f) / 3 AS q,
       sqrt(((a - (a + d + f) / 3) ** 2 + (d - (a + d + f) / 3) ** 2 + (f - (a + d + f) / 3) ** 2
             + 2 * (b * b + c * c + e * e)) / 6) AS p FROM pca_matrix""",
    "pca_angle": """
SELECT *, acos(greatest(-1, least(1, ((a - q) * ((d - q) * (f - q) - e * e) - b * (b * (f - q) - c * e)
                                      + c * (b * e - c * (d - q))) / (2 * p * p * p)))) / 3 AS phi FROM pca_scale""",
    "pca_values": """
SELECT *, CASE k WHEN 1 THEN q + 2 * p * cos(phi)
                 ELSE 3 * q - 2 * q - 2 * p * cos(phi) - 2 * p * cos(phi + 2 * pi() / 3) END AS value
FROM pca_angle, (SELECT unnest([1, 2]) AS k)""",
    "pca_crossed": """
SELECT k, value / (3 * q) AS share, unnest([
  [b * e - c * (d - value), c * b - (a - value) * e, (a - value) * (d - value) - b * b],
  [b * (f - value) - c * e, c * c - (a - value) * (f - value), (a - value) * e - b * c],
  [(d - value) * (f - value) - e * e, e * c - b * (f - value), b * e - (d - value) * c]]) AS w FROM pca_values""",
    "pca_vectors": """
SELECT k, share, list_transform(w, lambda u: u / (CASE WHEN greatest(w[1], w[2], w[3]) >= -least(w[1], w[2], w[3])
                                                 THEN 1 ELSE -1 END * sqrt(w[1] * w[1] + w[2] * w[2] + w[3] * w[3]))) AS vector
FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY w[1] * w[1] + w[2] * w[2] + w[3] * w[3] DESC) AS place
      FROM pca_crossed) WHERE place = 1""",
    "ordfreq": "SELECT CustomerID, count(DISTINCT InvoiceNo) AS x FROM sales GROUP BY CustomerID",
    "prodinv": "SELECT InvoiceNo, count(DISTINCT StockCode) AS x FROM sales GROUP BY InvoiceNo",
    "ordval": f"SELECT InvoiceNo, {exact('TotalAmount')} AS x FROM sales GROUP BY InvoiceNo",
    "custrev": f"SELECT CustomerID, {exact('TotalAmount')} AS x FROM sales GROUP BY CustomerID",
    "fence": """
SELECT q1 - 1.5::DOUBLE * (q3 - q1) AS lower_fence, q3 + 1.5::DOUBLE * (q3 - q1) AS upper_fence
FROM (SELECT quantile_cont(TotalAmount, 0.25) AS q1, quantile_cont(TotalAmount, 0.75) AS q3 FROM sales)""",
}


def with_ctes(body: str, local: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the expressions it names, directly or through others."""
    known = {**CTES, **(local or {})}
    needed: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"\b[a-z_0-9]+\b", text)):
            if word in known and word not in needed:
                needed.add(word)
                visit(known[word])

    visit(body)
    parts = [f"{name} AS ({sql.strip()})" for name, sql in known.items() if name in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body.strip()


def histogram(values: str, bins: int, extra: str = "") -> str:
    """``values`` selects the column x; returns bin, lo, hi, n and optional further columns."""
    local = {
        "hv": f"SELECT CAST(x AS DOUBLE) AS x FROM ({values}) WHERE x IS NOT NULL",
        "he": f"""SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5::DOUBLE ELSE min(x) END AS f,
  (CASE WHEN min(x) = max(x) THEN 1.0::DOUBLE ELSE max(x) - min(x) END) / {bins}.0::DOUBLE AS w FROM hv""",
        "hc": f"SELECT CAST(least(floor((x - f) / w), {bins - 1}) AS INT) AS bin, count(*) AS n FROM hv, he GROUP BY 1",
    }
    body = f"""SELECT CAST(i AS INT) AS bin, round(f + i * w, 6) AS lo, round(f + (i + 1) * w, 6) AS hi, coalesce(n, 0) AS n{extra}
FROM he CROSS JOIN range({bins}) t(i) LEFT JOIN hc ON hc.bin = i"""
    return with_ctes(body, local)
