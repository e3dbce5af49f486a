"""DuckDB SQL twin of every registered query (the correctness oracle).

Each statement runs on the test tables registered as views (``lineitem``,
``orders``, ``customer``, ``part``, ...) and rebuilds the same layers in
plain SQL: raw view -> clean -> typed -> sales. Written by hand, it shares
no code path with the Spark plans; only fixed values (country names,
NA tokens) are reused as data. File round trips are checked against the
table that was written (the round trip must be lossless for these rows).
"""

from __future__ import annotations

from .schema import NA_TOKENS
from .sources.fixture import NATION_COUNTRIES


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_NATIONS = ", ".join(f"({i}, {_q(n)})" for i, n in enumerate(NATION_COUNTRIES))
_NA = ", ".join(_q(t) for t in NA_TOKENS)


def _na(col: str) -> str:
    return f'CASE WHEN trim("{col}") IN ({_NA}) THEN NULL ELSE trim("{col}") END AS "{col}"'


def units(expr: str) -> str:
    return f"TRY_CAST(round_even(({expr}) * CAST(10000000000 AS DOUBLE), 0) AS HUGEINT)"


def dbl(units_expr: str) -> str:
    """The nearest double of a HUGEINT (a direct cast can round twice)."""
    return f"CAST(CAST({units_expr} AS VARCHAR) AS DOUBLE)"


def money(units_expr: str) -> str:
    return f"({dbl(units_expr)} / CAST(10000000000 AS DOUBLE))"


def he_div(n: str, d: str) -> str:
    """Half-even integer division for non-negative n, positive d."""
    q = f"(CAST({n} AS HUGEINT) // CAST({d} AS HUGEINT))"
    r = f"(CAST({n} AS HUGEINT) - {q} * CAST({d} AS HUGEINT))"
    return (
        f"(CASE WHEN 2 * {r} > CAST({d} AS HUGEINT) OR (2 * {r} = CAST({d} AS HUGEINT) AND {q} % 2 = 1) "
        f"THEN {q} + 1 ELSE {q} END)"
    )


def mean_money(units_sum: str, count: str, decimals: int = 2) -> str:
    step = 10_000_000_000 // (10**decimals)
    return (
        f"(CASE WHEN {count} > 0 THEN CAST({he_div(units_sum, f'({count}) * {step}')} AS DOUBLE) "
        f"/ CAST({10**decimals} AS DOUBLE) END)"
    )


BASE = f"""
nations(nation_key, nation_country) AS (VALUES {_NATIONS}),
raw_all AS (
  SELECT
    CASE WHEN l.l_orderkey % 83 = 0 THEN NULL
         WHEN l.l_orderkey % 25 = 0 THEN 'C' || CAST(l.l_orderkey AS VARCHAR)
         ELSE CAST(l.l_orderkey AS VARCHAR) END AS "Invoice",
    CAST(l.l_partkey AS VARCHAR) AS "StockCode",
    CASE WHEN l.l_partkey % 41 = 0 THEN NULL
         WHEN l.l_partkey % 43 = 0 THEN '   '
         WHEN l.l_partkey % 47 = 0 THEN 'postage'
         WHEN l.l_partkey % 53 = 0 THEN 'BANK CHARGES'
         WHEN l.l_partkey % 59 = 0 THEN ' Discount '
         WHEN l.l_partkey % 61 = 0 THEN 'carriage'
         ELSE '  ' || p.p_name || ' ' END AS "Description",
    CASE WHEN l.l_linenumber = 7 AND l.l_orderkey % 71 = 0 THEN NULL
         WHEN l.l_linenumber = 6 AND l.l_orderkey % 67 = 0 THEN 0
         WHEN l.l_orderkey % 25 = 0 OR (l.l_linenumber = 1 AND l.l_orderkey % 40 = 1)
           THEN -CAST(l.l_quantity AS INTEGER)
         ELSE CAST(l.l_quantity AS INTEGER) END AS "Quantity",
    CASE WHEN l.l_linenumber = 5 AND l.l_orderkey % 73 = 0 THEN NULL ELSE
      printf('%s%d/%d/%s %d:%02d',
        CASE WHEN l.l_linenumber = 2 AND l.l_orderkey % 97 = 0 THEN '+' ELSE '' END,
        day(o.o_orderdate), month(o.o_orderdate),
        CASE WHEN l.l_linenumber = 4 AND l.l_orderkey % 79 = 0 THEN CAST(year(o.o_orderdate) % 100 AS VARCHAR)
             WHEN l.l_linenumber = 3 AND l.l_orderkey % 89 = 0 THEN year(o.o_orderdate) || '0'
             ELSE CAST(year(o.o_orderdate) AS VARCHAR) END,
        5 + l.l_orderkey % 9 + l.l_orderkey % 8 + CASE WHEN l.l_orderkey % 31 = 0 THEN l.l_linenumber % 2 ELSE 0 END,
        l.l_orderkey % 60) END AS "InvoiceDate",
    CASE WHEN l.l_partkey % 101 = 0 THEN 'n/a'
         WHEN l.l_partkey % 97 = 0 THEN '0'
         WHEN l.l_partkey % 89 = 0 THEN printf('0,0000%d', l.l_partkey % 9 + 1)
         WHEN l.l_partkey % 83 = 0 THEN printf('%d,123456', l.l_partkey % 50)
         ELSE printf('%d,%02d', 900 + l.l_partkey % 113, l.l_partkey % 100) END AS "Price",
    CASE WHEN o.o_custkey % 4 = 0 THEN NULL ELSE CAST(o.o_custkey AS VARCHAR) END AS "Customer ID",
    CASE WHEN c.c_custkey % 10 < 7 THEN 'United Kingdom' ELSE n.nation_country END AS "Country",
    md5(concat_ws('|', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_partkey AS VARCHAR),
        CAST(l.l_suppkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR),
        CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR),
        CAST(CAST(round(l.l_extendedprice * 100) AS BIGINT) AS VARCHAR))) AS row_key
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nations n ON c.c_nationkey = n.nation_key
  JOIN part p ON l.l_partkey = p.p_partkey
),
clean0 AS (
  SELECT *,
    coalesce(upper(trim("Description")), 'UNKNOWN') AS dc,
    try_cast(replace("Price", ',', '.') AS DOUBLE) AS up
  FROM raw_all
),
clean AS (
  SELECT "Invoice", "StockCode", "Description", dc AS "DescriptionCleaned",
    CASE WHEN contains(dc, 'POSTAGE') THEN 'SERVICE_SHIPPING'
         WHEN contains(dc, 'BANK CHARGES') THEN 'SERVICE_FEES'
         WHEN contains(dc, 'DISCOUNT') THEN 'SERVICE_DISCOUNT'
         WHEN contains(dc, 'CARRIAGE') THEN 'SERVICE_SHIPPING'
         WHEN dc = 'UNKNOWN' THEN 'UNKNOWN'
         ELSE 'PRODUCT' END AS "ProductCategory",
    "Quantity", "InvoiceDate", up AS "UnitPrice", "Customer ID" AS "CustomerID", "Country",
    "Quantity" * up AS "TotalSales",
    coalesce("Quantity" < 0, false) AS "IsReturn",
    coalesce(starts_with("Invoice", 'C'), false) AS "IsCancellation",
    "Customer ID" IS NOT NULL AS "HasCustomerID",
    row_key
  FROM clean0
),
typed0 AS (
  SELECT {_na("Invoice")}, {_na("StockCode")}, {_na("Description")}, {_na("DescriptionCleaned")},
    {_na("ProductCategory")}, "Quantity",
    CASE WHEN regexp_full_match("InvoiceDate", '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}} [0-9]{{1,2}}:[0-9]{{1,2}}')
         THEN try_strptime("InvoiceDate", '%d/%m/%Y %H:%M') END AS "InvoiceDate",
    CASE WHEN isnan("UnitPrice") THEN NULL ELSE "UnitPrice" END AS "UnitPrice",
    {_na("CustomerID")}, {_na("Country")},
    CASE WHEN isnan("TotalSales") THEN NULL ELSE "TotalSales" END AS "TotalSales",
    "IsReturn", "IsCancellation", "HasCustomerID", row_key
  FROM clean
),
typed AS (
  SELECT * FROM typed0
  WHERE "TotalSales" IS NOT NULL AND "Quantity" IS NOT NULL AND "InvoiceDate" IS NOT NULL
),
sales AS (
  SELECT *, strftime("InvoiceDate", '%Y-%m') AS ym, {units('"TotalSales"')} AS tu
  FROM typed WHERE NOT "IsReturn"
)
"""

RAW_COLS = '"Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID", "Country"'
CLEAN_COLS = (
    '"Invoice", "StockCode", "Description", "DescriptionCleaned", "ProductCategory", "Quantity", '
    '"InvoiceDate", "UnitPrice", "CustomerID", "Country", "TotalSales", "IsReturn", "IsCancellation", '
    '"HasCustomerID"'
)

P80 = '(SELECT quantile_cont("UnitPrice", 0.8) FROM sales)'

DEFAULT_COUNTRY = (
    "(SELECT coalesce(max(CASE WHEN \"Country\" = 'Australia' THEN \"Country\" END), min(\"Country\")) "
    "FROM sales)"
)


def _slice(country: str = DEFAULT_COUNTRY, where: str = '"UnitPrice" > 0') -> str:
    """Slicer base and its invoices, for a country and a condition on the lines."""
    return f"""
slice_base AS (SELECT *, coalesce("Country" = {country}, false) AS mine FROM sales WHERE {where}),
slice_inv AS (
  SELECT "Invoice",
    sum(tu) AS inv_total,
    sum(CASE WHEN mine THEN tu END) AS inv_country,
    sum(CASE WHEN mine THEN "Quantity" END) AS units_country,
    count(*) FILTER (WHERE mine) AS lines_country
  FROM slice_base GROUP BY "Invoice"
),
month_inv AS (
  SELECT ym AS "YearMonth", "Invoice", sum(tu) AS inv_total,
    sum(CASE WHEN mine THEN tu END) AS inv_country,
    count(*) FILTER (WHERE mine) AS lines_country
  FROM slice_base WHERE "Invoice" IS NOT NULL GROUP BY 1, 2
)
"""


COUNTRY_RANK = f"""
country_rev AS (
  SELECT "Country", CAST(sum(tu) AS HUGEINT) AS ru FROM sales WHERE "Country" IS NOT NULL GROUP BY "Country"
),
country_rank AS (
  SELECT "Country", ru,
    row_number() OVER (ORDER BY ru DESC, "Country") AS rnk,
    round_even({dbl('ru')} / {dbl('sum(ru) OVER ()')} * 100, 2) AS pct
  FROM country_rev
),
country_cum AS (
  SELECT *, round_even(sum(pct) OVER (ORDER BY rnk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS cum_pct
  FROM country_rank
)
"""



def _geo_values() -> str:
    from .schema import COUNTRY_CENTROIDS

    return ", ".join(f"({_q(c)}, CAST({lat} AS DOUBLE), CAST({lon} AS DOUBLE))" for c, lat, lon in COUNTRY_CENTROIDS)


GEO = f"""
geo("Country", lat, lon) AS (VALUES {_geo_values()}),
mapped AS (
  SELECT r."Country", r.ru, g.lat, g.lon FROM country_rev r JOIN geo g ON r."Country" = g."Country"
)
"""

HOURLY = f"""
hourly AS (
  SELECT CAST(hour("InvoiceDate") AS INTEGER) AS hour,
    count(DISTINCT "Invoice") AS invoices,
    CAST(sum(tu) AS HUGEINT) AS ru,
    CAST(sum("Quantity") AS BIGINT) AS units
  FROM sales GROUP BY 1
),
hourly_dp AS (
  SELECT *, CASE WHEN hour >= 6 AND hour < 9 THEN '🌅 Madrugada (6-9h)'
                 WHEN hour >= 9 AND hour < 13 THEN '☀️ Mañana (9-13h)'
                 WHEN hour >= 13 AND hour < 17 THEN '🌤️ Tarde (13-17h)'
                 WHEN hour >= 17 AND hour < 21 THEN '🌆 Noche (17-21h)'
                 ELSE '🌙 Fuera de horario' END AS day_part
  FROM hourly
)
"""

MONTHLY = """
monthly AS (
  SELECT ym AS "YearMonth", CAST(sum(tu) AS HUGEINT) AS ru, count(DISTINCT "Invoice") AS invoices
  FROM sales GROUP BY 1
)
"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip().rstrip(",") for p in (BASE, *parts))


def _desc_row(col: str, numeric: bool) -> str:
    c = f'"{col}"'
    if numeric:
        return (
            f"SELECT '{col}' AS \"column\", count({c}) AS \"count\", round(avg({c}), 6) AS mean, "
            f"round(stddev_samp({c}), 6) AS stddev, CAST(min({c}) AS VARCHAR) AS \"min\", "
            f"CAST(max({c}) AS VARCHAR) AS \"max\" FROM raw_all"
        )
    return (
        f"SELECT '{col}' AS \"column\", count({c}) AS \"count\", CAST(NULL AS DOUBLE) AS mean, "
        f"CAST(NULL AS DOUBLE) AS stddev, min({c}) AS \"min\", max({c}) AS \"max\" FROM raw_all"
    )


def _signed_pct(x: str) -> str:
    return f"printf('%+.1f%%', {x})"


def oracle_sql() -> dict[str, str]:
    raw_cols = ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID", "Country"]
    q: dict[str, str] = {}

    q["csv_roundtrip_raw"] = f"{_with()} SELECT {RAW_COLS} FROM raw_all"
    q["csv_roundtrip_clean"] = f"""{_with()}
SELECT "Invoice", "StockCode",
  CASE WHEN trim("Description") = '' THEN NULL ELSE trim("Description") END AS "Description",
  CASE WHEN "DescriptionCleaned" = '' THEN NULL ELSE "DescriptionCleaned" END AS "DescriptionCleaned",
  "ProductCategory", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country", "TotalSales",
  "IsReturn", "IsCancellation", "HasCustomerID"
FROM clean"""
    q["parquet_roundtrip"] = f"{_with()} SELECT {CLEAN_COLS} FROM clean"
    q["clean_retail"] = f"{_with()} SELECT {CLEAN_COLS} FROM clean"

    q["raw_preview"] = f"{_with()} SELECT {RAW_COLS} FROM raw_all ORDER BY row_key LIMIT 5"
    q["row_count"] = f"{_with()} SELECT count(*) AS total FROM raw_all"
    q["null_counts"] = f"{_with()} SELECT " + ", ".join(
        f'count(*) FILTER (WHERE "{c}" IS NULL) AS "{c}"' for c in raw_cols
    ) + " FROM raw_all"
    q["describe_columns"] = f"{_with()} " + " UNION ALL ".join(
        _desc_row(c, c == "Quantity") for c in raw_cols
    )
    q["returns_summary"] = f"""{_with()}
SELECT total, returns, cancellations,
  round(returns / total * 100, 6) AS returns_pct,
  round(cancellations / total * 100, 6) AS cancellations_pct
FROM (SELECT count(*) AS total, count(*) FILTER (WHERE "IsReturn") AS returns,
             count(*) FILTER (WHERE "IsCancellation") AS cancellations FROM clean)"""
    q["returns_impact"] = f"""{_with()}
SELECT {money('w')} AS revenue_with_returns, {money('wo')} AS revenue_without_returns,
  {money('w - wo')} AS returns_impact
FROM (SELECT CAST(sum({units('"TotalSales"')}) AS HUGEINT) AS w,
             CAST(sum({units('"TotalSales"')}) FILTER (WHERE "Quantity" > 0) AS HUGEINT) AS wo FROM clean)"""
    q["customer_coverage"] = f"""{_with()}
SELECT with_customer, without_customer,
  round(with_customer / total * 100, 6) AS with_customer_pct,
  round(without_customer / total * 100, 6) AS without_customer_pct
FROM (SELECT count(*) AS total, count(*) FILTER (WHERE "HasCustomerID") AS with_customer,
             count(*) FILTER (WHERE NOT "HasCustomerID") AS without_customer FROM clean)"""
    q["customer_sales_share"] = f"""{_with()}
SELECT {money('w')} AS sales_with_customer, {money('wo')} AS sales_without_customer,
  round({dbl('w')} / {dbl('(w + wo)')} * 100, 6) AS with_customer_pct,
  round({dbl('wo')} / {dbl('(w + wo)')} * 100, 6) AS without_customer_pct
FROM (SELECT CAST(sum({units('"TotalSales"')}) FILTER (WHERE "HasCustomerID" AND "Quantity" > 0) AS HUGEINT) AS w,
             CAST(sum({units('"TotalSales"')}) FILTER (WHERE NOT "HasCustomerID" AND "Quantity" > 0) AS HUGEINT) AS wo
      FROM clean)"""
    q["description_issues"] = f"""{_with()}
SELECT "Description" FROM (
  SELECT DISTINCT "Description" FROM raw_all
  WHERE "Description" IS NULL OR "Description" = '' OR contains("Description", 'POSTAGE')
     OR contains("Description", 'BANK CHARGES'))
ORDER BY "Description" NULLS FIRST LIMIT 20"""
    q["category_distribution"] = f"""{_with()}
SELECT "ProductCategory", count(*) AS count FROM clean GROUP BY 1 ORDER BY 2 DESC, 1"""
    q["sales_view_counts"] = f"""{_with()}
SELECT (SELECT count(*) FROM clean) AS rows_loaded, (SELECT count(*) FROM typed) AS rows_typed,
       (SELECT count(*) FROM sales) AS rows_sales"""

    q["kpi_headline"] = f"""{_with()}
SELECT {money('rev')} AS revenue, units, invoices,
  coalesce({mean_money('rev', 'invoices')}, 0.0) AS avg_ticket, lines, products
FROM (SELECT CAST(coalesce(sum(tu), 0) AS HUGEINT) AS rev, CAST(coalesce(sum("Quantity"), 0) AS BIGINT) AS units,
             count(DISTINCT "Invoice") AS invoices, count(*) AS lines,
             count(DISTINCT "StockCode") AS products FROM sales)"""
    q["kpi_secondary"] = f"""{_with()}
SELECT (SELECT count(DISTINCT "CustomerID") FROM sales WHERE "HasCustomerID") AS customers,
  (SELECT round((count(*) FILTER (WHERE "IsReturn")) / count(*) * 100, 6) FROM typed) AS return_rate,
  (SELECT count(DISTINCT "Country") FROM sales) AS countries,
  (SELECT {mean_money(f'CAST(sum({units(chr(34) + "UnitPrice" + chr(34))}) AS HUGEINT)', 'count("UnitPrice")', 4)}
   FROM sales) AS mean_price"""
    q["sales_time_attributes"] = f"""{_with()}
SELECT CAST(year("InvoiceDate") AS INTEGER) AS "Year", CAST(month("InvoiceDate") AS INTEGER) AS "Month",
  strftime("InvoiceDate", '%b') AS "MonthName", ym AS "YearMonth", count(*) AS lines
FROM sales GROUP BY 1, 2, 3, 4 ORDER BY "YearMonth" """
    q["daily_revenue"] = f"""{_with()}
SELECT CAST("InvoiceDate" AS DATE) AS "Fecha", {money('CAST(sum(tu) AS HUGEINT)')} AS revenue
FROM sales GROUP BY 1 ORDER BY 1"""
    q["top_countries"] = f"""{_with(COUNTRY_RANK)}
SELECT "Country", {money('ru')} AS revenue FROM country_rev ORDER BY ru DESC, "Country" LIMIT 10"""
    q["top_products"] = f"""{_with()}
SELECT product, {money('rev')} AS revenue, quantity FROM (
  SELECT "DescriptionCleaned" AS product, CAST(sum(tu) AS HUGEINT) AS rev,
         CAST(sum("Quantity") AS BIGINT) AS quantity
  FROM sales WHERE "DescriptionCleaned" IS NOT NULL GROUP BY 1)
ORDER BY rev DESC, product LIMIT 15"""

    q["price_outlier_summary"] = f"""{_with()}
SELECT count(*) FILTER (WHERE "UnitPrice" = 0) AS zero_price_rows,
  round({P80}, 6) AS p80,
  count(*) FILTER (WHERE "UnitPrice" > {P80}) AS rows_above_p80,
  max("UnitPrice") AS max_price
FROM sales"""
    q["zero_price_products"] = f"""{_with()}
SELECT product, lines, quantity, countries FROM (
  SELECT "DescriptionCleaned" AS product, count("Invoice") AS lines,
         CAST(sum("Quantity") AS BIGINT) AS quantity, count(DISTINCT "Country") AS countries
  FROM sales WHERE "UnitPrice" = 0 AND "DescriptionCleaned" IS NOT NULL GROUP BY 1)
ORDER BY lines DESC, product LIMIT 15"""
    q["high_price_products"] = f"""{_with()}
SELECT product, round_even(mx, 2) AS max_price, {mean_money('pu', 'n', 2)} AS mean_price, lines FROM (
  SELECT "DescriptionCleaned" AS product, max("UnitPrice") AS mx,
         CAST(sum({units('"UnitPrice"')}) AS HUGEINT) AS pu, count(*) AS n, count("Invoice") AS lines
  FROM sales WHERE "UnitPrice" > {P80} AND "DescriptionCleaned" IS NOT NULL GROUP BY 1)
ORDER BY mx DESC, product LIMIT 15"""
    q["price_scatter_sample"] = f"""{_with()}
SELECT "UnitPrice", "Quantity",
  CASE WHEN "UnitPrice" = 0 THEN '🚫 Precio = $0'
       WHEN "UnitPrice" > {P80}
         THEN '📈 Precio extremo (>$' || CAST(CAST(round_even({P80}, 0) AS BIGINT) AS VARCHAR) || ')'
       ELSE '✅ Normal' END AS price_class,
  "DescriptionCleaned", "Country", "Invoice"
FROM sales ORDER BY md5(concat_ws('|', '42', row_key)) LIMIT 5000"""

    q["country_pareto"] = f"""{_with(COUNTRY_RANK)}
SELECT "Country", {money('ru')} AS revenue, pct, cum_pct,
  CAST({he_div('ru', '1000000000000')} AS DOUBLE) / CAST(10 AS DOUBLE) AS revenue_k
FROM country_cum WHERE rnk <= 10 ORDER BY rnk"""
    q["pareto_summary"] = f"""{_with(COUNTRY_RANK)}
SELECT round(top_pct, 2) AS top_n_pct, total_countries, {money('total_units')} AS total_revenue,
  below + 1 AS countries_to_threshold, leader, leader_pct, total_countries - 10 AS remaining_countries,
  round(100 - top_pct, 2) AS remaining_pct
FROM (SELECT sum(pct) FILTER (WHERE rnk <= 10) AS top_pct, count(*) AS total_countries,
             CAST(sum(ru) AS HUGEINT) AS total_units,
             count(*) FILTER (WHERE rnk <= 10 AND cum_pct <= 80.0) AS below,
             max("Country") FILTER (WHERE rnk = 1) AS leader, max(pct) FILTER (WHERE rnk = 1) AS leader_pct
      FROM country_cum)
WHERE total_countries > 0"""
    q["pareto_table"] = f"""{_with(COUNTRY_RANK)}
SELECT "Country", '$' || format('{{:,.2f}}', {money('ru')}) AS revenue_text,
  format('{{:.2f}}', pct) || '%' AS pct_text, format('{{:.2f}}', cum_pct) || '%' AS cum_pct_text,
  format('{{:.1f}}', cum_pct) || '%' AS cum_pct_label,
  '$' || format('{{:.0f}}', CAST({he_div('ru', '1000000000000')} AS DOUBLE) / CAST(10 AS DOUBLE)) || 'K' AS revenue_k_text
FROM country_cum WHERE rnk <= 10 ORDER BY rnk"""

    q["monthly_trend"] = f"""{_with(MONTHLY)}
SELECT "YearMonth", {money('ru')} AS revenue, invoices,
  CASE WHEN count(*) OVER () >= 3 THEN {mean_money(
      'sum(ru) OVER (ORDER BY "YearMonth" ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)',
      'count(*) OVER (ORDER BY "YearMonth" ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)', 2)} END AS moving_avg,
  regexp_matches("YearMonth", '-11|-12') AS is_holiday
FROM monthly ORDER BY "YearMonth" """
    q["monthly_extremes"] = f"""{_with(MONTHLY)}
SELECT b."YearMonth" AS best_month, {money('b.ru')} AS best_revenue,
       w."YearMonth" AS worst_month, {money('w.ru')} AS worst_revenue
FROM (SELECT * FROM monthly ORDER BY ru DESC, "YearMonth" LIMIT 1) b,
     (SELECT * FROM monthly ORDER BY ru ASC, "YearMonth" LIMIT 1) w"""

    q["geo_dimension_present"] = f"""{_with(COUNTRY_RANK, GEO)}
SELECT "Country", lat, lon FROM geo WHERE "Country" IN (SELECT "Country" FROM sales) ORDER BY "Country" """
    q["country_geo"] = f"""{_with(COUNTRY_RANK, GEO)}
SELECT "Country", {money('ru')} AS revenue, lat, lon FROM mapped ORDER BY ru DESC, "Country" """
    q["geo_international"] = f"""{_with(COUNTRY_RANK, GEO)}
SELECT "Country", {money('ru')} AS revenue, lat, lon FROM mapped
WHERE "Country" <> 'United Kingdom' ORDER BY ru DESC, "Country" """
    top3 = f"""
top3 AS (
  SELECT row_number() OVER (ORDER BY ru DESC, "Country") AS position, "Country", ru,
    {dbl('ru')} / {dbl('(SELECT sum(ru) FROM mapped)')} * 100 AS pg,
    {dbl('ru')} / {dbl("(SELECT sum(ru) FROM mapped WHERE \"Country\" <> 'United Kingdom')")} * 100 AS pi
  FROM mapped WHERE "Country" <> 'United Kingdom' ORDER BY ru DESC, "Country" LIMIT 3
)"""
    q["geo_top3"] = f"""{_with(COUNTRY_RANK, GEO, top3)}
SELECT CAST(position AS INTEGER) AS position, "Country", {money('ru')} AS revenue,
  round(pg, 4) AS pct_global, round(pi, 4) AS pct_intl
FROM top3 ORDER BY position"""
    q["geo_top3_names"] = f"""{_with(COUNTRY_RANK, GEO, top3)}
SELECT coalesce(string_agg("Country", ', ' ORDER BY position), '') AS top3_names FROM top3"""

    q["hourly_activity"] = f"""{_with(HOURLY)}
SELECT hour, invoices, {money('ru')} AS revenue, units, day_part,
  invoices = max(invoices) OVER () AS is_peak
FROM hourly_dp ORDER BY hour"""
    q["day_part_summary"] = f"""{_with(HOURLY)}
SELECT day_part, CAST(sum(invoices) AS BIGINT) AS invoices, {money('CAST(sum(ru) AS HUGEINT)')} AS revenue
FROM hourly_dp GROUP BY day_part ORDER BY invoices DESC, day_part"""
    q["peak_hour"] = f"""{_with(HOURLY)}
SELECT hour, day_part, trim(split_part(day_part, '(', 1)) AS day_part_short, invoices,
  (SELECT count(*) FROM hourly_dp WHERE invoices = 0) AS inactive_hours
FROM hourly_dp ORDER BY invoices DESC, hour LIMIT 1"""

    q["slicer_countries"] = f"""{_with()}
SELECT DISTINCT "Country" FROM sales WHERE "Country" IS NOT NULL ORDER BY 1"""
    q["slicer_periods"] = f"""{_with()} SELECT DISTINCT ym AS "YearMonth" FROM sales ORDER BY 1"""
    q["slicer_defaults"] = f"""{_with()}
SELECT {DEFAULT_COUNTRY} AS default_country, min(ym) AS period_from, max(ym) AS period_to
FROM sales HAVING min(ym) IS NOT NULL"""
    tc = f"({dbl('tc_units')} / invoices)"
    tg = f"({dbl('tg_units')} / all_invoices)"
    diff = f"(CASE WHEN coalesce({tg}, 0) > 0 THEN (coalesce({tc}, 0) - {tg}) / {tg} * 100 ELSE 0.0 END)"
    metrics = f"""
SELECT {money('rev')} AS revenue,
  coalesce({mean_money('tc_units', 'invoices')}, 0.0) AS ticket_country,
  coalesce({mean_money('tg_units', 'all_invoices')}, 0.0) AS ticket_global,
  round({diff}, 4) AS diff_pct, round(abs({diff}), 4) AS diff_abs_pct, {_signed_pct(diff)} AS diff_text,
  invoices, units,
  CASE WHEN {diff} > 10 THEN 'higher' WHEN {diff} < -10 THEN 'lower' ELSE 'similar' END AS verdict
FROM (SELECT CAST(sum(inv_country) AS HUGEINT) AS rev,
             CAST(sum(inv_country) FILTER (WHERE "Invoice" IS NOT NULL AND lines_country > 0) AS HUGEINT) AS tc_units,
             count(*) FILTER (WHERE "Invoice" IS NOT NULL AND lines_country > 0) AS invoices,
             CAST(sum(inv_total) FILTER (WHERE "Invoice" IS NOT NULL) AS HUGEINT) AS tg_units,
             count(*) FILTER (WHERE "Invoice" IS NOT NULL) AS all_invoices,
             CAST(sum(units_country) AS BIGINT) AS units, sum(lines_country) AS lines
      FROM slice_inv)
WHERE lines > 0"""
    tickets = f"""
SELECT coalesce(c."YearMonth", g."YearMonth") AS "YearMonth", c.ticket_country, g.ticket_global FROM
  (SELECT "YearMonth", {mean_money('CAST(sum(inv_country) AS HUGEINT)', 'count(*)')} AS ticket_country
   FROM month_inv WHERE lines_country > 0 GROUP BY 1) c
FULL OUTER JOIN
  (SELECT "YearMonth", {mean_money('CAST(sum(inv_total) AS HUGEINT)', 'count(*)')} AS ticket_global
   FROM month_inv GROUP BY 1) g
ON c."YearMonth" = g."YearMonth"
WHERE (SELECT count(*) FROM slice_base WHERE mine) > 0
ORDER BY 1"""
    products = f"""
SELECT product, '$' || format('{{:,.2f}}', {money('rev')}) AS revenue_text, quantity FROM (
  SELECT "DescriptionCleaned" AS product, CAST(sum(tu) AS HUGEINT) AS rev, CAST(sum("Quantity") AS BIGINT) AS quantity
  FROM slice_base WHERE mine AND "DescriptionCleaned" IS NOT NULL GROUP BY 1)
ORDER BY rev DESC, product LIMIT 5"""
    q["slicer_metrics"] = _with(_slice()) + metrics
    q["ticket_monthly"] = _with(_slice()) + tickets
    q["slicer_top_products"] = _with(_slice()) + products
    q["slicer_metrics_period"] = _with(_slice("'Germany'", "ym BETWEEN '1994-03' AND '1996-06'")) + metrics
    q["ticket_monthly_period"] = _with(_slice("'France'", "\"UnitPrice\" > 0 AND ym BETWEEN '1993-07' AND '1997-02'")) + tickets
    q["slicer_top_products_all"] = _with(_slice("'United Kingdom'", "ym >= '1995-01'")) + products
    q["raw_rows"] = f"""{_with()}
SELECT "Invoice", "DescriptionCleaned", "Quantity", "UnitPrice", "TotalSales", "Country", "InvoiceDate"
FROM sales ORDER BY row_key LIMIT 100"""
    return q
