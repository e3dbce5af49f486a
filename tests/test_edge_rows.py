"""Hand-checked expectations on the 13 edge rows of FIXTURES.md §3."""

import pytest

from mercato.plans import countries, geo, hours, kpis, prices, quality, slicer, trends
from mercato.schema import DAY_PART_OTHER


def rows(df):
    return [r.asDict() for r in df.collect()]


def one(df):
    out = rows(df)
    assert len(out) == 1
    return out[0]


def test_clean_schema_and_flags(edge):
    c = edge.clean_table
    assert c.columns == [
        "Invoice", "StockCode", "Description", "DescriptionCleaned", "ProductCategory", "Quantity",
        "InvoiceDate", "UnitPrice", "CustomerID", "Country", "TotalSales", "IsReturn",
        "IsCancellation", "HasCustomerID",
    ]
    by_inv = {r["StockCode"]: r for r in rows(c)}
    assert by_inv["85048"]["DescriptionCleaned"] == "GLASS LIGHTS"
    assert by_inv["85048"]["UnitPrice"] == pytest.approx(6.95)
    assert by_inv["21111"]["DescriptionCleaned"] == "UNKNOWN"
    assert by_inv["21112"]["DescriptionCleaned"] == ""  # blank trims to '' (not UNKNOWN)
    assert by_inv["21112"]["ProductCategory"] == "PRODUCT"
    assert by_inv["21113"]["UnitPrice"] is None  # 'n/a'
    assert by_inv["21114"]["IsReturn"] is False  # NULL quantity is not a return
    assert by_inv["21117"]["IsCancellation"] is True


def test_category_distribution(edge):
    got = {r["ProductCategory"]: r["count"] for r in rows(quality.category_distribution(edge.clean))}
    assert got == {"PRODUCT": 8, "SERVICE_SHIPPING": 2, "SERVICE_FEES": 1, "SERVICE_DISCOUNT": 1, "UNKNOWN": 1}


def test_returns_and_customers(edge):
    r = one(quality.returns_summary(edge.clean))
    assert (r["total"], r["returns"], r["cancellations"]) == (13, 2, 2)
    imp = one(quality.returns_impact(edge.clean))
    assert imp["revenue_with_returns"] == pytest.approx(93.50)
    assert imp["revenue_without_returns"] == pytest.approx(131.90)
    assert imp["returns_impact"] == pytest.approx(-38.40)
    cov = one(quality.customer_coverage(edge.clean))
    assert (cov["with_customer"], cov["without_customer"]) == (10, 3)
    share = one(quality.customer_sales_share(edge.clean))
    assert share["sales_with_customer"] == pytest.approx(113.90)
    assert share["sales_without_customer"] == pytest.approx(18.00)


def test_description_issues(edge):
    got = [r["Description"] for r in rows(quality.description_issues(edge.raw))]
    assert got == [None, "BANK CHARGES"]


def test_sales_view_counts(edge):
    r = one(quality.sales_view_counts(edge.clean))
    assert (r["rows_loaded"], r["rows_typed"], r["rows_sales"]) == (13, 10, 8)
    assert edge.typed.count() == 10 and edge.sales.count() == 8


def test_kpis(edge):
    h = one(kpis.kpi_headline(edge.sales))
    assert h["revenue"] == pytest.approx(127.90)
    assert (h["units"], h["invoices"], h["lines"], h["products"]) == (25, 7, 8, 8)
    assert h["avg_ticket"] == pytest.approx(18.27)
    s = one(kpis.kpi_secondary(edge.typed))
    assert (s["customers"], s["countries"]) == (4, 4)
    assert s["return_rate"] == pytest.approx(20.0)
    assert s["mean_price"] == pytest.approx(7.0875)


def test_price_outliers(edge):
    p = one(prices.price_outlier_summary(edge.sales))
    assert p["zero_price_rows"] == 1
    assert p["p80"] == pytest.approx(13.2)
    assert p["rows_above_p80"] == 2
    assert p["max_price"] == pytest.approx(18.0)


def test_top_products_skip_blank_description(edge):
    got = {r["product"]: r["revenue"] for r in rows(kpis.top_products(edge.sales))}
    assert got == pytest.approx(
        {"GLASS LIGHTS": 85.90, "POSTAGE": 18.0, "BANK CHARGES": 15.0, "BOX": 3.0, "DISCOUNT": 0.0, "UNKNOWN": 0.0}
    )


def test_monthly_trend(edge):
    got = rows(trends.monthly_trend(edge.sales))
    assert [r["YearMonth"] for r in got] == ["2009-12", "2010-01", "2010-02", "2010-03"]
    assert [r["revenue"] for r in got] == pytest.approx([103.90, 15.0, 6.0, 3.0])
    assert [r["invoices"] for r in got] == [2, 3, 1, 1]
    assert [r["moving_avg"] for r in got] == pytest.approx([103.90, 59.45, 41.63, 8.0])
    assert [r["is_holiday"] for r in got] == [True, False, False, False]
    ext = one(trends.monthly_extremes(edge.sales))
    assert (ext["best_month"], ext["worst_month"]) == ("2009-12", "2010-03")


def test_moving_avg_needs_three_months(edge):
    two = edge.sales.filter("InvoiceDate < timestamp_ntz'2010-02-01 00:00:00'")
    assert all(r["moving_avg"] is None for r in rows(trends.monthly_trend(two)))


def test_pareto(edge):
    got = rows(countries.country_pareto(edge.sales))
    assert [r["Country"] for r in got] == ["United Kingdom", "EIRE", "Unspecified", "Germany"]
    assert [r["pct"] for r in got] == pytest.approx([69.51, 14.07, 11.73, 4.69])
    assert [r["cum_pct"] for r in got] == pytest.approx([69.51, 83.58, 95.31, 100.0])
    s = one(countries.pareto_summary(edge.sales))
    assert s["countries_to_threshold"] == 2
    assert s["remaining_countries"] == -6
    assert s["leader"] == "United Kingdom"
    t = rows(countries.pareto_table(edge.sales))
    assert t[0]["revenue_text"] == "$88.90" and t[0]["pct_text"] == "69.51%"


def test_geo(spark, edge):
    intl = {r["Country"]: r["revenue"] for r in rows(geo.geo_international(spark, edge.sales))}
    assert intl == pytest.approx({"EIRE": 18.0, "Germany": 6.0})  # Unspecified is unmapped
    top = rows(geo.geo_top3(spark, edge.sales))
    assert [r["pct_intl"] for r in top] == pytest.approx([75.0, 25.0])
    assert one(geo.geo_top3_names(spark, edge.sales))["top3_names"] == "EIRE, Germany"


def test_hours(edge):
    h = rows(hours.hourly_activity(edge.sales))
    assert [r["hour"] for r in h] == [5, 7, 10, 12, 13, 17, 20]
    assert all(r["invoices"] == 1 for r in h) and all(r["is_peak"] for r in h)
    assert [r["revenue"] for r in h] == pytest.approx([15.0, 85.90, 18.0, 0.0, 0.0, 6.0, 3.0])
    peak = one(hours.peak_hour(edge.sales))
    assert peak["hour"] == 5 and peak["day_part"] == DAY_PART_OTHER
    assert peak["day_part_short"] == "🌙 Fuera de horario" and peak["inactive_hours"] == 0
    parts = {r["day_part"].split(" ")[1]: (r["invoices"], r["revenue"]) for r in rows(hours.day_part_summary(edge.sales))}
    assert parts["Mañana"] == (2, pytest.approx(18.0))
    assert parts["Noche"] == (2, pytest.approx(9.0))
    assert parts["Madrugada"] == (1, pytest.approx(85.90))
    assert parts["Tarde"] == (1, pytest.approx(0.0))


def test_day_part_counts_an_invoice_once_per_hour(spark, edge_raw):
    from mercato.plans.catalog import Retail
    from mercato.plans.clean import clean
    from mercato.schema import RAW

    mini = spark.createDataFrame(
        [
            ("1", "A", "x", 1, "1/1/2010 8:30", "1", "1", "Spain"),
            ("1", "B", "y", 1, "1/1/2010 9:30", "1", "1", "Spain"),
            ("2", "A", "x", 1, "1/1/2010 10:30", "1", "1", "Spain"),
            ("2", "B", "y", 1, "1/1/2010 11:30", "1", "1", "Spain"),
        ],
        RAW,
    )
    r = Retail.from_clean(spark, clean(mini))
    got = {row["day_part"].split(" ")[1]: row["invoices"] for row in rows(hours.day_part_summary(r.sales))}
    assert got == {"Madrugada": 1, "Mañana": 3}


def test_slicer(edge):
    d = one(slicer.slicer_defaults(edge.sales))
    assert (d["default_country"], d["period_from"], d["period_to"]) == ("EIRE", "2009-12", "2010-03")
    m = one(slicer.slicer_metrics(edge.sales, country="Germany"))
    assert m["revenue"] == pytest.approx(6.0)
    assert m["ticket_country"] == pytest.approx(6.0)
    assert m["ticket_global"] == pytest.approx(21.32)
    assert m["diff_pct"] == pytest.approx(-71.853, abs=1e-4)
    assert m["diff_text"] == "-71.9%"
    assert m["verdict"] == "lower"
    assert slicer.slicer_metrics(edge.sales, country="Narnia").count() == 0
    assert slicer.ticket_monthly(edge.sales, country="Narnia").count() == 0
    tm = rows(slicer.ticket_monthly(edge.sales, country="Germany"))
    assert [r["ticket_country"] for r in tm] == [None, None, pytest.approx(6.0), None]


def test_raw_profile(edge_raw):
    r = one(quality.raw_null_counts(edge_raw))
    assert r["Description"] == 1 and r["Quantity"] == 1 and r["Customer ID"] == 3
    d = {x["column"]: x for x in rows(quality.raw_describe(edge_raw))}
    assert d["Quantity"]["count"] == 12 and d["Quantity"]["min"] == "-12" and d["Quantity"]["max"] == "12"
    assert d["Invoice"]["mean"] is None and d["Invoice"]["max"] == "C489459"


def test_price_outliers_approx_option(edge):
    p = one(prices.price_outlier_summary(edge.sales, approx=True))
    assert p["p80"] in (10.5, 15.0, 18.0)  # an actual price, no interpolation
    assert p["zero_price_rows"] == 1
    assert prices.high_price_products(edge.sales, approx=True).count() >= 1


def test_slicer_parameters(edge):
    m = one(slicer.slicer_metrics(edge.sales, country="EIRE", products_only=False))
    # EIRE sells postage (18.00) and a zero-quantity discount line (0.00)
    assert m["revenue"] == pytest.approx(18.0) and m["invoices"] == 2
    assert m["diff_abs_pct"] == pytest.approx(abs(m["diff_pct"]))
    jan = one(slicer.slicer_metrics(edge.sales, country="EIRE", period_from="2010-01", period_to="2010-01",
                                    products_only=False))
    assert jan["revenue"] == pytest.approx(0.0) and jan["invoices"] == 1
    assert slicer.slicer_metrics(edge.sales, country="EIRE", period_from="2010-02", products_only=False).count() == 0
    top = rows(slicer.slicer_top_products(edge.sales, country="EIRE", products_only=False))
    assert [r["product"] for r in top] == ["POSTAGE", "DISCOUNT"]
    assert top[0]["revenue_text"] == "$18.00"


def test_ticket_monthly_keeps_a_country_without_invoices(spark):
    """A country that has only lines without an invoice shows the global months (the reference's guard counts lines)."""
    from mercato.plans import slicer
    from mercato.plans.catalog import Retail
    from mercato.plans.clean import clean
    from mercato.schema import RAW

    rows = [(None, "1", "box", 2, "1/2/2010 9:00", "5", "1", "Spain"), ("10", "1", "box", 4, "1/2/2010 9:00", "5", "1", "France"),
            ("11", "1", "box", 6, "1/3/2010 9:00", "5", "1", "France")]
    r = Retail.from_clean(spark, clean(spark.createDataFrame(rows, RAW)))
    got = [tuple(x) for x in slicer.ticket_monthly(r.sales, country="Spain").collect()]
    assert got == [("2010-02", None, 20.0), ("2010-03", None, 30.0)]
    assert slicer.slicer_metrics(r.sales, country="Spain").first()["revenue"] == 10.0
    assert slicer.ticket_monthly(r.sales, country="Italy").count() == 0
