"""Schemas and fixed values of the retail data model.

Everything in this module is data, not logic: the raw and cleaned column
contracts, and the constants whose exact text decides results (labels,
category rules, missing-value tokens, the country centroid dimension).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column contracts
# ---------------------------------------------------------------------------

#: Raw invoice-line file: ``;``-separated, header, UTF-8, decimal-comma price.
#: Declared instead of inferred: inference costs a full extra scan and lets
#: ``Invoice`` / ``Customer ID`` drift between int and string.
RAW = T.StructType(
    [
        T.StructField("Invoice", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.StringType()),
        T.StructField("Price", T.StringType()),
        T.StructField("Customer ID", T.StringType()),
        T.StructField("Country", T.StringType()),
    ]
)

RAW_COLUMNS = [f.name for f in RAW.fields]

#: Cleaned table, 14 columns in this exact order.
CLEAN = T.StructType(
    [
        T.StructField("Invoice", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("DescriptionCleaned", T.StringType()),
        T.StructField("ProductCategory", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.StringType()),
        T.StructField("UnitPrice", T.DoubleType()),
        T.StructField("CustomerID", T.StringType()),
        T.StructField("Country", T.StringType()),
        T.StructField("TotalSales", T.DoubleType()),
        T.StructField("IsReturn", T.BooleanType()),
        T.StructField("IsCancellation", T.BooleanType()),
        T.StructField("HasCustomerID", T.BooleanType()),
    ]
)

CLEAN_COLUMNS = [f.name for f in CLEAN.fields]

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------

# Product category rules, checked in this order on the cleaned description;
# the first match wins. ("contains", text, category) or ("equals", text, category).
CATEGORY_RULES = [
    ("contains", "POSTAGE", "SERVICE_SHIPPING"),
    ("contains", "BANK CHARGES", "SERVICE_FEES"),
    ("contains", "DISCOUNT", "SERVICE_DISCOUNT"),
    ("contains", "CARRIAGE", "SERVICE_SHIPPING"),
    ("equals", "UNKNOWN", "UNKNOWN"),
]
CATEGORY_DEFAULT = "PRODUCT"
UNKNOWN_DESCRIPTION = "UNKNOWN"

# Description markers used by the data-quality report.
ISSUE_MARKERS = ["POSTAGE", "BANK CHARGES"]

# Day parts by hour: [start, end) and label; hours outside every range get the
# last label.
DAY_PARTS = [
    (6, 9, "🌅 Madrugada (6-9h)"),
    (9, 13, "☀️ Mañana (9-13h)"),
    (13, 17, "🌤️ Tarde (13-17h)"),
    (17, 21, "🌆 Noche (17-21h)"),
]
DAY_PART_OTHER = "🌙 Fuera de horario"

# Price classes for the price scatter. The extreme label embeds the quantile
# threshold rounded to a whole number: prefix + threshold + suffix.
PRICE_CLASS_ZERO = "🚫 Precio = $0"
PRICE_CLASS_EXTREME_PREFIX = "📈 Precio extremo (>$"
PRICE_CLASS_EXTREME_SUFFIX = ")"
PRICE_CLASS_NORMAL = "✅ Normal"

# Ticket verdict labels and the band (percent) around the global ticket.
VERDICT_HIGHER = "higher"
VERDICT_LOWER = "lower"
VERDICT_SIMILAR = "similar"
VERDICT_BAND = 10.0

# Text that pandas' CSV reader turns into a missing value by default. The
# cleaned table reaches the dashboard through CSV, so these become NULL.
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# Default dashboard parameters.
DEFAULT_COUNTRY = "Australia"
HOME_MARKET = "United Kingdom"
PARETO_TOP_N = 10
PARETO_THRESHOLD = 80.0
PRICE_QUANTILE = 0.80
SAMPLE_SIZE = 5000
SAMPLE_SEED = 42
MOVING_AVERAGE_WIDTH = 3
HOLIDAY_MONTHS_PATTERN = "-11|-12"

# Country centroids (country, latitude, longitude): 38 entries.
COUNTRY_CENTROIDS = [
    ("United Kingdom", 55.3781, -3.4360),
    ("Germany", 51.1657, 10.4515),
    ("France", 46.2276, 2.2137),
    ("Netherlands", 52.1326, 5.2913),
    ("Spain", 40.4637, -3.7492),
    ("Belgium", 50.5039, 4.4699),
    ("Switzerland", 46.8182, 8.2275),
    ("Portugal", 39.3999, -8.2245),
    ("Australia", -25.2744, 133.7751),
    ("Norway", 60.4720, 8.4689),
    ("Sweden", 60.1282, 18.6435),
    ("Denmark", 56.2639, 9.5018),
    ("Finland", 61.9241, 25.7482),
    ("Austria", 47.5162, 14.5501),
    ("Italy", 41.8719, 12.5674),
    ("Japan", 36.2048, 138.2529),
    ("Singapore", 1.3521, 103.8198),
    ("United States", 37.0902, -95.7129),
    ("Canada", 56.1304, -106.3468),
    ("Brazil", -14.2350, -51.9253),
    ("EIRE", 53.1424, -7.6921),
    ("Cyprus", 35.1264, 33.4299),
    ("Greece", 39.0742, 21.8243),
    ("Iceland", 64.9631, -19.0208),
    ("Israel", 31.0461, 34.8516),
    ("Lebanon", 33.8547, 35.8623),
    ("Malta", 35.9375, 14.3754),
    ("Poland", 51.9194, 19.1451),
    ("Czech Republic", 49.8175, 15.4730),
    ("Hungary", 47.1625, 19.5033),
    ("Lithuania", 55.1694, 23.8813),
    ("Latvia", 56.8796, 24.6032),
    ("Estonia", 58.5953, 25.0136),
    ("RSA", -30.5595, 22.9375),
    ("Bahrain", 26.0667, 50.5577),
    ("United Arab Emirates", 23.4241, 53.8478),
    ("Saudi Arabia", 23.8859, 45.0792),
    ("Hong Kong", 22.3193, 114.1694),
]

GEO = T.StructType(
    [
        T.StructField("Country", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
    ]
)
