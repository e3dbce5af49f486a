"""Rows and paths shared by the retail tests. (Not in conftest.py: two folders have one, so its name is ambiguous.)"""

SF_SMALL = "/root/testdata/sf0.001"

# Edge rows (FIXTURES.md §3): Invoice, StockCode, Description, Quantity,
# InvoiceDate, Price, Customer ID, Country.
EDGE_ROWS = [
    ("489434", "85048", " glass lights ", 12, "1/12/2009 7:45", "6,95", "13085", "United Kingdom"),
    ("489434", "22041", "GLASS LIGHTS", 2, "01/12/2009 07:45", "1,25", "13085", "United Kingdom"),
    ("C489449", "22087", "glass lights", -12, "02/12/2009 10:33", "2,95", "16321", "Australia"),
    ("489450", "POST", "Postage", 1, "31/12/2009 10:59", "18", None, "EIRE"),
    ("489451", "M", "BANK CHARGES", 1, "04/01/2010 05:10", "15", "13086", "Unspecified"),
    ("489452", "D", "Discount", 0, "04/01/2010 12:59", "10,5", "13086", "EIRE"),
    ("489453", "21111", None, 5, "04/01/2010 13:00", "0", None, "Germany"),
    ("489454", "21112", "   ", 3, "05/02/2010 17:00", "2", "13087", "Germany"),
    ("489455", "21113", "carriage", 1, "05/02/2010 21:00", "n/a", "13087", "France"),
    ("489456", "21114", "box", None, "05/02/2010 09:00", "1", "13087", "France"),
    ("489457", "21115", "box", 4, None, "1", "13087", "France"),
    ("489458", "21116", "box", -2, "06/03/2010 08:59", "1,5", None, "Germany"),
    ("C489459", "21117", "box", 1, "06/03/2010 20:30", "3", "13088", "United Kingdom"),
]
