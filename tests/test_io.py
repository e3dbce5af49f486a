"""File sources/sinks on edge rows, and the streaming form of the cleaning job."""

import os

from retail_rows import EDGE_ROWS
from mercato.plans.clean import clean
from mercato.schema import CLEAN_COLUMNS, RAW
from mercato.session import scratch_path
from mercato.sources.files import (
    read_clean_csv,
    read_parquet,
    read_raw_csv,
    write_clean_csv,
    write_parquet,
    write_raw_csv,
)
from mercato.streaming import clean_incrementally


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))


def test_raw_csv_text_round_trip(spark):
    path = scratch_path(spark, "t-raw")
    with open(_mkdir(path) + "/part-0.csv", "w", encoding="utf-8") as fh:
        fh.write("Invoice;StockCode;Description;Quantity;InvoiceDate;Price;Customer ID;Country\n")
        fh.write('489434;85048;" glass lights ";12;1/12/2009 7:45;6,95;13085;United Kingdom\n')
        fh.write('489453;21111;;5;04/01/2010 13:00;0;;Germany\n')
        fh.write('C489449;22087;"";-12;02/12/2009 10:33;2,95;16321;Australia\n')
    rows = {r["StockCode"]: r for r in read_raw_csv(spark, path).collect()}
    assert rows["21111"]["Description"] is None  # unquoted empty -> NULL
    assert rows["22087"]["Description"] is None  # quoted empty reads back as NULL too
    assert rows["85048"]["Description"] == " glass lights "  # padding kept on read
    assert rows["85048"]["Price"] == "6,95" and rows["85048"]["Quantity"] == 12
    c = {r["StockCode"]: r for r in clean(read_raw_csv(spark, path)).collect()}
    assert c["85048"]["UnitPrice"] == 6.95 and c["85048"]["TotalSales"] == 12 * 6.95
    assert c["22087"]["IsReturn"] and c["22087"]["IsCancellation"]
    assert c["22087"]["DescriptionCleaned"] == "UNKNOWN"


def _mkdir(path):
    os.makedirs(path, exist_ok=True)
    return path


def test_raw_writer_keeps_padding(spark, edge_raw):
    path = scratch_path(spark, "t-raw-w")
    write_raw_csv(edge_raw, path)
    back = read_raw_csv(spark, path)
    assert _sorted(back) == _sorted(edge_raw)


def test_clean_csv_strips_and_nulls_blank_text(spark, edge_raw):
    path = scratch_path(spark, "t-clean-csv")
    cleaned = clean(edge_raw)
    write_clean_csv(cleaned, path, single_file=True)
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) == 1
    back = {r["StockCode"]: r for r in read_clean_csv(spark, path).collect()}
    assert back["85048"]["Description"] == "glass lights"  # writer strips outer spaces
    assert back["21112"]["Description"] is None and back["21112"]["DescriptionCleaned"] is None
    assert back["85048"]["UnitPrice"] == 6.95


def test_parquet_round_trip_is_exact(spark, edge_raw):
    path = scratch_path(spark, "t-parquet")
    cleaned = clean(edge_raw)
    write_parquet(cleaned, path)
    back = read_parquet(spark, path)
    assert back.columns == CLEAN_COLUMNS
    assert _sorted(back) == _sorted(cleaned)


def test_streaming_clean_equals_batch_clean(spark):
    landing = scratch_path(spark, "t-landing")
    out = scratch_path(spark, "t-stream-out")
    ckpt = scratch_path(spark, "t-stream-ckpt")
    write_raw_csv(spark.createDataFrame(EDGE_ROWS[:7], RAW), landing + "/batch1")
    write_raw_csv(spark.createDataFrame(EDGE_ROWS[7:], RAW), landing + "/batch2")
    q = clean_incrementally(spark, landing + "/*", out, ckpt)
    q.awaitTermination(120)
    streamed = read_parquet(spark, out)
    batch = clean(spark.createDataFrame(EDGE_ROWS, RAW))
    assert _sorted(streamed) == _sorted(batch)
