from tallybook.operators import cleaning, quality
from tallybook.schemas import RAW_SCHEMA

WHEN = "2010-12-01 08:26:00"


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_SCHEMA)


def line(invoice, stock, name, quantity, price, customer="17850", when=WHEN, country="United Kingdom"):
    return (invoice, stock, name, quantity, when, price, customer, country)


def test_gate(spark):
    df = raw(
        spark,
        line("536365", "85123A", "Candle", "10", "2.55"),
        line("C536366", "71053", "Cup", "-2", "3.39"),
        line("536367", "22423", "Plate", "-5", "1.25"),
        line("536368", "84029E", "Napkin", "0", "0.0"),
        line("", "84029G", "Bowl", "4", "4.50"),
        line(None, "84029G", "Bowl", "4", "4.50"),
        line("1", " nan ", "Bowl", "4", "4.50"),
        line("2", "x", "Bowl", "4", "4.50", when="soon"),
        line("3", "x", "Bowl", "60000", "4.50"),
        line("c4", "x", "Bowl", "3", "50000"),
        line("5", "x", "Bowl", "3", "50000.01"),
        line("6", "x", "Bowl", "nan", "nan"),
        line("7", "x", "Bowl", "nan", "1"),
    )
    clean, rejected, summary = quality.validate_batch(df, "b1")
    assert {r["InvoiceNo"] for r in clean.collect()} == {"536365", "C536366", "c4"}
    reasons = {(r["InvoiceNo"], r["rejection_reason"]) for r in rejected.collect()}
    assert reasons == {
        ("536367", "INVALID_OR_ZERO_QUANTITY"), ("536368", "INVALID_OR_ZERO_UNIT_PRICE"),
        ("", "NULL_OR_EMPTY_INVOICE_NO"), (None, "NULL_OR_EMPTY_INVOICE_NO"), ("1", "NULL_OR_EMPTY_STOCK_CODE"),
        ("2", "INVALID_INVOICE_DATE_FORMAT"), ("3", "INVALID_OR_ZERO_QUANTITY"), ("5", "INVALID_OR_ZERO_UNIT_PRICE"),
        ("6", "INVALID_OR_ZERO_UNIT_PRICE"), ("7", "INVALID_OR_ZERO_QUANTITY")}
    got = summary.first()
    assert (got["total_records"], got["valid_records"], got["rejected_records"]) == (13, 3, 10)
    assert float(got["pass_rate_pct"]) == 23.08


def test_empty_batch_has_rate_zero(spark):
    assert float(quality.validate_batch(raw(spark), "b")[2].first()["pass_rate_pct"]) == 0.0


def test_clean_and_transform(spark):
    df = raw(
        spark,
        line("536365", " 85123a ", "Candle ", "10", "2.55"),
        line("536365", "85123A", "Candle", "10", "2.55"),
        line("C536366", "71053", None, "-2", "3.39", customer=None, when="2010-12-01 08:30:00", country=None),
        line("9", "z", "half", "0.5", "1", customer="abc"),
    )
    rows = {r["InvoiceNo"]: r for r in cleaning.clean_and_transform(df, "b").collect()}
    assert len(rows) == 3
    cancelled = rows["C536366"]
    assert cancelled["is_cancelled"] and float(cancelled["total_amount"]) == -6.78
    assert (cancelled["Description"], cancelled["Country"], cancelled["customer_id"]) == (
        "UNKNOWN_PRODUCT", "United Kingdom", 0)
    assert rows["536365"]["Description"] == "CANDLE" and rows["536365"]["date_key"] == 20101201
    assert rows["9"]["Quantity"] == 0 and rows["9"]["customer_id"] == 0


def test_first_copy_in_file_order_stays(spark, tmp_path):
    from tallybook.sources.readers import read_batch

    rows = [line("1", "a", n, "1", "1") for n in ("second name", "first name", "a name")]
    raw(spark, *rows).coalesce(1).write.parquet(f"{tmp_path}/lines.parquet")
    stored = read_batch(spark, f"{tmp_path}/lines.parquet", with_source=True)
    got = cleaning.clean_and_transform(quality.clean_lines(stored), "b").collect()
    assert [r["Description"] for r in got] == ["SECOND NAME"]
