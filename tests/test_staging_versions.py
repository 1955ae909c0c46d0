"""Versioned staging, the gate from write metrics, broken CSV rows, money text, title case."""

import os
import unicodedata

import pytest
from pyspark.sql import functions as F

from tradewind.functions import title_case
from tradewind.operators import quality
from tradewind.operators.staging import clean_order_items
from tradewind.plans import pipeline
from tradewind.sources import csv as csv_source
from tradewind.sources.tables import RawMarketplace
from tradewind.sources.testdata import load_raw_testdata

SF = "/root/testdata/sf0.001"
NO_LIMITS = {k: 0 for k in quality.MIN_ROWS}


def _raw(spark, price="10.5", purchase="2020-01-01 10:00:00"):
    text = lambda rows, names: spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names.split()))
    times = "order_purchase_timestamp order_approved_at order_delivered_carrier_date order_delivered_customer_date " \
            "order_estimated_delivery_date"
    return RawMarketplace(
        sellers=text([("s", "1", "city", "sp")], "seller_id seller_zip_code_prefix seller_city seller_state"),
        products=text([("p", "c", *["1"] * 5)], "product_id product_category_name product_weight_g product_length_cm "
                                                "product_height_cm product_width_cm product_photos_qty"),
        category_translation=text([("c", "C")], "product_category_name product_category_name_english"),
        orders=text([("o", "k", "delivered", purchase, None, None, None, None)], f"order_id customer_id order_status {times}"),
        order_items=text([("o", "1", "p", "s", price, "1")], "order_id order_item_id product_id seller_id price freight_value"),
        order_payments=text([("o", "1", "card", "1", "11.5")], "order_id payment_sequential payment_type "
                                                               "payment_installments payment_value"),
        customers=text([("k", "u", "00001", "city", "sp")], "customer_id customer_unique_id customer_zip_code_prefix "
                                                            "customer_city customer_state"),
        geolocation=text([("00001", "1.0", "2.0")], "geolocation_zip_code_prefix geolocation_lat geolocation_lng"))


def _price(spark):
    return float(spark.table("staging.order_items").first().price)


# ---------------------------------------------------------------- A4

def test_a_failed_rebuild_leaves_the_published_version(spark, tmp_path):
    first = pipeline.write_staging(spark, _raw(spark, "10.5"), str(tmp_path))
    assert _price(spark) == 10.5
    with pytest.raises(Exception, match="needs more digits"):
        pipeline.write_staging(spark, _raw(spark, "0.00000001"), str(tmp_path))
    assert _price(spark) == 10.5
    assert os.listdir(f"{tmp_path}/staging") == [first.database]          # the broken version is gone


def test_versions_do_not_meet_and_old_ones_go(spark, tmp_path):
    runs = [pipeline.write_staging(spark, _raw(spark, p), str(tmp_path), publish=False) for p in ("1", "2", "3")]
    assert len({r.database for r in runs}) == 3
    for r, p in zip(runs, (1.0, 2.0, 3.0)):
        assert float(pipeline.read_staging(spark, r.database).order_items.first().price) == p
    for r, p in zip(runs, (1.0, 2.0, 3.0)):
        pipeline.publish_staging(spark, r)
        assert _price(spark) == p
    # The published version and the one before stay.
    assert sorted(os.listdir(f"{tmp_path}/staging")) == sorted(r.database for r in runs[1:])


# ---------------------------------------------------------------- L1-L5, L7

@pytest.mark.parametrize("raw, said", [({"price": "0"}, "nonpositive_or_null_price=1"), ({"price": "NaN"}, "nonpositive_or_null_price=1"),
                                       ({"purchase": "soon"}, "null_purchase_timestamp=1")])
def test_a_failing_metric_stops_the_run_before_any_mart(spark, tmp_path, raw, said):
    pipeline.write_staging(spark, _raw(spark, "7"), str(tmp_path / "old"))
    with pytest.raises(quality.QualityGateError, match=said) as e:
        pipeline.run_pipeline(spark, _raw(spark, **raw), str(tmp_path / "new"), min_rows=NO_LIMITS)
    assert not os.path.exists(tmp_path / "new" / "exports") and _price(spark) == 7.0
    assert spark.catalog.databaseExists(str(e.value).rsplit(" ", 1)[1])


def test_row_limits_are_checked_from_metrics(spark, tmp_path):
    with pytest.raises(quality.QualityGateError, match="rows:sellers=1"):
        pipeline.run_pipeline(spark, _raw(spark), str(tmp_path), min_rows={**NO_LIMITS, "sellers": 2})


def test_metrics_agree_with_the_report_and_need_no_scan(spark, tmp_path):
    run = pipeline.write_staging(spark, load_raw_testdata(spark, SF), str(tmp_path), publish=False)
    m = pipeline.read_staging(spark, run.database)
    measured = quality.measured_report(spark, run.metrics)
    assert "FileScan" not in measured._jdf.queryExecution().executedPlan().toString()
    whole = sorted(map(tuple, quality.dq_report(m).collect()))
    assert sorted(map(tuple, measured.union(quality.orphan_check(m)).collect())) == whole


# ---------------------------------------------------------------- A1-A3

HEADER = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
COLUMNS = csv_source.FILES["sellers"][1]


def test_a_quoted_line_break_is_read_right_or_stops(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text(HEADER + 'a,001,"two\nlines",SP\nb,002,plain,RJ\n')
    for read in (lambda df: df.collect(), lambda df: df.count(), lambda df: df.select("seller_state").collect()):
        with pytest.raises(Exception, match="multiline=True"):
            read(csv_source.read_csv(spark, str(path), COLUMNS))
    rows = csv_source.read_csv(spark, str(path), COLUMNS, multiline=True).collect()
    assert [tuple(r) for r in rows] == [("a", "001", "two\nlines", "SP"), ("b", "002", "plain", "RJ")]


def test_a_break_in_the_last_column_stops_too(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text(HEADER + 'a,001,city,"S\nP"\nb,002,plain,RJ\n')
    with pytest.raises(Exception, match="multiline=True"):
        csv_source.read_csv(spark, str(path), COLUMNS).count()


def test_one_column_with_a_break(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('t\n"two\nlines"\nplain\n')
    assert [r.t for r in csv_source.read_csv(spark, str(path), ["t"]).collect()] == ["two\nlines", "plain"]


@pytest.mark.parametrize("types", ["infer", {"n": "int", "day": "date"}])
def test_broken_rows_are_set_aside_and_counted(spark, tmp_path, types):
    path = tmp_path / "x.csv"
    path.write_text("code,n,day\n001,5,2020-01-02\n002,6\n003,7,2020-01-03,more\n" + "".join(f"{i:03},{i},2020-02-01\n" for i in range(4, 40)))
    rows, rejected = csv_source.read_csv_checked(spark, str(path), ["code", "n", "day"], types, sample_ratio=1.0)
    assert rows.count() == 37 and rejected.count() == 2
    assert sorted(r.row for r in rejected.collect()) == ["002,6", "003,7,2020-01-03,more"]
    assert dict(rows.dtypes)["n"] == "int" and dict(rows.dtypes)["day"] == "date"
    assert rows.agg(F.sum("n")).first()[0] == 5 + sum(range(4, 40))


def test_values_that_their_type_does_not_take_are_set_aside(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("code,n\na,5\nb,many\n")
    rows, rejected = csv_source.read_csv_checked(spark, str(path), ["code", "n"], {"n": "int"})
    assert [tuple(r) for r in rows.collect()] == [("a", 5)] and [r.row for r in rejected.collect()] == ["b,many"]


# ---------------------------------------------------------------- B5, B6

def test_money_that_is_not_finite_is_unknown(spark):
    rows = [("o", str(i), "p", "s", p, "1") for i, p in enumerate(["NaN", " nan", "Infinity", "-inf", "+Inf", "2.5"])]
    items = spark.createDataFrame(rows, "order_id string, order_item_id string, product_id string, seller_id string, "
                                        "price string, freight_value string")
    orders = spark.createDataFrame([("o",)], "order_id string")
    got = clean_order_items(items, orders).orderBy("order_item_id").collect()
    assert [r.price and float(r.price) for r in got] == [None] * 5 + [2.5]
    as_double = items.withColumn("price", F.col("price").cast("double")).where("order_item_id IN ('0', '2', '5')")
    assert [r.price and float(r.price) for r in clean_order_items(as_double, orders).orderBy("order_item_id").collect()] == [None, None, 2.5]


# ---------------------------------------------------------------- O1

def test_title_case_of_every_cased_character(spark):
    """Each assigned character alone, after a letter, and before one, against ``str.title``."""
    # Left out: later scripts, whose case the Unicode tables of Java and Python know from different versions on,
    # and the characters that the function's docstring names.
    odd = "ŉƛɤჼᲉᲊᾲᾴᾷῂῄῇῲῴῷ"
    chars = [chr(i) for i in range(32, 0x2C00) if unicodedata.category(chr(i)) != "Cn" and chr(i) not in odd]
    words = [w for c in chars for w in (c + "ab", "a" + c + "B")]
    rows = spark.createDataFrame([(w,) for w in words], "w string").select("w", title_case("w").alias("t")).collect()
    assert [r.w for r in rows if r.t != r.w.title()] == []


def test_title_case_of_words(spark):
    words = ["ßen", "ǆ x", "ﬁn", "ΣΣ", "ΣΑΣ ΟΔΟΣ", "אa", "d'oeste 3x", "ᾀβγ", "o'neil-smith", "İstanbul"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select(title_case("w").alias("t")).collect()
    assert [r.t for r in got] == [w.title() for w in words]
