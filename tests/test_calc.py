"""Projections and scalar functions on hand-made bids (edge cases of q1, q14, q21, q22)."""

import datetime as dt
from decimal import Decimal


from kestrel import schemas
from kestrel.operators import calc

T0 = dt.datetime(2024, 1, 1)


def bids(spark, rows):
    full = [(a, b, p, ch, url, T0 + dt.timedelta(hours=h), ex) for a, b, p, ch, url, h, ex in rows]
    return spark.createDataFrame(full, schemas.BID)


def test_currency_is_decimal_23_3(spark):
    df = calc.currency(bids(spark, [(1, 2, 1000, "Apple", "u", 0, "x")]))
    assert df.schema["price"].dataType.simpleString() == "decimal(23,3)"
    assert df.first().price == Decimal("908.000")


def test_mod_filter(spark):
    df = calc.mod_filter(bids(spark, [(123, 1, 1, "a", "u", 0, ""), (124, 1, 1, "a", "u", 0, ""),
                                      (0, 1, 1, "a", "u", 0, ""), (-246, 1, 1, "a", "u", 0, "")]), 123)
    assert sorted(r.auction for r in df.collect()) == [-246, 0, 123]


def test_calc_hours_band_and_count_char(spark):
    rows = [(i, 1, 2_000_000, "a", "u", h, "cxcc") for i, h in enumerate([6, 7, 8, 18, 19, 20])]
    rows.append((99, 1, int(50_000_000 / 0.908) + 1, "a", "u", 8, "c"))  # above the upper bound
    rows.append((98, 1, int(1_000_000 / 0.908), "a", "u", 8, "c"))  # 999999.xxx: below the lower bound
    out = {r.auction: (r.bidTimeType, r.c_counts) for r in calc.calc(bids(spark, rows)).collect()}
    assert out == {0: ("nightTime", 3), 1: ("otherTime", 3), 2: ("dayTime", 3), 3: ("dayTime", 3),
                   4: ("otherTime", 3), 5: ("nightTime", 3)}


def test_channel_id(spark):
    rows = [
        (1, 1, 1, "Apple", "http://x/a", 0, ""),                 # known channel
        (2, 1, 1, "other", "http://x?a=1&channel_id=7&b=2", 0, ""),  # from the URL
        (3, 1, 1, "other", "http://x/a&channel_id=", 0, ""),      # empty value kept as ''
        (4, 1, 1, "other", "http://x/a?channel_id=9", 0, ""),     # '?' does not count
        (5, 1, 1, "BAIDU", "channel_id=5", 0, ""),                # known wins over the URL
        (6, 1, 1, "other", "channel_id=5&x", 0, ""),              # start of string
        (7, 1, 1, "other", "x&channel_id=channel_id=4", 0, ""),   # value containing the key
    ]
    out = {r.auction: r.channel_id for r in calc.channel_id(bids(spark, rows)).collect()}
    assert out == {1: "0", 2: "7", 3: "", 5: "3", 6: "5", 7: "channel_id=4"}


def test_url_dirs(spark):
    rows = [(1, 1, 1, "a", "https://www.example.com/A/d1/item.htm", 0, ""),
            (2, 1, 1, "a", "https://www.example.com/A", 0, ""),
            (3, 1, 1, "a", "https://www.example.com//x/", 0, "")]
    out = {r.auction: (r.dir1, r.dir2, r.dir3) for r in calc.url_dirs(bids(spark, rows)).collect()}
    assert out == {1: ("A", "d1", "item.htm"), 2: ("A", None, None), 3: ("", "x", "")}


def test_threshold_and_cos_cbrt(spark):
    df = spark.createDataFrame([(1, "a", 101.0), (2, "a", 101.5), (3, "b", 500.0)], schemas.SCORE)
    assert [r.id for r in calc.threshold_filter(df, "score", 101).orderBy("id").collect()] == [2, 3]
    v = calc.number_crunch(spark.range(1, 9), "id").collect()
    assert abs(v[7].value - __import__("math").cos(2.0)) < 1e-12


def test_nested_event_views_equal_flat_entities(spark):
    from kestrel.sources import auction as V
    from kestrel.sources import fixtures as X
    d = "/root/testdata/sf0.001"
    ev = X.events_table(spark, d)
    for view, flat in ((V.bid_view, X.bids), (V.auction_view, X.auctions), (V.person_view, X.persons)):
        a, b = view(ev), flat(spark, d)
        assert a.columns == b.columns
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_split_words_like_java(spark):
    df = spark.createDataFrame([(1, "a  b "), (2, "   "), (3, ""), (4, " x")], "id int, text string")
    got = sorted((r.id, r.word) for r in calc.split_words(df, "text", keep=["id"]).collect())
    assert got == [(1, ""), (1, "a"), (1, "b"), (3, ""), (4, ""), (4, "x")]
