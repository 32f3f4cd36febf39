"""The registered SQL functions on literal rows, and the views in a query of our own."""

import pytest

from kestrel.functions import sql as Q
from kestrel.sources import fixtures as X
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def functions(spark):
    Q.register_functions(spark)
    return lambda text: spark.sql(f"SELECT {text} AS x").first().x


def test_count_char(functions):
    assert functions("count_char('banana', 'a')") == 3
    assert functions("count_char('', 'a')") == 0
    assert functions("count_char(NULL, 'a')") is None


def test_split_index(functions):
    assert functions("split_index('x/y//z', '/', 1)") == "y"
    assert functions("split_index('x/y//z', '/', 2)") == ""
    assert functions("split_index('x/y', '/', 9)") is None
    assert functions("split_index('1.2', '.', 1)") == "2"  # the delimiter is no pattern


def test_regexp_extract_or_null(functions):
    assert functions("regexp_extract_or_null('k=7;j=8', 'j=([0-9])', 1)") == "8"
    assert functions("regexp_extract_or_null('k=;', 'k=([0-9]*)', 1)") == ""
    assert functions("regexp_extract_or_null('none', 'k=([0-9]*)', 1)") is None


def test_views_hold_the_entities(spark):
    Q.register_views(spark, SF)
    got = spark.sql("SELECT channel, max(price) AS top FROM bid GROUP BY channel HAVING count(*) > 3")
    bid = X.bids(spark, SF)
    want = {}
    for r in bid.select("channel", "price").collect():
        want.setdefault(r.channel, []).append(r.price)
    assert rows(got) == sorted((c, max(p)) for c, p in want.items() if len(p) > 3)
    assert spark.sql("SELECT count(*) AS n FROM auction").first().n == X.auctions(spark, SF).count()
    assert spark.sql("SELECT count(*) AS n FROM person").first().n == X.persons(spark, SF).count()
