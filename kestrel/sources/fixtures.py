"""Entity tables derived from the driver's parquet tables (rules in FIXTURES.md part B).

Every entity is a lazy projection of one scan, so its size grows with the tables and
Catalyst prunes the columns each query does not use. ``events_table`` is the tagged
union the auction queries read (person / auction / bid views filter on the tag).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel import schemas
from kestrel.sources.tables import table

# Fixed values of the derived fixtures (FIXTURES.md part B).
STATE_BY_NATION_MOD5 = ["OR", "ID", "CA", "WA", "NV"]
CHANNELS_BY_SUPPKEY_MOD6 = ["Apple", "google", "Facebook", "Baidu"]
PERSON_EPOCH = "1995-01-01 00:00:00"
WORD_EPOCH = "2024-01-01 00:00:00"
USER_INFO_V1_FROM = "2024-01-05 00:00:00"
USER_INFO_V2_FROM = "2024-01-15 00:00:00"
# Keyword rule stream: (valid from, keyword); the first one holds from the start.
KEYWORDS = [(None, "view"), ("2024-01-08 00:00:00", "click"),
            ("2024-01-15 00:00:00", "error"), ("2024-01-22 00:00:00", "signup")]


def _ts(s: str) -> Column:
    return F.lit(s).cast("timestamp_ntz")


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("emailAddress"),
        F.concat(F.lit("4000"), F.lpad(F.col("c_custkey").cast("string"), 12, "0")).alias("creditCard"),
        F.col("c_mktsegment").alias("city"),
        F.expr("CASE c_nationkey % 5 WHEN 0 THEN 'OR' WHEN 1 THEN 'ID' WHEN 2 THEN 'CA' "
               "WHEN 3 THEN 'WA' ELSE 'NV' END").alias("state"),
        F.timestamp_add("DAY", (F.col("c_custkey") * 37) % 2400, _ts(PERSON_EPOCH)).alias("dateTime"),
        F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("extra"),
    )


def auctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("item-"), F.col("o_orderpriority")).alias("itemName"),
        F.concat(F.lit("status-"), F.col("o_orderstatus")).alias("description"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("initialBid"),
        F.round(F.col("o_totalprice") * 110).cast("bigint").alias("reserve"),
        F.col("o_orderdate").alias("dateTime"),
        F.timestamp_add("DAY", F.lit(365), F.col("o_orderdate")).alias("expires"),
        F.col("o_custkey").alias("seller"),
        (F.lit(10) + F.col("o_orderkey") % 5).cast("bigint").alias("category"),
        F.col("o_orderstatus").alias("extra"),
    )


def bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.selectExpr(
        "l_orderkey AS auction",
        "l_partkey AS bidder",
        "(CAST(round(l_extendedprice * 100) AS BIGINT) div CASE l_partkey % 4 WHEN 0 THEN 1000 ELSE 1 END)"
        " * CASE l_partkey % 4 WHEN 1 THEN 10 ELSE 1 END AS price",
        "CASE l_suppkey % 6 WHEN 0 THEN 'Apple' WHEN 1 THEN 'google' WHEN 2 THEN 'Facebook' "
        "WHEN 3 THEN 'Baidu' ELSE concat('channel-', l_suppkey % 6) END AS channel",
        "concat('https://www.example.com/', l_returnflag,"
        " CASE WHEN l_partkey % 4 = 0 THEN '' ELSE concat('/d', l_partkey % 7) END,"
        " CASE WHEN l_partkey % 3 = 0 THEN '' ELSE '/item.htm?query=1' END,"
        " CASE l_suppkey % 5 WHEN 0 THEN '&channel_id=' WHEN 1 THEN concat('&channel_id=', l_suppkey, '&x=1')"
        " WHEN 2 THEN '?channel_id=9' ELSE '' END) AS url",
        "timestampadd(SECOND, (l_partkey * 37 + l_linenumber * 3600 + l_suppkey * 11) % 86400, l_shipdate)"
        " AS dateTime",
        "concat(repeat('c', CAST(l_partkey % 4 AS INT)), l_returnflag, 'xcx') AS extra",
    )


def _null_struct(schema) -> Column:
    return F.lit(None).cast(schema)


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested event table: tag + three nullable rows (only one set per row)."""
    p = persons(spark, sf_dir)
    a = auctions(spark, sf_dir)
    b = bids(spark, sf_dir)
    pe = p.select(F.lit(0).alias("event_type"), F.struct(*p.columns).alias("person"),
                  _null_struct(schemas.AUCTION).alias("auction"), _null_struct(schemas.BID).alias("bid"))
    ae = a.select(F.lit(1).alias("event_type"), _null_struct(schemas.PERSON).alias("person"),
                  F.struct(*a.columns).alias("auction"), _null_struct(schemas.BID).alias("bid"))
    be = b.select(F.lit(2).alias("event_type"), _null_struct(schemas.PERSON).alias("person"),
                  _null_struct(schemas.AUCTION).alias("auction"), F.struct(*b.columns).alias("bid"))
    return pe.unionByName(ae).unionByName(be)


# ---- record streams of the window / state / rule jobs ---------------------------------

def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def cars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("event_id").alias("seq"), F.col("event_type").alias("sensorId"),
        F.floor("value").cast("int").alias("count"), "ts")


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("event_id").alias("seq"), F.col("user_id").alias("id"), F.col("event_id").alias("val1"),
        F.col("value").alias("temperature"), "ts")


def jitter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out-of-order copy of events: arrival order = seq, time moved back up to 10 min."""
    return events(spark, sf_dir).select(
        F.col("event_id").alias("seq"), F.col("user_id").alias("id"),
        F.timestamp_add("SECOND", -((F.col("event_id") * 7919) % 600), F.col("ts")).alias("ts"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("event_id").alias("id"), F.col("user_id").alias("account_id"),
        F.col("value").alias("amount"), "ts")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("event_id").alias("seq"), F.concat_ws(" ", "event_type", "props").alias("message"), "ts")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("item_"), F.col("l_linenumber")).alias("itemId"),
        F.concat(F.lit("P_"), F.col("l_partkey")).alias("goodsId"),
        F.floor("l_quantity").cast("int").alias("count"),
        F.col("l_shipdate").alias("ts"))


def goods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("P_"), F.col("p_partkey")).alias("goodsId"),
        F.col("p_name").alias("goodsName"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("goodsPrice"),
        F.timestamp_add("DAY", F.col("p_partkey") % 2400, _ts(PERSON_EPOCH)).alias("ts"))


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns split into words (Java ``split(" ")`` rules, ``calc.split_words``),
    timed by conversation and turn."""
    from kestrel.operators.calc import split_words

    conv = table(spark, sf_dir, "conversations").withColumn(
        "ts", F.timestamp_add("SECOND", F.col("conv_id") * 60 + F.col("turn") * 10, _ts(WORD_EPOCH)))
    return split_words(conv, "text", "word", ["ts"]).select("word", "ts")


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots of the known users (id % 10 <> 9); the second lacks the users with id % 10 = 8.

    Derived from the distinct users of ``events`` (one aggregation, so it grows with the data).
    """
    users = events(spark, sf_dir).select(F.col("user_id").alias("userId")).where("userId % 10 <> 9").distinct()
    v1 = users.select("userId", F.concat(F.lit("user_"), F.col("userId")).alias("userName"),
                      (F.lit(20) + F.col("userId") % 40).cast("int").alias("userAge"),
                      _ts(USER_INFO_V1_FROM).alias("valid_from"))
    v2 = users.select("userId", F.concat(F.lit("user_"), F.col("userId"), F.lit("_v2")).alias("userName"),
                      (F.lit(21) + F.col("userId") % 40).cast("int").alias("userAge"),
                      _ts(USER_INFO_V2_FROM).alias("valid_from")).where("userId % 10 <> 8")
    return v1.unionByName(v2)


def keywords(spark: SparkSession) -> DataFrame:
    """The keyword rule stream (4 rows): ``ts`` NULL means valid from the start."""
    return spark.createDataFrame(
        [(k, v) for k, v in KEYWORDS], "ts string, keyword string"
    ).select(F.col("ts").cast("timestamp_ntz").alias("ts"), "keyword")
