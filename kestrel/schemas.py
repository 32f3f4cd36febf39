"""One StructType per entity. Readers always pass a schema; nothing is inferred.

Batch times are ``timestamp_ntz`` (as the test parquet stores them); streaming readers
cast event time to ``timestamp`` because watermarks need it (see ``streaming.sources``).
"""

from pyspark.sql import types as T

NTZ = T.TimestampNTZType()

PERSON = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("emailAddress", T.StringType()),
    T.StructField("creditCard", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("dateTime", NTZ),
    T.StructField("extra", T.StringType()),
])

AUCTION = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("itemName", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("initialBid", T.LongType()),
    T.StructField("reserve", T.LongType()),
    T.StructField("dateTime", NTZ),
    T.StructField("expires", NTZ),
    T.StructField("seller", T.LongType()),
    T.StructField("category", T.LongType()),
    T.StructField("extra", T.StringType()),
])

BID = T.StructType([
    T.StructField("auction", T.LongType()),
    T.StructField("bidder", T.LongType()),
    T.StructField("price", T.LongType()),
    T.StructField("channel", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("dateTime", NTZ),
    T.StructField("extra", T.StringType()),
])

# Tagged union: event_type 0 = person, 1 = auction, 2 = bid; the other two structs are NULL.
EVENT = T.StructType([
    T.StructField("event_type", T.IntegerType()),
    T.StructField("person", PERSON),
    T.StructField("auction", AUCTION),
    T.StructField("bid", BID),
])

SENSOR = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("id", T.LongType()),
    T.StructField("val1", T.LongType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("ts", NTZ),
])

CAR = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("sensorId", T.StringType()),
    T.StructField("count", T.IntegerType()),
    T.StructField("ts", NTZ),
])

TRANSACTION = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("account_id", T.LongType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("ts", NTZ),
])

GOODS = T.StructType([
    T.StructField("goodsId", T.StringType()),
    T.StructField("goodsName", T.StringType()),
    T.StructField("goodsPrice", T.DecimalType(18, 2)),
    T.StructField("ts", NTZ),
])

ORDER_ITEM = T.StructType([
    T.StructField("itemId", T.StringType()),
    T.StructField("goodsId", T.StringType()),
    T.StructField("count", T.IntegerType()),
    T.StructField("ts", NTZ),
])

USER_INFO = T.StructType([
    T.StructField("userId", T.LongType()),
    T.StructField("userName", T.StringType()),
    T.StructField("userAge", T.IntegerType()),
    T.StructField("valid_from", NTZ),
])

SCORE = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("score", T.DoubleType()),
])

KEYED_INFO = T.StructType([
    T.StructField("rowkey", T.StringType()),
    T.StructField("info", T.StructType([
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
    ])),
])
