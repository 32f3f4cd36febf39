"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the query semantics, not from the Spark code: the fixture views are
restated as CTEs, windows use ``time_bucket`` with an explicit epoch origin, sessions
and count windows are gaps-and-islands / row numbers. Column names equal the Spark ones.
"""

from __future__ import annotations

EPOCH = "TIMESTAMP '1970-01-01 00:00:00'"

PERSON = """person AS (
  SELECT c_custkey AS id, c_name AS name, concat(lower(c_name), '@example.com') AS emailAddress,
         concat('4000', lpad(CAST(c_custkey AS VARCHAR), 12, '0')) AS creditCard,
         c_mktsegment AS city,
         CASE c_nationkey % 5 WHEN 0 THEN 'OR' WHEN 1 THEN 'ID' WHEN 2 THEN 'CA' WHEN 3 THEN 'WA' ELSE 'NV' END
           AS state,
         TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST((c_custkey * 37) % 2400 AS INTEGER)) AS dateTime,
         concat('n', CAST(c_nationkey AS VARCHAR)) AS extra
  FROM customer)"""

AUCTION = """auction AS (
  SELECT o_orderkey AS id, concat('item-', o_orderpriority) AS itemName,
         concat('status-', o_orderstatus) AS description,
         CAST(round(o_totalprice * 100) AS BIGINT) AS initialBid,
         CAST(round(o_totalprice * 110) AS BIGINT) AS reserve,
         o_orderdate AS dateTime, o_orderdate + INTERVAL 365 DAY AS expires,
         o_custkey AS seller, CAST(10 + o_orderkey % 5 AS BIGINT) AS category, o_orderstatus AS extra
  FROM orders)"""

BID = """bid AS (
  SELECT l_orderkey AS auction, l_partkey AS bidder,
         (CAST(round(l_extendedprice * 100) AS BIGINT) // CASE l_partkey % 4 WHEN 0 THEN 1000 ELSE 1 END)
           * CASE l_partkey % 4 WHEN 1 THEN 10 ELSE 1 END AS price,
         CASE l_suppkey % 6 WHEN 0 THEN 'Apple' WHEN 1 THEN 'google' WHEN 2 THEN 'Facebook'
              WHEN 3 THEN 'Baidu' ELSE concat('channel-', l_suppkey % 6) END AS channel,
         concat('https://www.example.com/', l_returnflag,
                CASE WHEN l_partkey % 4 = 0 THEN '' ELSE concat('/d', l_partkey % 7) END,
                CASE WHEN l_partkey % 3 = 0 THEN '' ELSE '/item.htm?query=1' END,
                CASE l_suppkey % 5 WHEN 0 THEN '&channel_id=' WHEN 1 THEN concat('&channel_id=', l_suppkey, '&x=1')
                     WHEN 2 THEN '?channel_id=9' ELSE '' END) AS url,
         l_shipdate + to_seconds(CAST((l_partkey * 37 + l_linenumber * 3600 + l_suppkey * 11) % 86400 AS BIGINT))
           AS dateTime,
         concat(repeat('c', CAST(l_partkey % 4 AS INTEGER)), l_returnflag, 'xcx') AS extra
  FROM lineitem)"""

CAR = """car AS (SELECT event_id AS seq, event_type AS sensorId, CAST(floor(value) AS INTEGER) AS count, ts
  FROM events)"""
SENSOR = """sensor AS (SELECT event_id AS seq, user_id AS id, event_id AS val1, value AS temperature, ts
  FROM events)"""
TRANSACTION = """txn AS (SELECT event_id AS id, user_id AS account_id, value AS amount, ts FROM events)"""
JITTER = """jitter AS (SELECT event_id AS seq, user_id AS id,
  ts - to_seconds(CAST((event_id * 7919) % 600 AS BIGINT)) AS ts FROM events)"""
MESSAGE = """message AS (SELECT event_id AS seq, concat_ws(' ', event_type, props) AS message, ts FROM events)"""
ORDER_ITEM = """order_item AS (SELECT concat('item_', l_linenumber) AS itemId, concat('P_', l_partkey) AS goodsId,
  CAST(floor(l_quantity) AS INTEGER) AS count, l_shipdate AS ts FROM lineitem)"""
GOODS = """goods AS (SELECT concat('P_', p_partkey) AS goodsId, p_name AS goodsName,
  CAST(p_retailprice AS DECIMAL(18,2)) AS goodsPrice,
  TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST(p_partkey % 2400 AS INTEGER)) AS ts FROM part)"""
WORD = """word AS (SELECT unnest(CASE WHEN text = '' THEN [''] WHEN rtrim(text, ' ') = '' THEN []::VARCHAR[]
                                ELSE string_split(rtrim(text, ' '), ' ') END) AS word,
  TIMESTAMP '2024-01-01 00:00:00' + to_seconds(CAST(conv_id * 60 + turn * 10 AS BIGINT)) AS ts
  FROM conversations)"""
USER_INFO = """users AS (SELECT DISTINCT user_id AS userId FROM events WHERE user_id % 10 <> 9),
user_info AS (
  SELECT userId, concat('user_', userId) AS userName, CAST(20 + userId % 40 AS INTEGER) AS userAge,
         TIMESTAMP '2024-01-05 00:00:00' AS valid_from FROM users
  UNION ALL
  SELECT userId, concat('user_', userId, '_v2'), CAST(21 + userId % 40 AS INTEGER),
         TIMESTAMP '2024-01-15 00:00:00' FROM users WHERE userId % 10 <> 8)"""
KEYWORDS = """keywords AS (SELECT * FROM (VALUES
  (NULL::TIMESTAMP, 'view'), (TIMESTAMP '2024-01-08 00:00:00', 'click'),
  (TIMESTAMP '2024-01-15 00:00:00', 'error'), (TIMESTAMP '2024-01-22 00:00:00', 'signup')) k(ts, keyword))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def tumble_start(ts: str, size: str) -> str:
    return f"time_bucket(INTERVAL '{size}', {ts}, {EPOCH})"


BANDS = """
  count(*) AS total_bids,
  count(*) FILTER (WHERE price < 10000) AS rank1_bids,
  count(*) FILTER (WHERE price >= 10000 AND price < 1000000) AS rank2_bids,
  count(*) FILTER (WHERE price >= 1000000) AS rank3_bids"""

DISTINCT_BANDS = """
  count(DISTINCT bidder) AS total_bidders,
  count(DISTINCT bidder) FILTER (WHERE price < 10000) AS rank1_bidders,
  count(DISTINCT bidder) FILTER (WHERE price >= 10000 AND price < 1000000) AS rank2_bidders,
  count(DISTINCT bidder) FILTER (WHERE price >= 1000000) AS rank3_bidders,
  count(DISTINCT auction) AS total_auctions,
  count(DISTINCT auction) FILTER (WHERE price < 10000) AS rank1_auctions,
  count(DISTINCT auction) FILTER (WHERE price >= 10000 AND price < 1000000) AS rank2_auctions,
  count(DISTINCT auction) FILTER (WHERE price >= 1000000) AS rank3_auctions"""

ORACLE: dict[str, str] = {}

ORACLE["q0"] = with_(BID) + "SELECT auction, bidder, price, channel, url, dateTime, extra FROM bid"

ORACLE["q1"] = with_(BID) + """SELECT auction, bidder, CAST(0.908 * price AS DECIMAL(23,3)) AS price,
  channel, url, dateTime, extra FROM bid"""

ORACLE["q2"] = with_(BID) + """SELECT auction, bidder, CAST(price AS DECIMAL(23,3)) AS price,
  channel, url, dateTime, extra FROM bid WHERE auction % 123 = 0"""

ORACLE["q14"] = with_(BID) + """SELECT auction, bidder, CAST(0.908 * price AS DECIMAL(23,3)) AS price,
  CASE WHEN hour(dateTime) >= 8 AND hour(dateTime) <= 18 THEN 'dayTime'
       WHEN hour(dateTime) <= 6 OR hour(dateTime) >= 20 THEN 'nightTime'
       ELSE 'otherTime' END AS bidTimeType,
  dateTime, extra, CAST(length(extra) - length(replace(extra, 'c', '')) AS INTEGER) AS c_counts
FROM bid WHERE 0.908 * price > 1000000 AND 0.908 * price < 50000000"""

ORACLE["q21"] = with_(BID) + """SELECT auction, bidder, price, channel,
  CASE lower(channel) WHEN 'apple' THEN '0' WHEN 'google' THEN '1' WHEN 'facebook' THEN '2' WHEN 'baidu' THEN '3'
       ELSE CASE WHEN regexp_matches(url, '(&|^)channel_id=([^&]*)')
                 THEN regexp_extract(url, '(&|^)channel_id=([^&]*)', 2) END END AS channel_id
FROM bid
WHERE regexp_matches(url, '(&|^)channel_id=([^&]*)') OR lower(channel) IN ('apple', 'google', 'facebook', 'baidu')"""

ORACLE["q22"] = with_(BID) + """SELECT auction, bidder, price, channel,
  string_split(url, '/')[4] AS dir1, string_split(url, '/')[5] AS dir2, string_split(url, '/')[6] AS dir3
FROM bid"""

# ---- joins -------------------------------------------------------------------------------

ORACLE["q3"] = with_(AUCTION, PERSON) + """SELECT p.name, p.city, p.state, a.id
FROM auction a JOIN person p ON a.seller = p.id
WHERE a.category = 10 AND (p.state = 'OR' OR p.state = 'ID' OR p.state = 'CA')"""

ORACLE["q4"] = with_(AUCTION, BID) + """SELECT category AS id, CAST(sum(final) // count(final) AS BIGINT) AS final
FROM (SELECT a.id, a.category, max(b.price) AS final
      FROM auction a, bid b
      WHERE a.id = b.auction AND b.dateTime BETWEEN a.dateTime AND a.expires
      GROUP BY a.id, a.category) q
GROUP BY category"""

ORACLE["q9"] = with_(AUCTION, BID) + """SELECT id, itemName, description, initialBid, reserve, dateTime, expires, seller,
  category, extra, auction, bidder, price, bid_dateTime, bid_extra
FROM (SELECT a.*, b.auction, b.bidder, b.price, b.dateTime AS bid_dateTime, b.extra AS bid_extra,
             row_number() OVER (PARTITION BY a.id ORDER BY b.price DESC, b.dateTime ASC, b.bidder ASC) AS rownum
      FROM auction a, bid b
      WHERE a.id = b.auction AND b.dateTime BETWEEN a.dateTime AND a.expires) t
WHERE rownum <= 1"""

ORACLE["q20"] = with_(AUCTION, BID) + """SELECT b.auction, b.bidder, b.price, b.channel, b.url,
  b.dateTime AS bid_dateTime, b.extra AS bid_extra, a.itemName, a.description, a.initialBid, a.reserve,
  a.dateTime AS auction_dateTime, a.expires, a.seller, a.category, a.extra AS auction_extra
FROM bid b JOIN auction a ON b.auction = a.id WHERE a.category = 10"""

ORACLE["win_join_orders_goods"] = with_(ORDER_ITEM, GOODS) + f"""SELECT o.goodsId, g.goodsName, o.count,
  g.goodsPrice * o.count AS totalMoney
FROM order_item o JOIN goods g
  ON o.goodsId = g.goodsId AND {tumble_start('o.ts', '30 days')} = {tumble_start('g.ts', '30 days')}"""

# ---- aggregates --------------------------------------------------------------------------

ORACLE["q15"] = with_(BID) + f"""SELECT strftime(dateTime, '%Y-%m-%d') AS day, {BANDS}, {DISTINCT_BANDS}
FROM bid GROUP BY strftime(dateTime, '%Y-%m-%d')"""

ORACLE["q16"] = with_(BID) + f"""SELECT channel, strftime(dateTime, '%Y-%m-%d') AS day,
  max(strftime(dateTime, '%H:%M')) AS minute, {BANDS}, {DISTINCT_BANDS}
FROM bid GROUP BY channel, strftime(dateTime, '%Y-%m-%d')"""

ORACLE["q17"] = with_(BID) + f"""SELECT auction, strftime(dateTime, '%Y-%m-%d') AS day, {BANDS},
  min(price) AS min_price, max(price) AS max_price,
  CAST(sum(price) // count(price) AS BIGINT) AS avg_price, CAST(sum(price) AS BIGINT) AS sum_price
FROM bid GROUP BY auction, strftime(dateTime, '%Y-%m-%d')"""

ORACLE["running_sum"] = """WITH s AS (SELECT event_id AS id, event_type AS name, value AS score FROM events
  WHERE value > 101)
SELECT first_value(id) OVER (PARTITION BY name ORDER BY id) AS id, name,
  CAST(sum(CAST(score AS DECIMAL(38,2))) OVER (PARTITION BY name ORDER BY id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS score,
  id AS row_id
FROM s"""

# ---- top-k -------------------------------------------------------------------------------

ORACLE["q18"] = with_(BID) + """SELECT auction, bidder, price, channel, url, dateTime, extra
FROM (SELECT *, row_number() OVER (PARTITION BY bidder, auction
                                   ORDER BY dateTime DESC, price, channel, url, extra) AS rank_number
      FROM bid) t
WHERE rank_number <= 1"""

ORACLE["q19"] = with_(BID) + """SELECT auction, bidder, price, channel, url, dateTime, extra, rank_number
FROM (SELECT *, row_number() OVER (PARTITION BY auction
                                   ORDER BY price DESC, bidder, dateTime, channel, url, extra) AS rank_number
      FROM bid) t
WHERE rank_number <= 10"""

# ---- time windows ------------------------------------------------------------------------


def hop_starts(ts: str, size_h: int, slide_h: int) -> str:
    """All hop-window starts containing ``ts``: slide-aligned start minus k slides."""
    n = size_h // slide_h
    return (f"(time_bucket(INTERVAL '{slide_h} hours', {ts}, {EPOCH}) - to_hours(CAST(k * {slide_h} AS BIGINT))) "
            f"FROM events, range(0, {n}) r(k)")


ORACLE["q5"] = f"""WITH hop AS (SELECT user_id AS auction, {hop_starts('ts', 24, 6).replace(') FROM', ') AS starttime FROM')}),
counts AS (SELECT auction, starttime, count(*) AS num FROM hop GROUP BY auction, starttime),
maxes AS (SELECT starttime, max(num) AS maxn FROM counts GROUP BY starttime)
SELECT c.auction, c.num FROM counts c JOIN maxes m ON c.starttime = m.starttime AND c.num >= m.maxn"""

ORACLE["q7"] = f"""WITH m AS (SELECT {tumble_start('ts', '1 day')} AS wstart, max(value) AS maxprice
                FROM events GROUP BY 1),
r AS (SELECT maxprice, wstart + INTERVAL 1 DAY - INTERVAL 1 MILLISECOND AS rowtime FROM m)
SELECT e.* FROM events e JOIN r ON e.value = r.maxprice
WHERE e.ts BETWEEN r.rowtime - INTERVAL 1 DAY AND r.rowtime"""

ORACLE["q8"] = with_(PERSON, AUCTION) + f""", p AS (SELECT DISTINCT id, name, {tumble_start('dateTime', '30 days')} AS st FROM person),
a AS (SELECT DISTINCT seller, {tumble_start('dateTime', '30 days')} AS st FROM auction)
SELECT p.id, p.name, p.st AS stime FROM p JOIN a ON p.id = a.seller AND p.st = a.st"""
ORACLE["q8"] = ORACLE["q8"].replace("\n, p AS", ",\np AS")

ORACLE["q11"] = """WITH x AS (
  SELECT user_id, ts,
         CASE WHEN lag(ts) OVER w IS NULL OR ts > lag(ts) OVER w + INTERVAL 6 HOUR THEN 1 ELSE 0 END AS brk
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
y AS (SELECT user_id, ts, sum(brk) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM x)
SELECT user_id AS bidder, count(*) AS bid_count, min(ts) AS starttime, max(ts) + INTERVAL 6 HOUR AS endtime
FROM y GROUP BY user_id, sid"""

ORACLE["q12"] = f"""SELECT user_id AS bidder, count(*) AS bid_count, {tumble_start('ts', '1 day')} AS starttime,
  {tumble_start('ts', '1 day')} + INTERVAL 1 DAY AS endtime
FROM events GROUP BY user_id, {tumble_start('ts', '1 day')}"""

ORACLE["win_sum_tumble"] = with_(WORD) + f"""SELECT word, {tumble_start('ts', '5 minutes')} AS starttime,
  {tumble_start('ts', '5 minutes')} + INTERVAL 5 MINUTE AS endtime, count(*) AS cnt
FROM word GROUP BY word, {tumble_start('ts', '5 minutes')}"""

ORACLE["win_sum_slide"] = with_(WORD) + f""", hop AS (
  SELECT word, {tumble_start('ts', '5 minutes')} - to_minutes(CAST(5 * k AS BIGINT)) AS starttime
  FROM word, range(0, 2) r(k))
SELECT word, starttime, starttime + INTERVAL 10 MINUTE AS endtime, count(*) AS cnt
FROM hop GROUP BY word, starttime""".replace("\n, hop AS", ",\nhop AS")

ORACLE["win_reduce_argmin"] = with_(SENSOR) + f"""SELECT seq, id, val1, temperature, ts
FROM (SELECT *, row_number() OVER (PARTITION BY id, {tumble_start('ts', '1 day')} ORDER BY temperature, seq) AS rn
      FROM sensor) t
WHERE rn = 1"""

ORACLE["win_agg_count"] = with_(SENSOR) + f"""SELECT id, {tumble_start('ts', '1 day')} AS starttime,
  {tumble_start('ts', '1 day')} + INTERVAL 1 DAY AS endtime, count(*) AS cnt
FROM sensor GROUP BY id, {tumble_start('ts', '1 day')}"""

ORACLE["win_agg_moments"] = with_(SENSOR) + f"""SELECT id, {tumble_start('ts', '1 day')} AS starttime, count(val1) AS n,
  CAST(sum(val1) AS BIGINT) AS total, CAST(sum(val1 * val1) AS BIGINT) AS squares, min(val1) AS least, max(val1) AS most
FROM sensor GROUP BY id, {tumble_start('ts', '1 day')}"""

# ---- count windows -----------------------------------------------------------------------

ORACLE["count_tumble"] = with_(CAR) + """, r AS (SELECT *, row_number() OVER (PARTITION BY sensorId ORDER BY seq) AS rn
  FROM car)
SELECT sensorId, CAST(sum("count") AS BIGINT) AS "count", max(seq) AS last_seq
FROM r GROUP BY sensorId, (rn - 1) // 5 HAVING count(*) = 5""".replace("\n, r AS", ",\nr AS")

ORACLE["win_process_total"] = with_(CAR) + """, r AS (SELECT *, row_number() OVER (PARTITION BY sensorId ORDER BY seq) AS rn
  FROM car)
SELECT CAST(sum("count") AS BIGINT) AS total
FROM r GROUP BY sensorId, (rn - 1) // 5 HAVING count(*) = 5""".replace("\n, r AS", ",\nr AS")

ORACLE["count_slide"] = with_(CAR) + """, r AS (
  SELECT sensorId, row_number() OVER (PARTITION BY sensorId ORDER BY seq) AS rn,
         sum("count") OVER (PARTITION BY sensorId ORDER BY seq ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS s
  FROM car)
SELECT sensorId, CAST(s AS BIGINT) AS "count", rn AS end_position FROM r WHERE rn % 3 = 0""".replace(
    "\n, r AS", ",\nr AS")

ORACLE["count_global"] = with_(CAR) + """, r AS (SELECT *, row_number() OVER (ORDER BY seq) AS rn FROM car)
SELECT arg_min(sensorId, seq) AS sensorId, CAST(sum("count") AS BIGINT) AS "count", (rn - 1) // 5 + 1 AS window_no
FROM r GROUP BY (rn - 1) // 5 HAVING count(*) = 5""".replace("\n, r AS", ",\nr AS")

# ---- keyed state -------------------------------------------------------------------------

ORACLE["state_alert_all"] = "SELECT user_id AS id, event_id AS txn_id FROM events"

_FLAG = with_(TRANSACTION) + """, x AS (
  SELECT *, lag(amount) OVER w AS prev_amount, lag(ts) OVER w AS prev_ts
  FROM txn WINDOW w AS (PARTITION BY account_id ORDER BY ts, id))
SELECT account_id AS id, id AS txn_id, ts, amount FROM x
WHERE prev_amount < 5 AND amount > 50""".replace("\n, x AS", ",\nx AS")
ORACLE["state_prev_flag"] = _FLAG
ORACLE["state_flag_timer"] = _FLAG + " AND ts <= prev_ts + INTERVAL 3600 SECOND"


def _pattern(rules: list[tuple[str, str]]) -> str:
    values = ", ".join(f"('Rule_{i}', '{a}', '{b}')" for i, (a, b) in enumerate(rules))
    # Each item of the first shape matches the next item of the second shape after it.
    return f"""WITH rules(rule, first, second) AS (VALUES {values}),
f AS (SELECT r.rule, e.user_id, e.event_id AS seq FROM events e JOIN rules r ON e.event_type = r.first),
s AS (SELECT r.rule, e.user_id, e.event_id AS seq FROM events e JOIN rules r ON e.event_type = r.second)
SELECT f.rule, f.user_id, f.seq AS first_seq, min(s.seq) AS second_seq
FROM f JOIN s ON f.rule = s.rule AND f.user_id = s.user_id AND s.seq > f.seq
GROUP BY f.rule, f.user_id, f.seq"""


ORACLE["state_two_step_pattern"] = _pattern([("view", "purchase")])
ORACLE["rules_pattern"] = _pattern([("view", "purchase"), ("click", "click")])

ORACLE["wm_punctuated"] = with_(JITTER) + """, x AS (
  SELECT *, max(CASE WHEN id = 1 THEN ts - INTERVAL 60 SECOND END)
              OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS watermark
  FROM jitter)
SELECT seq, id, ts, watermark FROM x WHERE ts <= watermark""".replace("\n, x AS", ",\nx AS")

# ---- rules -------------------------------------------------------------------------------

ORACLE["rules_latest"] = with_(MESSAGE, KEYWORDS) + """, k AS (
  SELECT keyword, ts AS valid_from, lead(ts) OVER (ORDER BY ts NULLS FIRST) AS valid_to FROM keywords)
SELECT m.seq, m.message, k.keyword,
       '拦截消息:' || m.message || ', 是因为匹配到规则:' || k.keyword AS alert
FROM message m JOIN k ON (k.valid_from IS NULL OR m.ts >= k.valid_from) AND (k.valid_to IS NULL OR m.ts < k.valid_to)
WHERE contains(m.message, k.keyword)""".replace("\n, k AS", ",\nk AS")

ORACLE["rules_accumulate"] = with_(TRANSACTION, KEYWORDS) + """, fst AS (
  SELECT keyword, min(ts) AS ts FROM keywords WHERE ts IS NOT NULL GROUP BY keyword),
v AS (SELECT DISTINCT f.ts,
        (SELECT string_agg(g.keyword || ':' || g.keyword || ';', '' ORDER BY g.keyword)
         FROM fst g WHERE g.ts <= f.ts) AS rules
      FROM fst f),
iv AS (SELECT rules, ts AS valid_from, lead(ts) OVER (ORDER BY ts NULLS FIRST) AS valid_to
       FROM (SELECT NULL::TIMESTAMP AS ts, '' AS rules UNION ALL SELECT ts, rules FROM v) u)
SELECT t.id, t.account_id, coalesce(iv.rules, '') AS rules
FROM txn t LEFT JOIN iv ON (iv.valid_from IS NULL OR t.ts >= iv.valid_from)
                       AND (iv.valid_to IS NULL OR t.ts < iv.valid_to)""".replace("\n, fst AS", ",\nfst AS")

ORACLE["rules_snapshot"] = with_(USER_INFO) + """, d AS (
  SELECT *, (SELECT min(n.valid_from) FROM user_info n WHERE n.valid_from > u.valid_from) AS valid_to FROM user_info u)
SELECT d.userId, e.ts AS eventTime, e.event_type AS eventType, e.event_id AS productId, d.userName, d.userAge
FROM events e JOIN d ON e.user_id = d.userId AND e.ts >= d.valid_from
                    AND (d.valid_to IS NULL OR e.ts < d.valid_to)""".replace("\n, d AS", ",\nd AS")

# ---- scalar jobs, sources, sinks ---------------------------------------------------------

ORACLE["map_cos_cbrt"] = "SELECT cos(cbrt(CAST(l_orderkey AS DOUBLE))) AS value FROM lineitem"

ORACLE["src_text_csv"] = """SELECT split_part(v, ',', 1) AS sensorId, CAST(split_part(v, ',', 2) AS INTEGER) AS count
FROM (SELECT concat_ws(',', event_type, CAST(floor(value) AS INTEGER)) AS v FROM events) t"""

ORACLE["sink_keyed_upsert"] = """SELECT CAST(user_id AS VARCHAR) AS rowkey, max(event_id) AS id,
  arg_max(event_type, event_id) AS name
FROM events GROUP BY user_id"""

ORACLE["src_events"] = with_(PERSON, AUCTION, BID) + """SELECT 0 AS event_type, count(*) AS events,
  max(dateTime) AS last_time FROM person
UNION ALL SELECT 1, count(*), max(dateTime) FROM auction
UNION ALL SELECT 2, count(*), max(dateTime) FROM bid"""

ORACLE["running_sum_values"] = """SELECT value, row_number() OVER (PARTITION BY value) AS occurrence
FROM (SELECT cos(cbrt(CAST(l_orderkey AS DOUBLE))) AS value FROM lineitem) v"""

ORACLE["map_tostring"] = with_(ORDER_ITEM, GOODS) + f"""SELECT concat('OrderDetails(goodsId=', o.goodsId,
  ', goodsName=', g.goodsName, ', count=', CAST(o.count AS VARCHAR),
  ', totalMoney=', CAST(g.goodsPrice * o.count AS VARCHAR), ')') AS text
FROM order_item o JOIN goods g
  ON o.goodsId = g.goodsId AND {tumble_start('o.ts', '30 days')} = {tumble_start('g.ts', '30 days')}"""

for _name, _cte in (("person", PERSON), ("auction", AUCTION), ("bid", BID)):
    ORACLE[f"view_{_name}"] = with_(_cte) + f"SELECT * FROM {_name}"

ORACLE["src_text_lines"] = ORACLE["src_text_csv"]

ORACLE["sink_text_append"] = "SELECT props AS value, strftime(ts, '%Y-%m-%d') AS dt FROM events"

ORACLE["sink_json_nested"] = "SELECT CAST(user_id AS VARCHAR) AS rowkey, event_id AS id, event_type AS name FROM events"

ORACLE["sink_partitioned_table"] = """SELECT event_id AS id, value AS score, event_type AS kind
FROM events WHERE event_type IN ('view', 'click')"""

ORACLE["sink_upsert_merge"] = """SELECT CAST(user_id AS VARCHAR) AS rowkey,
  arg_max(event_id, (event_id % 2, event_id)) AS id, arg_max(event_type, (event_id % 2, event_id)) AS name
FROM events GROUP BY user_id"""
ORACLE["sink_upsert_log"] = ORACLE["sink_upsert_merge"].replace("event_id % 2", "event_id % 7")
