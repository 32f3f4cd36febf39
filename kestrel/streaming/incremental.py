"""Streaming aggregates whose work depends on the micro-batch only: chained stateful processors.

Spark refuses exact distinct counts and aggregates of aggregates on streams. Here a first processor
turns rows into *changes* of what they belong to, and a second one adds the changes up:

* ``band_stats`` (q15, q16): a map of values seen so far, with one bit a price band, answers which
  distinct counts a row raises; a hot group is spread over ``SLOTS`` slots of its values. The second
  processor keeps one row of totals a group.
* ``avg_of_max`` (q4): the maximum of each auction; a higher bid takes the old maximum back and adds
  the new one to the category's sum.

State is in the query's checkpoint, so a killed batch is run again from the state before it. Nothing
is read back from earlier output. Each micro-batch emits the new row of every group it changed (the
latest row of a group is its answer). NULL groups and values count as in the batch forms.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from kestrel.operators import aggs
from kestrel.streaming.keys import KEY, key_column, process

SLOTS = 64
BANDS = ("total", "rank1", "rank2", "rank3")
MEASURES = [f"{c}_{tag}" for tag in ("bids", *(f"{t}s" for t in aggs.TAGS)) for c in BANDS]
CHANGES = T.StructType([T.StructField(m, T.LongType()) for m in [*MEASURES, "minute"]])


class NewValues(StatefulProcessor):
    """Changes of a group's measures by the rows of one slot of its values.

    State: value -> bits seen (1: any bid, 2, 4, 8: a bid of band 1, 2, 3). Rows carry their bits.
    """

    def init(self, handle) -> None:
        self.seen = handle.getMapState("seen", "value long", "bits int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        change, bits_now = dict.fromkeys(MEASURES, 0), {}
        minute = None
        tag = key[1]
        for part in rows:  # batch by batch: only the values' bits are kept
            if tag == aggs.TAGS[0]:  # each bid is counted once
                for i, name in enumerate(BANDS):
                    change[f"{name}_bids"] += int((part["bits"].to_numpy() >> i & 1).sum())
                latest = part["minute"].max()
                minute = latest if minute is None or latest > minute else minute
            known = part[part["value"].notna()]
            for value, bits in set(zip(known["value"].astype("int64").tolist(), known["bits"].tolist())):
                bits_now[value] = bits_now.get(value, 0) | bits
        for value, bits in bits_now.items():
            old = self.seen.getValue((value,))[0] if self.seen.containsKey((value,)) else 0
            if bits & ~old:
                self.seen.updateValue((value,), (old | bits,))
                for i, name in enumerate(BANDS):
                    change[f"{name}_{tag}s"] += (bits & ~old) >> i & 1
        yield pd.DataFrame({KEY: key_column(key, 1), **{m: [change[m]] for m in MEASURES},
                            "minute": pd.array([None if minute is None or pd.isna(minute) else int(minute)], dtype="Int64")})

    def close(self) -> None:
        pass


class Totals(StatefulProcessor):
    """Adds up changes: one row of totals a group, emitted when it changes."""

    def init(self, handle) -> None:
        self.total = handle.getValueState("total", ", ".join(f"{m} long" for m in [*MEASURES, "minute"]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        old = list(self.total.get()) if self.total.exists() else [0] * len(MEASURES) + [None]
        for part in rows:
            for i, m in enumerate(MEASURES):
                old[i] += int(part[m].sum())
            latest = part["minute"].max()
            if not pd.isna(latest):
                old[-1] = int(latest) if old[-1] is None else max(old[-1], int(latest))
        self.total.update(tuple(old))
        yield pd.DataFrame({KEY: key_column(key, 1), **dict(zip(MEASURES, ([v] for v in old))), "minute": pd.array([old[-1]], dtype="Int64")})

    def close(self) -> None:
        pass


def band_stats(bids: DataFrame, keys: list[str], with_minute: bool = False, slots: int = SLOTS) -> DataFrame:
    """q15 (``keys=[]``) / q16 (``keys=["channel"]``, ``with_minute``) on a stream, output mode Append."""
    r = aggs.bands()
    bit = lambda c, n: F.when(c, F.lit(1 << n)).otherwise(F.lit(0))
    bits = F.lit(1) + bit(r[0], 1) + bit(r[1], 2) + bit(r[2], 3)
    minute = F.hour("dateTime") * 60 + F.minute("dateTime")
    tagged = F.array(*[F.struct(F.lit(t).alias("tag"), F.col(t).cast("long").alias("value")) for t in aggs.TAGS])
    group = [*keys, "day"]
    x = bids.select(*keys, F.date_format("dateTime", "yyyy-MM-dd").alias("day"), bits.alias("bits"),
                    minute.cast("long").alias("minute"), F.explode(tagged).alias("_t"))
    x = x.select(*group, F.col("_t.tag").alias("tag"), F.col("_t.value").alias("value"), "bits", "minute")
    x = x.withColumn("slot", F.pmod(F.xxhash64("value"), F.lit(slots)).cast("int"))
    changes = process(x, group, NewValues(), CHANGES, extra_keys=("tag", "slot"))
    totals = process(changes, group, Totals(), CHANGES)
    return totals.select(*group, *([aggs.clock(F.col("minute")).alias("minute")] if with_minute else []), *MEASURES)


class MaxChanges(StatefulProcessor):
    """Per auction: takes its old maximum back from its category and adds the new one."""

    def init(self, handle) -> None:
        self.best = handle.getValueState("best", "price long, counted int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        old, known = self.best.get() if self.best.exists() else (None, 0)
        new = old
        for part in rows:
            price = part["price"].max()
            if not pd.isna(price) and (new is None or int(price) > new):
                new = int(price)
        if known and new == old:
            return
        self.best.update((new, 1))
        yield pd.DataFrame({KEY: key_column(key, 1), "d_sum": [(new or 0) - (old or 0)], "d_count": [int(new is not None) - int(old is not None)]})

    def close(self) -> None:
        pass


class Mean(StatefulProcessor):
    """Sum and count of a group under changes; emits the truncated mean (NULL without a value)."""

    def init(self, handle) -> None:
        self.total = handle.getValueState("total", "s long, n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        s, n = self.total.get() if self.total.exists() else (0, 0)
        for part in rows:
            s, n = s + int(part["d_sum"].sum()), n + int(part["d_count"].sum())
        self.total.update((s, n))
        mean = None if n == 0 else (abs(s) // n) * (1 if s >= 0 else -1)
        yield pd.DataFrame({KEY: key_column(key, 1), "final": pd.array([mean], dtype="Int64")})

    def close(self) -> None:
        pass


def avg_of_max(joined: DataFrame) -> DataFrame:
    """q4 on a stream of joined rows (id, category, price), output mode Append: id, final.

    ``joined`` may come from a stream-stream join (``streaming.jobs``); the order of bids does not matter.
    """
    x = joined.select("id", "category", F.col("price").cast("long").alias("price"))
    longs = lambda *names: T.StructType([T.StructField(n, T.LongType()) for n in names])
    changes = process(x, ["id", "category"], MaxChanges(), longs("d_sum", "d_count"))
    return process(changes, ["category"], Mean(), longs("final")).withColumnRenamed("category", "id")
