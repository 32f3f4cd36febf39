"""A user's own mergeable accumulator over groups.

The contract is that of an incremental aggregate: ``create`` an empty state, ``add`` rows to it, ``merge``
two states, ``result`` of one. Rows are added where they are read: each task keeps one state a key
(sent on when ``held`` keys are there, so its memory is bounded) and only states are shuffled, in
two steps. First they meet by (key, slice of the tasks), then the slices of a key. No worker
ever gets the rows of a key; of a hot key a task sends one state, like of any other.
"""

from __future__ import annotations

import pickle
from abc import ABC, abstractmethod
from collections.abc import Iterator
from itertools import islice
from typing import Any

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HELD = 10_000
SLICES = 16


class Accumulator(ABC):
    """States must pickle; ``add`` and ``merge`` return the state to go on with, and their order must not matter."""

    @abstractmethod
    def create(self) -> Any: ...

    @abstractmethod
    def add(self, state: Any, rows: pd.DataFrame) -> Any:
        """``rows`` are some rows of one key: the value columns, in a pandas frame."""

    @abstractmethod
    def merge(self, a: Any, b: Any) -> Any: ...

    @abstractmethod
    def result(self, state: Any) -> tuple:
        """The values of the output columns."""


class Count(Accumulator):
    """The reference's own: a number of rows."""

    def create(self) -> int:
        return 0

    def add(self, state: int, rows: pd.DataFrame) -> int:
        return state + len(rows)

    def merge(self, a: int, b: int) -> int:
        return a + b

    def result(self, state: int) -> tuple:
        return (state,)


class Moments(Accumulator):
    """Count, sum and sum of squares of a whole-number column, exactly; and its least and greatest value."""

    def __init__(self, column: str):
        self.column = column

    def create(self) -> tuple:
        return 0, 0, 0, None, None

    def add(self, state: tuple, rows: pd.DataFrame) -> tuple:
        v = [int(x) for x in rows[self.column].to_numpy() if x == x and x is not None]
        if not v:
            return state
        return self.merge(state, (len(v), sum(v), sum(x * x for x in v), min(v), max(v)))

    def merge(self, a: tuple, b: tuple) -> tuple:
        if not a[0] or not b[0]:
            return a if a[0] else b
        return a[0] + b[0], a[1] + b[1], a[2] + b[2], min(a[3], b[3]), max(a[4], b[4])

    def result(self, state: tuple) -> tuple:
        return state


def accumulate(df: DataFrame, keys: list[str], values: list[str], acc: Accumulator, result: str,
               held: int = HELD, slices: int = SLICES) -> DataFrame:
    """(keys, result columns) of each group of ``keys``; ``result`` is a DDL schema. NULL keys are keys.

    ``keys`` may hold expressions' columns only (windows: select them first). An empty table gives no rows.
    """
    if not keys:
        raise ValueError("accumulate needs a key; add a constant one for a whole table")
    texts = F.to_json(F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]), {"ignoreNullFields": "false"})
    rows = df.select(texts.alias("_key"), *values)

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held_states = TaskContext.get().partitionId() % slices, {}
        for frame in frames:
            frame = frame.sort_values("_key", kind="stable", ignore_index=True)
            key = frame["_key"].to_numpy(dtype=object)
            first = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist()] if len(key) else []
            only = frame[values]
            for lo, hi in zip(first, [*first[1:], len(key)]):
                k = key[lo]
                held_states[k] = acc.add(held_states[k] if k in held_states else acc.create(), only.iloc[lo:hi])
                if len(held_states) >= held:
                    yield packed(list(held_states.items()), part)
                    held_states = {}
        yield packed(list(held_states.items()), part)

    def packed(pairs: list[tuple[str, Any]], part: int) -> pd.DataFrame:
        return pd.DataFrame({"_key": pd.Series([k for k, _ in pairs], dtype=object), "_slice": pd.Series([part] * len(pairs), dtype="int32"),
                             "_state": pd.Series([pickle.dumps(s) for _, s in pairs], dtype=object)})

    def merged(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[tuple, Any]]:
        """(key, slice) and state, from states sorted by them; one state is held."""
        at, state = None, None
        for frame in frames:
            for key, part, raw in zip(frame["_key"], frame["_slice"], frame["_state"]):
                if at == (key, part):
                    state = acc.merge(state, pickle.loads(raw))
                    continue
                if at is not None:
                    yield at, state
                at, state = (key, part), pickle.loads(raw)
        if at is not None:
            yield at, state

    def some(pairs: Iterator, n: int = 4096) -> Iterator[list]:
        while chunk := list(islice(pairs, n)):
            yield chunk

    def together(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in some(merged(frames)):
            yield packed([(key, state) for (key, _), state in chunk], 0)

    def finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in some(merged(frames)):
            done = list(zip(*(acc.result(state) for _, state in chunk)))
            yield pd.DataFrame({"_key": pd.Series([key for (key, _), _ in chunk], dtype=object),
                                **{f.name: pd.Series(v, dtype=object) for f, v in zip(out, done)}})

    out = T._parse_datatype_string(result)
    states = "_key string, _slice int, _state binary"
    by = lambda df, *cols: df.repartition(*cols).sortWithinPartitions("_key", "_slice")
    fewer = by(rows.mapInPandas(partial, states), "_key", "_slice").mapInPandas(together, states)
    done = by(fewer, "_key").mapInPandas(finish, T.StructType([T.StructField("_key", T.StringType()), *out.fields]))
    inner = T.StructType([T.StructField(f"k{i}", df.schema[k].dataType) for i, k in enumerate(keys)])
    done = done.withColumn("_key", F.from_json("_key", inner))
    return done.select(*[F.col("_key")[f"k{i}"].alias(k) for i, k in enumerate(keys)], *out.names)
