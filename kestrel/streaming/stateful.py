"""Keyed stateful processors for ``transformWithStateInPandas`` (state in the RocksDB
state store, checkpointed with the query).

Within a micro-batch the rows of a key are processed in their sequence order, so the
result equals the batch form (``kestrel.operators.state`` / ``counts``) whatever the
batch boundaries are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from kestrel.streaming.keys import KEY, key_column

FLAG_OUTPUT = T.StructType([
    T.StructField("txn_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("amount", T.DoubleType()),
])

COUNT_OUTPUT = T.StructType([
    T.StructField("count", T.LongType()),
    T.StructField("last_seq", T.LongType()),
])



class FlagProcessor(StatefulProcessor):
    """Fraud rule: alert on an amount above ``large`` right after one below ``small`` of
    the same account (within ``timeout_seconds`` when given).

    State: the account's previous transaction (amount, time). With a timeout an
    event-time timer at ``previous time + timeout`` drops the state when the watermark
    passes it: no later row could use it any more.
    """

    def __init__(self, small: float, large: float, timeout_seconds: int | None):
        self.small, self.large, self.timeout = small, large, timeout_seconds

    def init(self, handle) -> None:
        self.handle = handle
        self.prev = handle.getValueState("prev", "amount double, ts_us long")

    def handleInputRows(self, key, rows, timerValues):
        batch = pd.concat(list(rows), ignore_index=True).sort_values(["ts", "id"], kind="stable")
        amount = batch["amount"].to_numpy(dtype=float)
        ts_us = batch["ts"].astype("datetime64[us]").astype("int64").to_numpy()
        first_amount, first_ts = self.prev.get() if self.prev.exists() else (np.nan, 0)
        prev_amount = np.concatenate([[first_amount], amount[:-1]])
        prev_ts = np.concatenate([[first_ts], ts_us[:-1]])
        hit = (prev_amount < self.small) & (amount > self.large)
        if self.timeout is not None:
            timeout_us = self.timeout * 1_000_000
            hit &= ts_us <= prev_ts + timeout_us
        self.prev.update((float(amount[-1]), int(ts_us[-1])))
        if self.timeout is not None:
            for t in self.handle.listTimers():
                self.handle.deleteTimer(t)
            # Fires once the watermark passes the last moment the state can matter (ms).
            self.handle.registerTimer((int(ts_us[-1]) + timeout_us) // 1000 + 1)
        alerts = batch[hit]
        yield pd.DataFrame({KEY: key_column(key, len(alerts)),
                            "txn_id": alerts["id"].astype("int64").to_numpy(),
                            "ts": alerts["ts"].to_numpy(), "amount": alerts["amount"].to_numpy()})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.prev.clear()
        yield pd.DataFrame(columns=[KEY, "txn_id", "ts", "amount"])

    def close(self) -> None:
        pass


class CountWindowProcessor(StatefulProcessor):
    """Count window: every ``size`` rows of a key emit their sum; the partial window
    (fewer than ``size`` rows) waits in state. Rows need ``seq`` and ``count``."""

    def __init__(self, size: int, ttl_ms: int | None = None):
        self.size, self.ttl_ms = size, ttl_ms

    def init(self, handle) -> None:
        self.pending = handle.getValueState("pending", "n long, total long", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        batch = pd.concat(list(rows), ignore_index=True).sort_values("seq", kind="stable")
        n0, total0 = self.pending.get() if self.pending.exists() else (0, 0)
        counts = batch["count"].to_numpy(dtype="int64")
        pos = n0 + np.arange(1, len(counts) + 1)          # position inside the open windows
        run = total0 + np.cumsum(counts)                   # running total since the last emit
        ends = np.flatnonzero(pos % self.size == 0)
        before = np.concatenate([[0], run[ends[:-1]]]) if len(ends) else np.array([], dtype="int64")
        sums = run[ends] - before
        last = len(counts) - 1
        if len(ends):
            self.pending.update((int(pos[last] - pos[ends[-1]]), int(run[last] - run[ends[-1]])))
        else:
            self.pending.update((int(pos[last]), int(run[last])))
        yield pd.DataFrame({KEY: key_column(key, len(ends)), "count": sums.astype("int64"),
                            "last_seq": batch["seq"].to_numpy(dtype="int64")[ends]})

    def close(self) -> None:
        pass


class TopKProcessor(StatefulProcessor):
    """Top ``k`` rows per key (q19; q18 is k = 1 ordered by time descending).

    State: the current top rows of the key, forgotten ``ttl_ms`` after their last change if that is given.
    Each micro-batch merges them with the new
    rows, keeps ``k`` and emits the key's new top list with ranks (output mode Update:
    the latest list of a key is its answer).
    """

    def __init__(self, k: int, columns: list[str], order: list[str], ascending: list[bool],
                 state_schema: str, rank_col: str | None = "rank_number", ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms
        self.k, self.columns, self.order, self.ascending = k, columns, order, ascending
        self.state_schema, self.rank_col = state_schema, rank_col

    def init(self, handle) -> None:
        self.top = handle.getListState("top", self.state_schema, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        new = pd.concat(list(rows), ignore_index=True)[self.columns]
        old = pd.DataFrame(list(self.top.get()), columns=self.columns) if self.top.exists() else None
        allrows = new if old is None or old.empty else pd.concat([old, new], ignore_index=True)
        best = allrows.sort_values(self.order, ascending=self.ascending, kind="stable").head(self.k)
        best = best.reset_index(drop=True)
        self.top.put([tuple(r) for r in best.itertuples(index=False)])
        if self.rank_col:
            best[self.rank_col] = np.arange(1, len(best) + 1, dtype="int64")
        yield best

    def close(self) -> None:
        pass


class PatternProcessor(StatefulProcessor):
    """Two-step shape pattern per key for a fixed rule list ``[(name, first, second)]``.

    State: pending first items per rule. In a batch (rows in ``seq`` order) every first
    item — pending ones before all new rows — matches the next second item after it
    (``searchsorted``); unmatched ones stay pending. Same as the batch form.
    """

    def __init__(self, rules: list[tuple[str, str, str]], shape: str = "shape", seq: str = "seq"):
        self.rules, self.shape, self.seq = rules, shape, seq

    def init(self, handle) -> None:
        self.pending = handle.getListState("pending", "rule string, seq long")

    def handleInputRows(self, key, rows, timerValues):
        batch = pd.concat(list(rows), ignore_index=True).sort_values(self.seq, kind="stable")
        shapes, seqs = batch[self.shape].to_numpy(), batch[self.seq].to_numpy(dtype="int64")
        old = list(self.pending.get()) if self.pending.exists() else []
        out, keep = [], []
        for name, first, second in self.rules:
            waiting = np.array([s for r, s in old if r == name], dtype="int64")
            firsts = np.concatenate([waiting, seqs[shapes == first]])
            seconds = seqs[shapes == second]
            # a pending item precedes every new row; new firsts look strictly after themselves
            pos = np.concatenate([np.zeros(len(waiting), dtype="int64"),
                                  np.searchsorted(seconds, seqs[shapes == first], side="right")])
            hit = pos < len(seconds)
            out += [(name, f, int(seconds[p])) for f, p in zip(firsts[hit], pos[hit])]
            keep += [(name, int(f)) for f in firsts[~hit]]
        self.pending.put(keep) if keep else self.pending.clear()
        yield pd.DataFrame({KEY: key_column(key, len(out)), "rule": pd.Series([r for r, _, _ in out], dtype=object),
                            "first_seq": np.array([f for _, f, _ in out], dtype="int64"),
                            "second_seq": np.array([s for _, _, s in out], dtype="int64")})

    def close(self) -> None:
        pass


class RunningSumProcessor(StatefulProcessor):
    """Keyed running sum, one row out per row in: the fields of the key's first row and
    the running total (exact: summed as integers of 10^-scale)."""

    def __init__(self, seq: str, value: str, keep: list[str], scale: int = 2):
        self.seq, self.value, self.keep, self.scale = seq, value, keep, scale

    def init(self, handle) -> None:
        self.first = handle.getValueState("first", ", ".join(f"{c} long" for c in self.keep))
        self.total = handle.getValueState("total", "units long")

    def handleInputRows(self, key, rows, timerValues):
        batch = pd.concat(list(rows), ignore_index=True).sort_values(self.seq, kind="stable")
        unit = 10 ** self.scale
        units = np.round(batch[self.value].to_numpy(dtype=float) * unit).astype("int64")
        start = self.total.get()[0] if self.total.exists() else 0
        run = start + np.cumsum(units)
        if not self.first.exists():
            self.first.update(tuple(int(batch[c].iloc[0]) for c in self.keep))
        first = self.first.get()
        self.total.update((int(run[-1]),))
        out = {KEY: key_column(key, len(batch)), **{c: np.full(len(batch), first[i], dtype="int64") for i, c in enumerate(self.keep)}}
        out.update({self.value: run / unit,
                    f"row_{self.seq}": batch[self.seq].to_numpy(dtype="int64")})
        yield pd.DataFrame(out)

    def close(self) -> None:
        pass


class SlidingCountProcessor(StatefulProcessor):
    """Count window of ``size`` rows sliding every ``slide`` rows, per key: every
    ``slide``-th row emits the sum of the last ``size`` rows (fewer at the start).
    State: the row count so far and the last ``size - 1`` values."""

    def __init__(self, size: int, slide: int, seq: str = "seq", value: str = "count"):
        self.size, self.slide, self.seq, self.value = size, slide, seq, value

    def init(self, handle) -> None:
        self.n = handle.getValueState("n", "n long")
        self.tail = handle.getListState("tail", "v long")

    def handleInputRows(self, key, rows, timerValues):
        batch = pd.concat(list(rows), ignore_index=True).sort_values(self.seq, kind="stable")
        n0 = self.n.get()[0] if self.n.exists() else 0
        tail = np.array([t[0] for t in self.tail.get()], dtype="int64") if self.tail.exists() else np.zeros(0, "int64")
        vals = np.concatenate([tail, batch[self.value].to_numpy(dtype="int64")])
        csum = np.concatenate([[0], np.cumsum(vals)])
        pos = n0 + np.arange(1, len(batch) + 1)            # 1-based position of each new row
        idx = len(tail) + np.arange(len(batch))             # its index in ``vals``
        ends = np.flatnonzero(pos % self.slide == 0)
        lo = np.maximum(idx[ends] - self.size + 1, 0)
        sums = csum[idx[ends] + 1] - csum[lo]
        self.n.update((int(pos[-1]),))
        self.tail.put([(int(v),) for v in vals[-(self.size - 1):]] if self.size > 1 else [])
        yield pd.DataFrame({KEY: key_column(key, len(ends)), self.value: sums.astype("int64"),
                            "end_position": pos[ends].astype("int64")})

    def close(self) -> None:
        pass


class LivePatternProcessor(StatefulProcessor):
    """Two-step pattern under changing rules for the keys of one slot, in event time.

    State: rows the watermark has not passed yet, the rules with the time of their current version, and
    the first items pending per (key, rule). A new version of a rule, or its removal, clears what
    the old one had pending.
    """

    COLUMNS = ["key", "seq", "shape", "rule", "first", "second"]  # text; a row with seq is an item

    def __init__(self, out: list[str]):
        self.out = out

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "ts_us long, kind int, key string, seq long, shape string, "
                                                      "rule string, first string, second string")
        self.rules = handle.getMapState("rules", "rule string", "ts_us long, first string, second string")
        self.pending = handle.getListState("pending", "key string, rule string, seq long")

    def handleInputRows(self, key, rows, timerValues):
        new = []
        for part in rows:
            us = part["ts"].astype("datetime64[us]").astype("int64").tolist()
            cols = [part[c].astype(object).where(part[c].notna(), None).tolist() for c in self.COLUMNS]
            new += [(t, int(q is not None), k, None if q is None else int(q), *r) for t, (k, q, *r) in zip(us, zip(*cols))]
        if new:
            self.waiting.appendList(new)
        yield self._advance(timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield self._advance(timerValues)

    def _advance(self, timerValues) -> pd.DataFrame:
        """Handles what the watermark has passed, in order of time (rules first), then of sequence."""
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        rows = [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []
        ready = sorted((r for r in rows if r[0] < passed), key=lambda r: (r[0], r[1], r[3] or 0, str(r[5]), str(r[6] or ""), str(r[7] or "")))
        out = self._handle(ready) if ready else []
        if ready:
            left = [r for r in rows if r[0] >= passed]
            self.waiting.put(left) if left else self.waiting.clear()
            rows = left
        for t in self.handle.listTimers():
            self.handle.deleteTimer(t)
        if rows:
            self.handle.registerTimer(min(r[0] for r in rows) // 1000 + 1)
        return pd.DataFrame({c: pd.Series([r[i] for r in out], dtype=object if i < 2 else "int64") for i, c in enumerate(self.out)})

    def _handle(self, ready: list[tuple]) -> list[tuple]:
        rules = {k[0]: tuple(v) for k, v in self.rules.iterator()} if self.rules.exists() else {}
        pending: dict[tuple, list[int]] = {}
        for k, rule, q in (tuple(p) for p in self.pending.get()) if self.pending.exists() else ():
            pending.setdefault((k, rule), []).append(q)
        out = []
        for ts, is_item, k, q, shape, rule, first, second in ready:
            if not is_item:
                now = rules.get(rule)
                if now is not None and now[0] == ts and first is None:
                    continue  # a removal beside a change of the same time does not count
                rules[rule] = (ts, first, second)
                pending = {p: s for p, s in pending.items() if p[1] != rule}
                continue
            for name, (_, a, b) in rules.items():
                if a is None:
                    continue
                if shape == b:
                    out += [(name, k, p, q) for p in pending.pop((k, name), [])]
                if shape == a:
                    pending.setdefault((k, name), []).append(q)
        for name in [n for n, v in rules.items() if v[1] is None]:
            del rules[name]
            if self.rules.containsKey((name,)):
                self.rules.removeKey((name,))
        for name, v in rules.items():
            self.rules.updateValue((name,), v)
        flat = [(k, rule, q) for (k, rule), qs in pending.items() for q in qs]
        self.pending.put(flat) if flat else self.pending.clear()
        return out

    def close(self) -> None:
        pass
