"""Streams with state of their own kind per key.

Rows of a key are held back until the watermark has passed them and are then applied in event
time, so the result equals the batch operator on the same rows whatever the arrival order. The
rows held per key span at most the watermark delay. Needs the RocksDB state store.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidegrid.functions.columns import event_time


#: Width of the time buckets at whose borders waiting rows are cut where rows are dense.
BUCKET_MS = 60_000
#: Rows of a piece at most; a key with no more waiting rows has them beside its index.
PIECE_ROWS = 2048
#: Rows of one key that are sorted at a time when they arrive, and that are applied at a time.
SORT_ROWS, APPLY_ROWS = 1 << 18, 1 << 13
#: Stands for a tie that is null: before all others.
NO_TIE = -(2**63)


def _cuts(at: np.ndarray) -> list[tuple[int, int]]:
    """Where rows in order of time are cut into pieces: at the border of a time bucket if a piece is well filled by then."""
    borders, out, begin = np.flatnonzero(np.diff(at // 1000 // BUCKET_MS)) + 1, [], 0
    while len(at) - begin > PIECE_ROWS:
        end = begin + PIECE_ROWS
        last = int(np.searchsorted(borders, end, "right")) - 1
        if last >= 0 and borders[last] > begin + PIECE_ROWS // 2:
            end = int(borders[last])
        out.append((begin, end))
        begin = end
    return [*out, (begin, len(at))]


class InOrder(StatefulProcessor):
    """Hold rows back, release them in order of (time, tie), hand them to ``apply``.

    Calls to the state store cost far more than the rows they carry, so a key has one entry: its waiting rows, packed, as long as
    they are few. More rows lie in sorted pieces, and the entry keeps where each begins. A key has one timer, for its earliest
    row. It merges the pieces that begin by the mark in order of time, holding those that overlap, and only what such pieces hold
    beyond the mark is written again.
    """

    #: Whether only the last row that ``apply`` sends for a mark counts.
    last_only = False

    def __init__(self, key: Sequence[str], payload: str, state: str):
        self.key, self.state = list(key), state
        kinds = {"boolean": "?", "double": "f8", "long": "i8"}
        self.kind = [("at", "i8"), ("tie", "i8"), *((name, kinds[t]) for name, t in (f.split() for f in payload.split(",")))]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "rows binary, pieces binary, following long, timer long")
        self.pieces = handle.getMapState("pieces", "number long", "rows binary")
        self.value = handle.getValueState("value", self.state)

    def _unpack(self, raw: bytes) -> np.ndarray:
        return np.frombuffer(raw, self.kind)

    def _sorted(self, *parts: np.ndarray) -> np.ndarray:
        rows = np.concatenate(parts) if len(parts) > 1 else parts[0]
        return rows[np.lexsort([rows[name] for name, _ in reversed(self.kind)])]

    def _load(self) -> tuple[np.ndarray, np.ndarray, int, int | None]:
        """Rows beside the index, the index (begin, number, rows of each piece), the next number, and the timer that is set."""
        found = self.held.get()
        if found is None:
            return self._unpack(b""), np.zeros((0, 3), np.int64), 0, None
        return self._unpack(found[0]), np.frombuffer(found[1], np.int64).reshape(-1, 3), found[2], found[3]

    def _store(self, rows: np.ndarray, index: np.ndarray, following: int, timer: int | None) -> None:
        """Keep sorted rows; all but the last piece of them go to the map. Sets the timer if none as early is set."""
        if not len(rows) and not len(index):
            self.held.clear()
            return
        *full, (begin, end) = _cuts(rows["at"])
        added = []
        for a, b in full:
            self.pieces.updateValue((following,), (rows[a:b].tobytes(),))
            added.append((int(rows["at"][a]), following, b - a))
            following += 1
        index = np.concatenate([index, np.array(added, np.int64).reshape(-1, 3)])
        first = min([*rows["at"][:1].tolist(), *index[:, 0].tolist()]) // 1000
        if timer is None or first < timer:
            self.handle.registerTimer(first)
            timer = first
        self.held.update((rows[begin:end].tobytes(), index.tobytes(), following, timer))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        mark, fresh, n = timerValues.getCurrentWatermarkInMs(), [], 0
        for pdf in rows:
            pdf = pdf[pdf["at"] // 1000 > mark]  # stream_late_rows keeps the others
            part = np.empty(len(pdf), self.kind)
            for name, _ in self.kind:
                part[name] = pdf[name].to_numpy()
            fresh.append(part)
            n += len(part)
            if n >= SORT_ROWS:
                self._take(fresh)
                fresh, n = [], 0
        if n:
            self._take(fresh)
        return iter(())

    def _take(self, fresh: list[np.ndarray]) -> None:
        rows, index, following, timer = self._load()
        self._store(self._sorted(rows, *fresh), index, following, timer)

    def _due(self, rows: np.ndarray, index: np.ndarray, mark: int, rest: list[np.ndarray]) -> Iterator[np.ndarray]:
        """Rows up to the mark in order; those behind it that came with them go to ``rest``."""
        at = 0
        while True:
            loaded, n = [rows], 0
            while at < len(index) and n < max(PIECE_ROWS, len(rows)):
                number = (int(index[at, 1]),)
                loaded.append(self._unpack(self.pieces.getValue(number)[0]))
                self.pieces.removeKey(number)
                n += len(loaded[-1])
                at += 1
            rows = self._sorted(*loaded)
            last = at == len(index)
            bound = (mark + 1) * 1000 if last else int(index[at, 0])  # a piece that is not here may hold an equal time
            ready = int(np.searchsorted(rows["at"], bound))
            for begin in range(0, ready, APPLY_ROWS):
                yield rows[begin : min(begin + APPLY_ROWS, ready)]
            rows = rows[ready:]
            if last:
                rest.append(rows)
                return

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        rows, index, following, timer = self._load()
        mark = timerValues.getCurrentWatermarkInMs()
        if timer is None or timer > mark:
            return  # an earlier timer has seen to these rows
        begun = index[:, 0] // 1000 <= mark
        due, rest = index[begun], []
        due = due[np.argsort(due[:, 0], kind="stable")]
        state, sent, begin = self.value.get(), None, True
        for part in self._due(rows, due, mark, rest):
            state, out = self.apply(state, part)
            begin = False
            if len(out):
                for i, k in enumerate(self.key):
                    out.insert(i, k, key[i])
                if not self.last_only:
                    yield out
                sent = out
        if self.last_only and sent is not None:
            yield sent
        if not begin:
            self.value.update(state) if state is not None else self.value.clear()
        self._store(rest[0], index[~begun], following, None)

    def apply(self, state: tuple | None, rows: np.ndarray) -> tuple[tuple | None, pd.DataFrame]:
        """Take in rows that are next in order; the key's new state (or None) and the rows to send."""
        raise NotImplementedError

    def close(self) -> None:
        pass


def _in_order(
    df: DataFrame, key: Sequence[str], ts: str, tie: str, watermark: str,
    payload: dict[str, Column], processor: InOrder, output: str,
) -> DataFrame:
    rows = (
        df.withColumn(ts, event_time(ts))
        .filter(F.col(ts).isNotNull())  # stream_late_rows keeps these
        .withWatermark(ts, watermark)
        .select(
            *key, ts, F.unix_micros(ts).alias("at"), F.coalesce(F.col(tie).cast("long"), F.lit(NO_TIE)).alias("tie"),
            *[c.alias(n) for n, c in payload.items()],
        )
    )
    keys = T.StructType([rows.schema[k] for k in key])
    schema = T.StructType(keys.fields + T._parse_datatype_string(output).fields)
    out = (
        rows.groupBy(*key)
        .transformWithStateInPandas(processor, schema, "Append", "EventTime")
        .withColumn(ts, F.timestamp_micros("at"))
        .drop("at")
    )
    return out.withColumn("tie", F.nullif("tie", F.lit(NO_TIE))) if "tie" in out.columns else out


class _Streaks(InOrder):
    def __init__(self, key, limit: int):
        super().__init__(key, "ok boolean", "fails long")
        self.limit = limit

    def apply(self, state, rows):
        n = np.arange(1, len(rows) + 1)
        good = np.maximum.accumulate(np.where(rows["ok"], n, 0))  # the last good row so far
        fails = n - good + np.where(good == 0, state[0] if state else 0, 0)
        alert = ~rows["ok"] & (fails >= self.limit)
        out = pd.DataFrame({"at": rows["at"][alert], "tie": rows["tie"][alert], "failed_attempts": fails[alert]})
        return (int(fails[-1]),) if fails[-1] else None, out  # no open streak, nothing to remember of this key


def stream_failed_access(
    df: DataFrame, user: str, ts: str, ok: str, tie: str, limit: int = 3, watermark: str = "10 minutes"
) -> DataFrame:
    """Alerts of ``failed_access_streak``: every failure that is at least the ``limit``-th in a row."""
    good = F.coalesce(F.col(ok), F.lit(False))
    return _in_order(
        df, [user], ts, tie, watermark, {"ok": good}, _Streaks([user], limit),
        "at long, tie long, failed_attempts long",
    ).withColumnRenamed("tie", tie)


class _Elasticity(InOrder):
    last_only = True

    def __init__(self, key, seed, lr, lo, hi):
        super().__init__(key, "observed double", "eta double, n long")
        self.seed, self.lr, self.lo, self.hi = seed, lr, lo, hi

    def apply(self, state, rows):
        eta, n = state or (self.seed, 0)
        for observed in rows["observed"].tolist():
            eta = max(self.lo, min(self.hi, eta * (1 - self.lr) + observed * self.lr))
        n += len(rows)
        return (eta, n), pd.DataFrame({"at": [int(rows["at"][-1])], "elasticity": [eta], "updates": [n]})


def stream_elasticity(
    df: DataFrame, key: Sequence[str], ts: str, old_price: str, new_price: str, change: str, tie: str,
    seed: float = -0.8, lr: float = 0.01, lo: float = -2.5, hi: float = -0.1,
    watermark: str = "10 minutes",
) -> DataFrame:
    """The key's elasticity after each released run of price changes: those that a mark has passed since the last."""
    ratio = (F.col(new_price) - F.col(old_price)) / F.col(old_price)
    usable = (F.col(old_price) != 0) & (F.col(new_price) != 0) & (F.col(new_price) != F.col(old_price))
    return _in_order(
        df.filter(usable & F.col(change).isNotNull()), key, ts, tie, watermark,
        {"observed": (F.col(change) / ratio).cast("double")}, _Elasticity(key, seed, lr, lo, hi),
        "at long, elasticity double, updates long",
    )


class _Outliers(InOrder):
    def __init__(self, key, n: int, contamination: float):
        super().__init__(key, "value double", "recent array<double>")
        self.n, self.c = n, contamination

    def apply(self, state, rows):
        recent = list(state[0]) if state else []
        values = np.concatenate([recent, rows["value"]])
        skip = len(recent)
        bounds = np.full((2, len(rows)), np.nan)
        first = max(self.n - 1, skip)
        if len(values) > first:
            frames = np.lib.stride_tricks.sliding_window_view(values, self.n)[first - self.n + 1:]
            bounds[:, first - skip:] = np.quantile(frames, [self.c / 2, 1 - self.c / 2], axis=1)
        now = values[skip:]
        with np.errstate(invalid="ignore"):
            flag = (now < bounds[0]) | (now > bounds[1])
        out = pd.DataFrame({"at": rows["at"], "tie": rows["tie"], "value": now, "is_outlier": flag})
        return (values[-self.n + 1:].tolist(),), out


def stream_outlier(
    df: DataFrame, key: Sequence[str], ts: str, value: str, tie: str, n: int = 100,
    contamination: float = 0.05, watermark: str = "10 minutes",
) -> DataFrame:
    """``rolling_outlier`` on a stream: the state is the key's last ``n - 1`` values."""
    current = F.coalesce(F.col(value).cast("double"), F.lit(0.0))
    return _in_order(
        df, key, ts, tie, watermark, {"value": current}, _Outliers(key, n, contamination),
        "at long, tie long, value double, is_outlier boolean",
    ).withColumnRenamed("tie", tie)


class _Lookbacks(StatefulProcessor):
    """Ring of (window start, sum) over the longest horizon. The windows that arrive are final and
    later batches bring later windows, so sorting inside a batch is enough. A timer at the end of the horizon
    clears the ring of a cell that has fallen silent."""

    def __init__(self, key, minutes):
        self.key, self.minutes = list(key), list(minutes)

    def init(self, handle):
        self.handle = handle
        self.ring = handle.getValueState("ring", "starts array<long>, sums array<double>")

    def _end(self, start_s: int) -> int:
        return (start_s + 60 * max(self.minutes)) * 1000

    def handleInputRows(self, key, rows, timerValues):
        pdf = pd.concat(list(rows)).sort_values("start_s", kind="stable").reset_index(drop=True)
        starts, sums = self.ring.get() if self.ring.exists() else ([], [])
        old = len(starts)
        t = np.array(list(starts) + pdf["start_s"].tolist(), dtype="int64")
        v = np.array(list(sums) + pdf["demand"].tolist(), dtype="float64")
        upto = np.concatenate([[0.0], np.cumsum(v)])
        out = pdf[["start_s", "demand"]].copy()
        here = np.arange(old, len(t))
        for m in self.minutes:
            low = np.searchsorted(t, t[here] - 60 * m)
            out[f"demand_last_{m}min"] = upto[here] - upto[low]
        keep = t > t[-1] - 60 * max(self.minutes)
        if old:
            self.handle.deleteTimer(self._end(starts[-1]))
        self.handle.registerTimer(self._end(int(t[-1])))
        self.ring.update((t[keep].tolist(), v[keep].tolist()))
        for i, k in enumerate(self.key):
            out.insert(i, k, key[i])
        yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.ring.exists() and self._end(self.ring.get()[0][-1]) <= expiredTimerInfo.getExpiryTimeInMs():
            self.ring.clear()
        return iter(())

    def close(self):
        pass


def stream_lookbacks(
    demand: DataFrame, key: Sequence[str], start: str = "feature_window_start",
    value: str = "demand_current_5min", minutes: Sequence[int] = (15, 30, 60, 1440), closed: str = "window_time",
) -> DataFrame:
    """Trailing sums over the final windows of ``stream_demand``. A key brings one row per window,
    however many events it has. ``closed`` is the windows' event time (``stream_demand(..., with_time=True)``), by which
    the state of a key ends the longest horizon after its last window."""
    rows = demand.select(
        *key, closed, F.unix_seconds(start).alias("start_s"), F.col(value).cast("double").alias("demand")
    )
    fields = [rows.schema[k] for k in key] + [
        T.StructField("start_s", T.LongType()), T.StructField("demand", T.DoubleType()),
        *[T.StructField(f"demand_last_{m}min", T.DoubleType()) for m in minutes],
    ]
    return (
        rows.groupBy(*key)
        .transformWithStateInPandas(_Lookbacks(key, minutes), T.StructType(fields), "Append", "EventTime")
        .withColumn(start, F.timestamp_seconds("start_s"))
        .withColumnRenamed("demand", value)
        .drop("start_s")
    )


class _EntityState(StatefulProcessor):
    """One map per entity and one clock for all of it: the time to live belongs to the entity."""

    def __init__(self, entity: str, ttl_s: int):
        self.entity, self.ttl = entity, ttl_s * 1000

    def init(self, handle):
        self.handle = handle
        self.parts = handle.getMapState("parts", "component string", "value string, at long, tie long")
        self.last = handle.getValueState("last", "at long")

    def _row(self, key, kind, last):
        state = {k[0]: v[0] for k, v in self.parts.iterator()}
        return pd.DataFrame(
            {self.entity: [key[0]], "kind": [kind], "at": [last],
             "state": [json.dumps(state, sort_keys=True)]}
        )

    def handleInputRows(self, key, rows, timerValues):
        last = self.last.get()[0] if self.last.exists() else None
        previous = last
        for pdf in rows:
            newest = pdf.sort_values(["at", "tie"]).groupby("component", sort=False).tail(1)
            for c, v, at, tie in zip(*[newest[n].tolist() for n in ("component", "value", "at", "tie")]):
                old = self.parts.getValue((c,)) if self.parts.containsKey((c,)) else None
                if old is None or (at, tie) >= (old[1], old[2]):
                    self.parts.updateValue((c,), (v, at, tie))
                last = at if last is None else max(last, at)
        if last != previous:
            if previous is not None:
                self.handle.deleteTimer(previous // 1000 + self.ttl)
            self.handle.registerTimer(last // 1000 + self.ttl)
            self.last.update((last,))
        yield self._row(key, "updated", last)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield self._row(key, "expired", self.last.get()[0])
        self.parts.clear()
        self.last.clear()

    def close(self):
        pass


def stream_entity_state(
    df: DataFrame, entity: str, component: str, value: str, ts: str, tie: str,
    ttl_s: int = 300, watermark: str = "10 minutes",
) -> DataFrame:
    """After each batch the state of the entities it touched (``kind`` updated), and one row when
    an entity expires. ``state`` is JSON text component -> value."""
    rows = (
        df.withColumn(ts, event_time(ts))
        .filter(F.col(ts).isNotNull())  # stream_late_rows keeps these
        .withWatermark(ts, watermark)
        .select(
            entity, ts, F.col(component).alias("component"), F.col(value).cast("string").alias("value"),
            F.unix_micros(ts).alias("at"), F.coalesce(F.col(tie).cast("long"), F.lit(NO_TIE)).alias("tie"),
        )
    )
    schema = T.StructType(
        [rows.schema[entity], T.StructField("kind", T.StringType()), T.StructField("at", T.LongType()),
         T.StructField("state", T.StringType())]
    )
    return (
        rows.groupBy(entity)
        .transformWithStateInPandas(_EntityState(entity, ttl_s), schema, "Append", "EventTime")
        .withColumn("last_update", F.timestamp_micros("at"))
        .drop("at")
    )
