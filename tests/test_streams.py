"""Streams fed in several files, out of order and late, against the batch operators."""

import contextlib
import datetime as dt
import json
import random
import types

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegrid.operators import sequence as E
from tidegrid.operators.quality import DEMAND_CONTRACT
from tidegrid.sources import files as A
from tidegrid.sources import streams as R
from tidegrid.streaming import late as L
from tidegrid.streaming import stateful as J
from tidegrid.streaming import windows as K
from tidegrid.streaming.run import run_available

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "id long, k string, ts timestamp, ok boolean, v double"


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    """Three files in order; inside a file rows are shuffled, and each has rows up to five minutes
    behind the newest row of the file before it. The last file moves the
    watermark far ahead with one row that every operator accepts (a price change included)."""
    rng = random.Random(5)
    raw, files = [], tmp_path_factory.mktemp("stream")
    for part in range(3):
        for _ in range(60):
            minute = part * 60 + rng.uniform(-5, 60)
            raw.append((len(raw), rng.choice(["hot", "hot", "a", None]), T0 + dt.timedelta(minutes=max(0, minute)),
                        rng.random() < 0.3, round(rng.gauss(50, 20), 1), part))
    raw.append((183, "end", T0 + dt.timedelta(days=9), True, 0.0, 3))
    for part in range(4):
        mine = [r[:5] for r in raw if r[5] == part]
        rng.shuffle(mine)
        spark.createDataFrame(mine, SCHEMA).coalesce(1).write.parquet(str(files / f"src{part}"))
    paths = [next((files / f"src{p}").glob("*.parquet")) for p in range(4)]
    box = tmp_path_factory.mktemp("inbox")
    import os
    import shutil
    for i, p in enumerate(paths):
        shutil.copy(p, box / f"{i}.parquet")
        os.utime(box / f"{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    batch = spark.createDataFrame([r[:5] for r in raw if r[5] < 3], SCHEMA)
    return str(box), batch


def stream(spark, box):
    return R.read_event_stream(spark, "parquet", spark.createDataFrame([], SCHEMA).schema, {"path": box}, max_per_trigger=1)


def as_set(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def test_failed_access(spark, parts):
    box, batch = parts
    got = run_available(J.stream_failed_access(stream(spark, box), "k", "ts", "ok", "id"), "t")
    want = E.failed_access_streak(batch, "k", "ts", "ok", ["id"]).filter("alert")
    assert as_set(got.select("id", "failed_attempts")) == as_set(want.select("id", "failed_attempts"))


def test_outlier(spark, parts):
    box, batch = parts
    got = run_available(J.stream_outlier(stream(spark, box), ["k"], "ts", "v", "id", 10, 0.2), "t")
    want = E.rolling_outlier(batch, ["k"], "ts", "v", 10, 0.2, ["id"])
    assert as_set(got.select("id", "is_outlier")) == as_set(want.select("id", "is_outlier"))


def test_elasticity(spark, parts):
    box, batch = parts

    def prices(df):
        return df.withColumns({"a": F.lit(1.0) + F.col("id") % 3, "b": F.lit(1.0) + F.col("id") % 5, "c": F.col("v") / 25 - 2})

    got = run_available(J.stream_elasticity(prices(stream(spark, box)), ["k"], "ts", "a", "b", "c", "id"), "t")
    last = {r.k: r for r in got.orderBy("updates").collect()}
    want = E.elasticity(prices(batch), ["k"], "ts", "a", "b", "c", ["id"]).collect()
    assert {k for k in last} == {r.k for r in want}
    for r in want:
        assert last[r.k].updates == r.updates and last[r.k].elasticity == pytest.approx(r.elasticity)


def test_demand_and_lookbacks(spark, parts):
    box, batch = parts
    from tidegrid.operators.demand import demand_per_cell
    from tidegrid.operators.lookback import lookback_trailing

    got = run_available(J.stream_lookbacks(K.stream_demand(stream(spark, box), ["k"], "ts", "v", with_time=True), ["k"]), "t")
    want = lookback_trailing(demand_per_cell(batch, ["k"], "ts", "v", "5 minutes"), ["k"], "feature_window_start", "demand_sum")
    cols = ["k", "feature_window_start", *[F.round(f"demand_last_{m}min", 6) for m in (15, 30, 60, 1440)]]
    assert as_set(got.select(*cols)) == as_set(want.select(*cols))


def test_late_rows_are_dropped(spark, tmp_path):
    box = tmp_path / "in"
    for i, minutes in enumerate(([0, 120], [1, 121], [500])):
        rows = [(m, "a", T0 + dt.timedelta(minutes=m), False, 1.0) for m in minutes]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(box))
        del i
    import os
    files = sorted(box.glob("*.parquet"), key=lambda p: p.stat().st_mtime_ns)
    for i, p in enumerate(files):
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))
    got = run_available(J.stream_failed_access(stream(spark, str(box)), "k", "ts", "ok", "id", limit=1), "t")
    assert {r.id: r.failed_attempts for r in got.collect()} == {0: 1, 120: 2, 121: 3}


def test_entity_expiry(spark, parts):
    box, batch = parts
    got = run_available(J.stream_entity_state(stream(spark, box), "k", "ok", "v", "ts", "id", ttl_s=3600), "t").collect()
    newest = {r.k: r.t for r in batch.groupBy("k").agg(F.max("ts").alias("t")).collect()}
    expired = {r.k: r.last_update for r in got if r.kind == "expired"}
    assert expired == newest
    final = [r for r in got if r.kind == "expired" and r.k == "hot"][0]
    want = batch.filter("k = 'hot'").groupBy("ok").agg(F.max_by("v", F.struct("ts", "id")).alias("v")).collect()
    assert json.loads(final.state) == {str(r.ok).lower(): str(r.v) for r in want}


def test_unmatched_predictions(spark, parts):
    box, batch = parts
    pred = stream(spark, box).select("id", "ts", F.col("v").alias("predicted"))
    actual = stream(spark, box).filter("ok").select("id", "ts", (F.col("v") + 1).alias("actual"))
    got = run_available(K.stream_feedback_error(pred, actual, ["id"], "ts", how="left"), "t")
    closed = got.filter(F.col("ts") < "2024-01-05")
    assert closed.count() == batch.count()
    assert closed.filter("error IS NOT NULL").count() == batch.filter("ok").count()


def test_quarantine_and_messages(spark, parts, tmp_path):
    box, batch = parts
    path = str(tmp_path / "q")
    messages = stream(spark, box).select("id", F.lit("{}").alias("m"))
    K.stream_quarantine(messages, "m", DEMAND_CONTRACT, path, str(tmp_path / "c")).awaitTermination()
    assert spark.read.parquet(path).filter("NOT is_valid").count() == batch.count() + 1


def test_parse_events_gives_nulls(spark):
    raw = spark.createDataFrame([(b'{"event_timestamp":"2024-01-01T00:00:00","hour_of_day":3}',), (b"x",)], "value binary")
    out = R.parse_events(raw, R.DEMAND_EVENT, "event_timestamp").orderBy("hour_of_day").collect()
    assert (out[0].timestamp, out[0].hour_of_day) == (None, None)
    assert (out[1].timestamp, out[1].hour_of_day) == (T0, 3)


def test_missing_history_is_empty(spark, tmp_path):
    out = A.read_history(spark, str(tmp_path / "none"), "ts string, v int", "ts")
    assert out.count() == 0 and out.schema["ts"].dataType.typeName() == "timestamp"


def test_rewrites_only_given_dates(spark, tmp_path):
    path = str(tmp_path / "f") + "/t"
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "v int, feature_date string")
    A.write_features(df, path)
    A.write_features(df.filter("v = 2").withColumn("v", F.lit(9)), path)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 9]


def test_rows_without_time_or_tie(spark, tmp_path):
    box = str(tmp_path / "in")
    at = lambda m: T0 + dt.timedelta(minutes=m)
    rows = [(None, "a", at(1), False, 1.0), (2, "a", at(1), False, 1.0), (3, "a", None, False, 1.0), (4, None, at(2), False, 1.0), (9, "z", at(900), True, 0.0)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(box)
    got = run_available(J.stream_failed_access(stream(spark, box), "k", "ts", "ok", "id", limit=1), "t")
    assert as_set(got.select("k", "id", "failed_attempts")) == sorted(map(repr, [("a", None, 1), ("a", 2, 2), (None, 4, 1)]))
    out = run_available(J.stream_entity_state(stream(spark, box), "k", "ok", "v", "ts", "id", ttl_s=60), "t")
    assert {(r.k, r.kind) for r in out.collect()} == {("a", "updated"), ("a", "expired"), (None, "updated"), (None, "expired"), ("z", "updated")}


def _late_box(spark, tmp_path):
    box = tmp_path / "in"
    for minutes in ([0, 120], [1, 121, 112], [2, 130, 500], [111, 600]):
        rows = [(m, "a", T0 + dt.timedelta(minutes=m), False, 1.0) for m in minutes] + [(-1, "a", None, False, 1.0)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(box))
    return str(box)


def test_late_rows_are_kept_and_counted(spark, tmp_path):
    box, out = _late_box(spark, tmp_path), str(tmp_path / "late")
    given = stream(spark, box)
    L.stream_late_rows(given, "ts", out, str(tmp_path / "c")).awaitTermination()
    kept = {(r.batch_id, r.id, r.reason) for r in L.late_rows(given, out).collect()}
    assert {k for k in kept if k[2] == "late"} == {(1, 1, "late"), (2, 2, "late"), (3, 111, "late")}
    assert sum(k[2] == "no time" for k in kept) == 4
    counts = {r.batch_id: (r.n_rows, r.n_late, r.n_no_time) for r in L.batches(spark, out).collect()}
    assert counts == {0: (3, 0, 1), 1: (4, 1, 1), 2: (4, 1, 1), 3: (3, 1, 1)}
    used = run_available(J.stream_failed_access(stream(spark, box), "k", "ts", "ok", "id", limit=1), "t")
    assert {r.id for r in used.collect()} == {0, 112, 120, 121, 130, 500}  # 600 is still held back
    # Run again from nothing, the batches overwrite what they wrote.
    L.stream_late_rows(given, "ts", out, str(tmp_path / "again")).awaitTermination()
    assert {(r.batch_id, r.id, r.reason) for r in L.late_rows(given, out).collect()} == kept


def test_windows_close_a_batch_later(spark, tmp_path):
    box, out = _late_box(spark, tmp_path), str(tmp_path / "late")
    given = stream(spark, box)
    L.stream_late_rows(given, "ts", out, str(tmp_path / "c"), width="5 minutes").awaitTermination()
    late = {r.id for r in L.late_rows(given, out).filter("reason = 'late'").collect()}
    used = run_available(K.stream_demand(stream(spark, box), ["k"], "ts", "v"), "t")
    assert late == {2} and used.agg(F.sum("raw_demand_count")).first()[0] == 10 - 2  # 600 is open yet, 2 is late


def test_state_of_a_silent_cell_ends(spark, tmp_path):
    box = tmp_path / "in"
    for day, key in ((0, "a"), (1, "b"), (3, "b"), (4, "b"), (5, "b")):
        rows = [(day, key, T0 + dt.timedelta(days=day), False, 1.0)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(box))
    state = str(tmp_path / "state")
    demand = K.stream_demand(stream(spark, str(box)), ["k"], "ts", "v", with_time=True)
    query = J.stream_lookbacks(demand, ["k"]).writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True)
    query.start(str(tmp_path / "out")).awaitTermination()
    ring = spark.read.format("statestore").option("path", state).option("operatorId", 0).option("stateVarName", "ring").load()
    assert {r.key.k for r in ring.collect()} <= {"b"} and ring.count() <= 1
    assert spark.read.parquet(str(tmp_path / "out")).count() >= 4


def test_waiting_rows_lie_in_time_buckets(spark, parts, monkeypatch):
    box, batch = parts
    monkeypatch.setattr(J, "BUCKET_MS", 7_000)
    got = run_available(J.stream_failed_access(stream(spark, box), "k", "ts", "ok", "id"), "t")
    want = E.failed_access_streak(batch, "k", "ts", "ok", ["id"]).filter("alert")
    assert as_set(got.select("id", "failed_attempts")) == as_set(want.select("id", "failed_attempts"))


@pytest.mark.parametrize("piece,sort,apply", [(2048, 1 << 18, 1 << 13), (7, 20, 5), (40, 30, 1 << 13)])
def test_a_key_has_one_entry_and_few_calls(spark, parts, monkeypatch, piece, sort, apply):
    """Waiting rows of a key travel together: state calls follow keys, marks and pieces, not rows; pieces that overlap are merged."""
    box, batch = parts
    for name, value in (("PIECE_ROWS", piece), ("SORT_ROWS", sort), ("APPLY_ROWS", apply)):
        monkeypatch.setattr(J, name, value)
    with _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "9"):
        got = run_available(J.stream_failed_access(stream(spark, box), "k", "ts", "ok", "id"), "t")
        values = run_available(J.stream_outlier(stream(spark, box), ["k"], "ts", "v", "id", 10, 0.2), "t")
    want = E.failed_access_streak(batch, "k", "ts", "ok", ["id"]).filter("alert")
    assert as_set(got.select("id", "failed_attempts")) == as_set(want.select("id", "failed_attempts"))
    want = E.rolling_outlier(batch, ["k"], "ts", "v", 10, 0.2, ["id"])
    assert as_set(values.select("id", "is_outlier")) == as_set(want.select("id", "is_outlier"))


@contextlib.contextmanager
def _setting(spark, name, value):
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    yield
    spark.conf.set(name, before)


class FakeState:
    """A value, a map and timers of one key that count how often they are called."""

    def __init__(self):
        self.calls, self.one, self.many, self.timers = 0, {}, {}, set()

    def getValueState(self, name, schema):
        def call(do):
            self.calls += 1
            return do()
        return types.SimpleNamespace(
            get=lambda: call(lambda: self.one.get(name)), update=lambda v: call(lambda: self.one.update({name: v})),
            clear=lambda: call(lambda: self.one.pop(name, None)))

    def getMapState(self, name, key, schema):
        def call(do):
            self.calls += 1
            return do()
        return types.SimpleNamespace(
            getValue=lambda k: call(lambda: self.many[k]), updateValue=lambda k, v: call(lambda: self.many.update({k: v})),
            removeKey=lambda k: call(lambda: self.many.pop(k)))

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)


@pytest.mark.parametrize("n", [60, 30_000])
def test_state_calls_do_not_follow_rows(n):
    rng = np.random.default_rng(n)
    at = rng.integers(1, 86_400_000, n) * 1000 + rng.integers(0, 2, n)
    rows = pd.DataFrame({"at": at, "tie": np.arange(n), "ok": rng.random(n) < 0.7})
    state, streaks, out = FakeState(), J._Streaks(["k"], 2), []
    streaks.init(state)
    begin = 0
    for mark, upto in ((0, n // 2), (40_000_000, n), (90_000_000, n)):
        times = types.SimpleNamespace(getCurrentWatermarkInMs=lambda mark=mark: mark)
        fresh = rows[begin:upto]
        streaks.handleInputRows(("a",), iter([fresh[i::7] for i in range(7)]), times)
        begin = upto
        for timer in sorted(t for t in state.timers if t <= mark):
            out += list(streaks.handleExpiredTimer(("a",), times, None))
            state.timers.discard(timer)
    late = rows[n // 2:]
    used = pd.concat([rows[: n // 2], late[late["at"] // 1000 > 40_000_000]]).sort_values(["at", "tie"])
    # Rows of the second arrival are judged by its own mark, as those of the first are released by it.
    want, fails = [], 0
    for a, t, ok in zip(used["at"], used["tie"], used["ok"]):
        fails = 0 if ok else fails + 1
        if fails >= 2:
            want.append((a, t, fails))
    got = pd.concat(out)
    assert list(zip(got["at"], got["tie"], got["failed_attempts"])) == want
    assert not state.many and "held" not in state.one
    assert state.calls <= 30 + 8 * n // J.PIECE_ROWS
