"""Structured Streaming window counts: late rows, duplicate ids, closed windows,
restarts and epochs that run again."""

import os
import uuid

from tessera.session import checkpoint_dir
from tessera.streaming import events as ST


def _write(spark, folder, rows):
    df = spark.createDataFrame([(i, f"2024-01-02 {t}:00", "1", kind, "1", "{}") for i, t, kind in rows],
                               "event_id string, ts string, user_id string, event_type string, value string, props string")
    df.coalesce(1).write.mode("append").option("sep", "\t").option("header", False).csv(folder)


def _got(df):
    rows = df.collect()
    out = {(r.window_start.strftime("%H:%M"), r.event_type): r.n for r in rows}
    assert len(out) == len(rows)
    return out


def test_windows_close_once_and_late_rows_are_dropped(spark):
    base = f"{checkpoint_dir(spark).rstrip('/')}/stream-test-{uuid.uuid4().hex[:8]}".replace("file:", "")
    landing, out, ck = (os.path.join(base, x) for x in ("landing", "out", "ck"))

    def run():
        return _got(ST.run_window_counts(spark, landing, out, ck))

    _write(spark, landing, [("1", "10:01", "click"), ("2", "10:20", "click"), ("3", "10:40", "view")])
    # the watermark is 10:25: only the first window has closed
    assert run() == {("10:00", "click"): 1}
    # behind the watermark (dropped), a duplicate id (dropped), and two on time
    _write(spark, landing, [("4", "09:00", "click"), ("3", "10:41", "view"), ("5", "10:50", "view"), ("6", "10:29", "click")])
    assert run() == {("10:00", "click"): 1, ("10:15", "click"): 2}
    # nothing new: a restart sends nothing again
    assert run() == {("10:00", "click"): 1, ("10:15", "click"): 2}
    ST.close_windows(spark, landing, "2024-01-03 00:00:00")
    want = {("10:00", "click"): 1, ("10:15", "click"): 2, ("10:30", "view"): 1, ("10:45", "view"): 1}
    assert run() == want
    # what comes for a window that has closed is late
    _write(spark, landing, [("7", "10:31", "view")])
    assert run() == want
