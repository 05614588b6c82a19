"""Streaming forms: merged activity and counts over an unbounded stream of turns or events, and tracking."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.solvers import Tracker
from ..shipping import ship


def live_sessions(events: DataFrame, keys: list[str], gap: str = "5 minutes", late: str = "10 minutes", at: str = "ts") -> DataFrame:
    """Runs of events of each key with gaps under ``gap``: start, end and count, emitted once complete."""
    seen = events.withWatermark(at, late).groupBy(*keys, F.session_window(at, gap).alias("session")).agg(F.count("*").alias("n"))
    return seen.select(*keys, F.col("session.start").alias("start"), F.col("session.end").alias("end"), "n")


def live_windows(events: DataFrame, keys: list[str], value: str, width: str = "8 seconds", step: str = "7 seconds", late: str = "10 minutes", at: str = "ts") -> DataFrame:
    """Mean of a value over overlapping windows of each key."""
    seen = events.withWatermark(at, late).groupBy(*keys, F.window(at, width, step).alias("window")).agg(F.avg(value).alias("mean"), F.count("*").alias("n"))
    return seen.select(*keys, F.col("window.start").alias("start"), F.col("window.end").alias("end"), "mean", "n")


PENDING = "frame long, ms long, x double, y double, w double, h double, score double"
FOLLOWED = "id int, missed int, lost boolean, " + ", ".join(f"{c} array<double>" for c in ("value", "speed", "var", "cov", "speed_var"))
#: Tracks born, time of the last detection, when the timer is set for (milliseconds).
CLOCK = "born int, last long, timer long"


class LiveTracker(StatefulProcessor):
    """One video's tracker: detections that wait for their frame to be whole, followed tracks, a clock.

    A frame is whole once the watermark has passed its time.  The timer stands at the first frame that
    waits, or, if none does, where the video counts as ended; then its state goes.
    """

    def __init__(self, columns: list[str], quiet: int, limits: dict):
        self.columns, self.quiet, self.limits = columns, quiet, limits

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending, self.followed, self.clock = handle.getListState("pending", PENDING), handle.getListState("followed", FOLLOWED), handle.getValueState("clock", CLOCK)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        born, last, timer = self.clock.get() if self.clock.exists() else (0, None, None)
        for pdf in rows:
            pdf = pdf[pdf["frame"].notna() & pdf["ms"].notna()]
            if len(pdf):
                last = max(int(pdf["ms"].max()), last if last is not None else -(1 << 62))
                numbers = pdf[["x", "y", "w", "h", "score"]].to_numpy(float)
                self.pending.appendList([(int(f), int(m), *map(float, v)) for f, m, v in zip(pdf["frame"], pdf["ms"], numbers, strict=True)])
        if last is not None:
            yield from self.go_on(key, born, last, timer, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.clock.exists():
            born, last, _ = self.clock.get()
            yield from self.go_on(key, born, last, None, timerValues.getCurrentWatermarkInMs())

    def go_on(self, key, born: int, last: int, timer: int | None, watermark: int) -> Iterator[pd.DataFrame]:
        """Track the frames that are whole and set the timer anew."""
        held = pd.DataFrame(list(self.pending.get()) if self.pending.exists() else [], columns=[c.split()[0] for c in PENDING.split(", ")])
        whole = held[held["ms"] <= watermark]
        held = held[held["ms"] > watermark]
        if len(whole):
            tracker = self.tracker(born)
            whole = whole.sort_values(["frame", "score", "x", "y", "w", "h"], ascending=[True, False, True, True, True, True]).reset_index(drop=True)
            ids = np.zeros(len(whole), int)
            for _, rows in whole.groupby("frame", sort=True):
                seen = rows[rows["score"].notna()]
                ids[seen.index] = tracker.frame(seen[["x", "y", "w", "h"]].to_numpy(float), seen["score"].to_numpy(float))
            born = tracker.born
            motion = tracker.motion
            parts = zip(motion.value, motion.speed, motion.var, motion.cov, motion.speed_var, strict=True)
            rows = [(int(i), int(m), bool(x), *(p.tolist() for p in part)) for i, m, x, part in zip(tracker.ids, tracker.missed, tracker.lost, parts, strict=True)]
            if rows:
                self.followed.put(rows)
            else:
                self.followed.clear()
            kept = ids > 0
            yield whole[kept].assign(**{self.columns[0]: key[0]}, track_id=ids[kept])[[*self.columns, "track_id"]]
            if len(held):
                self.pending.put([tuple(r) for r in held.itertuples(index=False)])
            else:
                self.pending.clear()
        at = int(held["ms"].min()) if len(held) else last + self.quiet
        if not len(held) and at <= watermark:
            for state in (self.pending, self.followed, self.clock):
                state.clear()
            if timer is not None:
                self.handle.deleteTimer(timer)
            return
        if timer is None or timer != at:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(at)
        self.clock.update((born, last, at))

    def tracker(self, born: int) -> Tracker:
        tracker = Tracker(**self.limits)
        tracker.born = born
        if self.followed.exists():
            rows = list(zip(*self.followed.get(), strict=True))
            tracker.ids, tracker.missed, tracker.lost = np.array(rows[0], int), np.array(rows[1], int), np.array(rows[2], bool)
            for name, values in zip(("value", "speed", "var", "cov", "speed_var"), rows[3:], strict=True):
                setattr(tracker.motion, name, np.array([list(v) for v in values], float))
        return tracker

    def close(self) -> None:
        pass


def live_tracks(detections: DataFrame, key: str = "video_id", at: str = "ts", late: str = "10 seconds", quiet: float = 60.0, **limits) -> DataFrame:
    """Detections of an unbounded stream (``frame, x, y, w, h, score`` and the time ``at``) with their ``track_id``.

    A video's frames may come late by up to ``late``, in any order and split over batches: a frame is
    tracked once the watermark has passed its time, after those before it, so the result is the batch one.
    Frames without faces are rows with a null score.  ``quiet`` seconds after its last detection a
    video has ended and its state is dropped; what comes later is tracked as a new video.  Rows without a
    frame or time only move the watermark, which begins at 1970: times up to then are late.  State is kept in typed columns; the session's state store
    must be one with timers (RocksDB).
    """
    cols = [key, "frame", "x", "y", "w", "h", "score"]
    kind = {f.name: f.dataType.simpleString() for f in detections.schema}
    schema = f"`{key}` {kind[key]}, frame long, " + ", ".join(f"{c} double" for c in cols[2:]) + ", track_id int"
    ship(detections.sparkSession)
    numbers = [F.col(c).cast("double").alias(c) for c in cols[2:]]
    rows = detections.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    rows = rows.select(key, F.col("frame").cast("long").alias("frame"), *numbers, F.unix_millis(at).alias("ms"), at)
    return rows.groupBy(key).transformWithStateInPandas(LiveTracker(cols, int(quiet * 1000), limits), schema, "Append", "EventTime")
