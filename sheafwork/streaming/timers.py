"""Custom stream state that ends: event-time timers and time-to-live (STR-19)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

_SPAN = "own string, first long, last long, n long, cents long"

#: First and last event (microseconds), events and cents of a session that may still grow.
Span = tuple[int, int, int, int]


def merge_spans(spans: Sequence[Span], gap: int) -> list[Span]:
    """Spans joined where less than ``gap`` lies between the end of one and the start of the next."""
    out: list[Span] = []
    for first, last, n, cents in sorted(spans):
        if out and first - out[-1][1] < gap:
            a, b, m, c = out[-1]
            out[-1] = (a, max(b, last), m + n, c + cents)
        else:
            out.append((first, last, n, cents))
    return out


def frame_spans(pdf: pd.DataFrame, gap: int) -> dict[str, list[Span]]:
    """Spans of the events of one frame, in any order, by their own key."""
    at, cents = pdf["at"].to_numpy().astype("datetime64[us]").astype(np.int64), pdf["cents"].to_numpy()
    codes, owners = pd.factorize(pdf["own"])
    order = np.lexsort((at, codes))
    at, cents, codes = at[order], cents[order], codes[order]
    start = np.flatnonzero(np.append(True, (np.diff(at) >= gap) | (np.diff(codes) != 0)))
    end = np.append(start[1:], len(at))
    out: dict[str, list[Span]] = {}
    spans = zip(at[start].tolist(), at[end - 1].tolist(), (end - start).tolist(), np.add.reduceat(cents, start).tolist())
    for code, span in zip(codes[start].tolist(), spans):
        out.setdefault(owners[code], []).append(span)
    return out


class SessionTimers(StatefulProcessor):
    """Open sessions of one key, or of a group of keys, in list state, with one timer at the end of the earliest.

    Events may come in any order within the watermark's delay, so several
    sessions of a key can be open, and an event can join two of them. When the
    watermark reaches the end of a session nothing can extend it any more: it is
    put out and leaves the state. A group without open sessions keeps nothing.
    """

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._open = handle.getListState("open", _SPAN)

    def _held(self) -> dict[str, list[Span]]:
        held: dict[str, list[Span]] = {}
        if self._open.exists():
            for own, *span in self._open.get():
                held.setdefault(own, []).append(tuple(span))
        return held

    def _due(self, spans: dict[str, list[Span]]) -> int | None:
        """Milliseconds, rounded up, of the earliest end."""
        last = min((s[1] for own in spans.values() for s in own), default=None)
        return None if last is None else -(-(last + self.gap) // 1000)

    def _keep(self, spans: dict[str, list[Span]], due: int | None) -> None:
        """Store ``spans``; the timer that stands at ``due`` moves where the earliest end does."""
        following = self._due(spans)
        if due is not None and due != following:
            self._handle.deleteTimer(due)
        if following is None:
            self._open.clear()
            return
        self._open.put([(own, *span) for own, held in spans.items() for span in held])
        if due != following:
            self._handle.registerTimer(following)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        spans = self._held()
        due = self._due(spans)
        for pdf in rows:
            for own, fresh in frame_spans(pdf, self.gap).items():
                spans[own] = merge_spans(spans.get(own, []) + fresh, self.gap)
        self._keep(spans, due)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        held = self._held()
        ended = [(own, *s) for own, spans in held.items() for s in spans if s[1] + self.gap <= mark]
        open_still = {own: left for own, spans in held.items() if (left := [s for s in spans if s[1] + self.gap > mark])}
        self._keep(open_still, self._due(held))
        if not ended:
            return
        own, first, last, n, cents = zip(*ended)
        yield pd.DataFrame({
            "own": list(own), "session_start": pd.to_datetime(list(first), unit="us"), "session_end": pd.to_datetime([x + self.gap for x in last], unit="us"),
            "n": list(n), "cents": list(cents),
        })

    def close(self) -> None:
        pass


def _one_key(keys: Sequence[str]) -> Column:
    """All keys in one string, never null: null keys are keys too."""
    return F.to_json(F.struct(*keys))


def _with_keys(found: DataFrame, stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    kinds = T.StructType([stream.schema[k] for k in keys])
    return found.select(F.from_json("_key", kinds).alias("_keys"), *[c for c in found.columns if c != "_key"]).select(
        "_keys.*", *[c for c in found.columns if c != "_key"]
    )


def timed_sessions(
    stream: DataFrame, keys: Sequence[str], at: str, cents: Column, gap_seconds: int, late: str, groups: int | None = None
) -> DataFrame:
    """Sessions of each key, put out by a timer when the watermark passes their end.

    Columns: the keys, ``session_start``, ``session_end`` (last event plus gap), ``n``, ``cents``.
    Events without a time belong to no session; null cents count as 0. State is kept
    by key, or by ``groups`` hashes of the keys: calls into the state cost far more
    than their rows, so many keys with few events each go faster in groups.
    ``groups`` must stay the same as long as a checkpoint is used.
    """
    timed = stream.withWatermark(at, late).where(F.col(at).isNotNull())
    own = _one_key(keys)
    group = F.pmod(F.xxhash64(own), F.lit(groups)).cast("string") if groups else own
    rows = timed.select(group.alias("_key"), own.alias("own"), F.col(at).alias("at"), F.coalesce(cents.cast("bigint"), F.lit(0)).alias("cents"))
    out = "own string, session_start timestamp, session_end timestamp, n long, cents long"
    found = rows.groupBy("_key").transformWithStateInPandas(SessionTimers(gap_seconds * 1_000_000), out, "append", "eventTime")
    return _with_keys(found.withColumnRenamed("own", "_key"), stream, keys)


class RecentTotals(StatefulProcessor):
    """Count and cents of a key in value state that is gone when it was not written for ``forget_ms``."""

    def __init__(self, forget_ms: int):
        self.forget_ms = forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._total = handle.getValueState("total", "n long, cents long", self.forget_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        n, cents = self._total.get() if self._total.exists() else (0, 0)
        for pdf in rows:
            n, cents = n + len(pdf), cents + int(pdf["cents"].sum())
        self._total.update((n, cents))
        yield pd.DataFrame({"_key": [key[0]], "n": [n], "cents": [cents]})

    def close(self) -> None:
        pass


def recent_totals(stream: DataFrame, keys: Sequence[str], cents: Column, forget_seconds: float) -> DataFrame:
    """Running totals of the keys that are active: a key idle for ``forget_seconds`` starts anew.

    Spark goes on with empty batches as long as state may expire by the clock;
    ``io.drain`` needs ``spark.sql.streaming.noDataMicroBatches.enabled`` off to end.
    """
    rows = stream.select(_one_key(keys).alias("_key"), F.coalesce(cents.cast("bigint"), F.lit(0)).alias("cents"))
    found = rows.groupBy("_key").transformWithStateInPandas(
        RecentTotals(int(forget_seconds * 1000)), "_key string, n long, cents long", "update", "processingTime"
    )
    return _with_keys(found, stream, keys)
