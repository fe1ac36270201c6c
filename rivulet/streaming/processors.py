"""Keyed stateful operators for streams, each the streaming form of a batch operator.

A processor sees the rows of one key of one micro-batch; rows are taken in the order of
``seq``. State per key is a few numbers wherever the operator allows it. Event times
come in as ``ms``, epoch milliseconds. Spark calls expired timers after a micro-batch's rows;
a processor whose result depends on it looks at the watermark before each row instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

DAY_MS = 86_400_000


def process(
    df: DataFrame,
    keys: Sequence[str],
    processor: Keyed,
    columns: str,
    time_mode: str = "none",
    output_mode: str = "append",
) -> DataFrame:
    """Run ``processor`` over a stream keyed by ``keys``; ``columns`` names what it gives
    after the key columns."""
    head = df.select(*keys).schema.fields
    schema = T.StructType([*head, *T.StructType.fromDDL(columns).fields])
    processor.names = schema.names
    return df.groupBy(*keys).transformWithState(processor, schema, output_mode, time_mode)


class Keyed(StatefulProcessor):
    """Base: hands rows over one by one in arrival order; subclasses yield tuples."""

    names: Sequence[str] = ()

    def __init__(self, seq: str = "seq"):
        self.seq = seq

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        output = Row(*self.names)
        for row in sorted(rows, key=lambda r: r[self.seq]):
            for values in self.row(key, row, timerValues):
                yield output(*values)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        output = Row(*self.names)
        for values in self.timer(key, expiredTimerInfo.getExpiryTimeInMs()):
            yield output(*values)

    def row(self, key, row, timers) -> Iterator[tuple]:
        raise NotImplementedError

    def timer(self, key, due: int) -> Iterator[tuple]:
        return iter(())

    def close(self) -> None:
        pass


class Reduce(Keyed):
    """Running reduce: ``combine(state, value)`` over ``value`` column, one output per row.

    The first row passes unchanged. Output: key columns, ``seq``, result.
    """

    def __init__(self, value: str, kind: str, combine: Callable, seq: str = "seq"):
        super().__init__(seq)
        self.value, self.kind, self.combine = value, kind, combine

    def init(self, handle) -> None:
        self.state = handle.getValueState("reduced", f"v {self.kind}")

    def row(self, key, row, timers):
        now = row[self.value]
        if self.state.exists():
            now = self.combine(self.state.get()[0], now)
        self.state.update((now,))
        yield (*key, row[self.seq], now)


class Previous(Keyed):
    """The value of the key's previous row. Output: key, ``seq``, value, previous value."""

    def __init__(self, value: str, kind: str, seq: str = "seq"):
        super().__init__(seq)
        self.value, self.kind = value, kind

    def init(self, handle) -> None:
        self.state = handle.getValueState("last", f"v {self.kind}")

    def row(self, key, row, timers):
        before = self.state.get()[0] if self.state.exists() else None
        self.state.update((row[self.value],))
        yield (*key, row[self.seq], row[self.value], before)


class Distinct(Keyed):
    """Different values so far. Output: key, ``seq``, count."""

    def __init__(self, value: str, kind: str, seq: str = "seq"):
        super().__init__(seq)
        self.value, self.kind = value, kind

    def init(self, handle) -> None:
        self.seen = handle.getMapState("seen", f"v {self.kind}", "one int")
        self.count = handle.getValueState("count", "n long")

    def row(self, key, row, timers):
        count = self.count.get()[0] if self.count.exists() else 0
        value = row[self.value]
        if value is not None and not self.seen.containsKey((value,)):
            self.seen.updateValue((value,), (1,))
            count += 1
            self.count.update((count,))
        yield (*key, row[self.seq], count)


class RetractCount(Keyed):
    """Count per key as a changelog. Output: key, ``seq``, is_add, count."""

    def init(self, handle) -> None:
        self.count = handle.getValueState("count", "n long")

    def row(self, key, row, timers):
        before = self.count.get()[0] if self.count.exists() else 0
        self.count.update((before + 1,))
        if before:
            yield (*key, row[self.seq], False, before)
        yield (*key, row[self.seq], True, before + 1)


class CountWindow(Keyed):
    """After every ``slide`` rows, the sum of the last ``size``; a tumbling window if
    they are equal. Output: key, firing, sum."""

    def __init__(self, value: str, size: int, slide: int, seq: str = "seq"):
        super().__init__(seq)
        self.value, self.size, self.slide = value, size, slide

    def init(self, handle) -> None:
        self.kept = handle.getListState("kept", "v long")
        self.count = handle.getValueState("count", "n long")

    def row(self, key, row, timers):
        count = (self.count.get()[0] if self.count.exists() else 0) + 1
        kept = [v[0] for v in self.kept.get()] if self.kept.exists() else []
        kept = [*kept, row[self.value]][-self.size :]
        self.count.update((count,))
        self.kept.put([(v,) for v in kept])
        if count % self.slide == 0:
            yield (*key, count // self.slide, sum(kept))


class MatchWaiting(Keyed):
    """One-to-one matching of two inputs as they arrive.

    Rows carry ``is_left`` and ``seq``. Output: key, left ``seq``, right ``seq``.
    """

    def init(self, handle) -> None:
        self.waiting = handle.getValueState("waiting", "is_left boolean, seq long")

    def row(self, key, row, timers):
        waits = self.waiting.get() if self.waiting.exists() else None
        if waits is None or waits[0] == row["is_left"]:
            self.waiting.update((row["is_left"], row[self.seq]))
            return
        self.waiting.clear()
        pair = (row[self.seq], waits[1]) if row["is_left"] else (waits[1], row[self.seq])
        yield (*key, *pair)


class DailyLimit(Keyed):
    """The first ``limit`` rows of a key and UTC day pass, the next raises one alarm.

    Days are counted apart and forgotten at their midnight. A key's days are one state, read
    and written once per micro-batch, with one timer for the first of them: every access is
    a call to the JVM. Output: key, ``seq``, route (``pass`` or ``alarm``).
    """

    def __init__(self, limit: int, seq: str = "seq"):
        super().__init__(seq)
        self.limit = limit

    def init(self, handle) -> None:
        self.handle = handle
        self.counts = handle.getValueState("counts", "days array<long>, counts array<long>")

    def _known(self) -> dict[int, int]:
        kept = self.counts.get() if self.counts.exists() else None
        return dict(zip(*kept, strict=True)) if kept else {}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        output = Row(*self.names)
        counts = self._known()
        first = min(counts, default=None)
        for row in sorted(rows, key=lambda r: r[self.seq]):
            day = row["ms"] // DAY_MS
            count = counts.get(day, 0)
            if count <= self.limit:
                counts[day] = count + 1
                yield output(*key, row[self.seq], "pass" if count < self.limit else "alarm")
        self.counts.update((list(counts), list(counts.values())))
        if first is None or min(counts) < first:
            self.handle.registerTimer((min(counts) + 1) * DAY_MS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        counts = {day: n for day, n in self._known().items() if (day + 1) * DAY_MS > passed}
        if counts:
            self.counts.update((list(counts), list(counts.values())))
            self.handle.registerTimer((min(counts) + 1) * DAY_MS)
        else:
            self.counts.clear()
        return iter(())


class RepeatedFailures(Keyed):
    """``least`` failures before a success or within ``window_ms`` of the first.

    Rows carry ``ok`` and ``ms``. Output: key, first ``seq``, failures, closed_by.
    """

    def __init__(self, window_ms: int, least: int = 2, seq: str = "seq"):
        super().__init__(seq)
        self.window_ms, self.least = window_ms, least

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "first long, failures long, due long")

    def _end(self, key, how):
        first, failures, _ = self.open.get()
        self.open.clear()
        if failures >= self.least:
            yield (*key, first, failures, how)

    def row(self, key, row, timers):
        pending = self.open.get() if self.open.exists() else None
        if pending is not None and pending[2] <= timers.getCurrentWatermarkInMs():
            # Due before this row came.
            self.handle.deleteTimer(pending[2])
            yield from self._end(key, "timer")
            pending = None
        if row["ok"]:
            if pending is not None:
                self.handle.deleteTimer(pending[2])
                yield from self._end(key, "success")
        elif pending is None:
            due = row["ms"] + self.window_ms
            self.handle.registerTimer(due)
            self.open.update((row[self.seq], 1, due))
        else:
            self.open.update((pending[0], pending[1] + 1, pending[2]))

    def timer(self, key, due):
        if self.open.exists():
            yield from self._end(key, "timer")


class Rising(Keyed):
    """Alarm when ``value`` kept rising for ``hold_ms``. Output: key, first ``seq``, due."""

    def __init__(self, value: str, hold_ms: int, floor: float = -1, seq: str = "seq"):
        super().__init__(seq)
        self.value, self.hold_ms, self.floor = value, hold_ms, floor

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "v double")
        self.pending = handle.getValueState("pending", "first long, due long")

    def _raise(self, key):
        first, due = self.pending.get()
        self.handle.deleteTimer(due)
        self.pending.clear()
        yield (*key, first, due)

    def row(self, key, row, timers):
        last = self.last.get()[0] if self.last.exists() else self.floor
        if self.pending.exists() and self.pending.get()[1] <= timers.getCurrentWatermarkInMs():
            yield from self._raise(key)
        value = float(row[self.value])
        if value > last:
            if not self.pending.exists():
                due = row["ms"] + self.hold_ms
                self.handle.registerTimer(due)
                self.pending.update((row[self.seq], due))
        elif self.pending.exists():
            self.handle.deleteTimer(self.pending.get()[1])
            self.pending.clear()
        self.last.update((value,))

    def timer(self, key, due):
        if self.pending.exists():
            yield from self._raise(key)


class PaymentStatus(Keyed):
    """How each order ended; the first event of an order sets the time limit.

    Rows carry ``event_type`` (``create`` or ``pay``) and ``ms``. Output: key, status.
    """

    def __init__(self, limit_ms: int, seq: str = "seq"):
        super().__init__(seq)
        self.limit_ms = limit_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.half = handle.getValueState("half", "kind string, ms long, due long")

    def _give_up(self, key):
        kind, _, due = self.half.get()
        self.handle.deleteTimer(due)
        self.half.clear()
        yield (*key, "pay_timeout" if kind == "create" else "create_missing")

    def row(self, key, row, timers):
        kind, ms = row["event_type"], row["ms"]
        if self.half.exists() and self.half.get()[2] <= timers.getCurrentWatermarkInMs():
            yield from self._give_up(key)
        half = self.half.get() if self.half.exists() else None
        if half is None or half[0] == kind:
            if half is not None:
                self.handle.deleteTimer(half[2])
            due = ms + self.limit_ms
            self.handle.registerTimer(due)
            self.half.update((kind, ms, due))
            return
        self.handle.deleteTimer(half[2])
        self.half.clear()
        paid, created = (ms, half[1]) if kind == "pay" else (half[1], ms)
        yield (*key, "paid_late" if paid - created > self.limit_ms else "paid")

    def timer(self, key, due):
        if self.half.exists():
            yield from self._give_up(key)


class After(Keyed):
    """An event-time timer per row, ``delay_ms`` after it; equal due times go off once.

    Output: key, due.
    """

    def __init__(self, delay_ms: int, seq: str = "seq"):
        super().__init__(seq)
        self.delay_ms = delay_ms

    def init(self, handle) -> None:
        self.handle = handle

    def row(self, key, row, timers):
        self.handle.registerTimer(row["ms"] + self.delay_ms)
        return iter(())

    def timer(self, key, due):
        yield (*key, due)


class RouteLate(Keyed):
    """Routes rows whose tumbling window is gone to ``late`` instead of dropping them.

    Run it in ``processingTime`` mode on a stream with a watermark: late rows are
    then delivered. Output: key, ``seq``, ``ms``, route.
    """

    def __init__(self, size_ms: int, lateness_ms: int = 0, seq: str = "seq"):
        super().__init__(seq)
        self.size_ms, self.lateness_ms = size_ms, lateness_ms

    def init(self, handle) -> None:
        pass

    def row(self, key, row, timers):
        last_instant = (row["ms"] // self.size_ms + 1) * self.size_ms - 1
        gone = last_instant + self.lateness_ms <= timers.getCurrentWatermarkInMs()
        yield (*key, row[self.seq], row["ms"], "late" if gone else "main")
