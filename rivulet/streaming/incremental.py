"""Batch operators carried on over the micro-batches of a stream.

A micro-batch is a chunk of the input like any other: inside it the batch operator runs,
with its own plan and its own treatment of hot keys, and what it needs of earlier
micro-batches is a state it reads and leaves behind. So a key with a third of a
micro-batch's rows is spread over tasks, no rows are walked one by one, and results do not
depend on where micro-batches end.

State lies below a shared folder, one folder per micro-batch (:class:`Log`). A repeated
micro-batch reads what was there before it and replaces its own. Rows come in arrival order
``seq``; of event time, the watermark stands at the largest one seen less a bound.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.time import epoch_micros, micros
from rivulet.operators import ordered as o
from rivulet.operators import ranking
from rivulet.operators.eventtime import LATE, ON_TIME, REFIRE, with_status
from rivulet.operators.joins import match_waiting
from rivulet.operators.patterns import FOLLOWED_BY_ANY, Stage, match_pattern
from rivulet.session import run_folder
from rivulet.streaming.run import parquet_log, start

Sink = Callable[[DataFrame, int], None]

# After so many micro-batches a log is written whole, so that reading it stays short.
WHOLE_EVERY = 16


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """``right`` with its keys renamed, and the condition that keys are equal, null or not."""
    renamed = right.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], F.lit(True))
    return renamed, match


class Log:
    """The latest version of each key's state, as left by the micro-batches so far.

    Each micro-batch adds the keys that changed; ``_gone`` marks those that end. Without
    keys a micro-batch replaces all rows.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str] | None = None):
        self.spark, self.folder, self.keys = spark, folder, keys

    def _path(self, batch_id: int) -> str:
        return f"{self.folder}/batch={batch_id}"

    def before(self, batch_id: int, schema: T.StructType) -> DataFrame:
        """The state that micro-batch ``batch_id`` finds."""
        if batch_id == 0:
            return self.spark.createDataFrame([], schema)
        last = batch_id - 1
        first = last if self.keys is None else last - last % WHOLE_EVERY
        if self.keys is None:
            return self.spark.read.schema(schema).parquet(self._path(last))
        fields = [*schema.fields, T.StructField("_gone", T.BooleanType()), T.StructField("batch", T.LongType())]
        paths = [self._path(i) for i in range(first, batch_id)]
        log = self.spark.read.schema(T.StructType(fields)).option("basePath", self.folder).parquet(*paths)
        rest = [f.name for f in schema.fields if f.name not in self.keys]
        newest = log.groupBy(*self.keys).agg(F.max_by(F.struct(*rest, "_gone"), "batch").alias("_s"))
        return newest.where("not _s._gone").select(
            *[F.col(k) if k in self.keys else F.col(f"_s.{k}").alias(k) for k in schema.names]
        )

    def put(self, batch_id: int, changed: DataFrame) -> None:
        """``changed`` has the state's columns and, with keys, ``_gone``."""
        if self.keys is not None and batch_id and batch_id % WHOLE_EVERY == 0:
            schema = T.StructType([f for f in changed.schema.fields if f.name != "_gone"])
            # Kept apart first: it is read twice.
            part = f"{self.folder}-changed/batch={batch_id}"
            changed.write.mode("overwrite").parquet(part)
            changed = self.spark.read.schema(changed.schema).parquet(part)
            old = self.before(batch_id, schema)
            named, match = same_keys(old, changed.select(*self.keys), self.keys)
            rest = old.join(named, match, "left_anti").withColumn("_gone", F.lit(False))
            changed = rest.unionByName(changed)
        changed.write.mode("overwrite").parquet(self._path(batch_id))


class Incremental:
    """An operator over micro-batches, to be used as the sink of a stream: it gives its
    results to its own sink. ``finish`` ends the input: whatever waits comes out."""

    def __init__(self, spark: SparkSession, folder: str, sink: Sink):
        self.spark, self.folder, self.sink = spark, folder, sink
        self.last, self.schema = -1, None

    def log(self, name: str, keys: Sequence[str] | None = None) -> Log:
        return Log(self.spark, f"{self.folder}/state-{name}", keys)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.last, self.schema = batch_id, batch.schema
        batch = batch.persist()
        try:
            self.step(batch, batch_id, False)
        finally:
            batch.unpersist()

    def finish(self, schema: T.StructType) -> None:
        self.step(self.spark.createDataFrame([], schema), self.last + 1, True)

    def step(self, batch: DataFrame, batch_id: int, ended: bool) -> None:
        raise NotImplementedError

    def watermarks(self, batch: DataFrame, rt: str, bound: str, batch_id: int) -> tuple[int | None, int | None]:
        """The largest event time less the bound, in microseconds, before and after a
        micro-batch. One row of state."""
        log = self.log("watermark")
        schema = T.StructType.fromDDL("latest long")
        found = log.before(batch_id, schema).first()
        before = found["latest"] if found else None
        most = batch.agg(F.max(epoch_micros(F.col(rt))).alias("latest")).first()["latest"]
        known = [m for m in (before, most) if m is not None]
        latest = max(known) if known else None
        log.put(batch_id, self.spark.createDataFrame([(latest,)], schema))
        less = micros(bound)
        return (None if before is None else before - less), (None if latest is None else latest - less)


def carried(
    log: Log, batch: DataFrame, batch_id: int, keys: Sequence[str], order: Sequence[str], values: dict[str, o.Running]
) -> DataFrame:
    """Running values over a micro-batch, continued from what earlier ones left in ``log``."""
    # The value of the row just before is the latest one; a struct, as it may be null.
    runs = {
        n: o.last_seen(r.value, before=True) if r.kind == "previous" else r for n, r in values.items()
    }
    if any(r.kind == "first" for r in runs.values()):
        raise ValueError("a first value does not change: take it from the key's first result")
    plan = o.layout(batch, keys, order)
    local = o.running(batch, keys, order, runs, plan=plan)
    position = F.struct(*order)
    parts = batch.groupBy(*keys).agg(*[o.partial(r, position).alias(n) for n, r in runs.items()])
    old = log.before(batch_id, parts.schema)

    def joined(df: DataFrame, how: str) -> DataFrame:
        named, match = same_keys(df, old.select(*keys, *[F.col(n).alias(f"_old_{n}") for n in runs]), keys)
        return df.join(named, match, how)

    new = joined(parts, "left").select(
        *keys, *[o.combine(r, F.col(f"_old_{n}"), F.col(n)).alias(n) for n, r in runs.items()]
    )
    log.put(batch_id, new.withColumn("_gone", F.lit(False)))
    rows = joined(local, "left")
    total = {n: o.combine(r, F.col(f"_old_{n}"), F.col(n)) for n, r in runs.items()}
    return rows.select(
        *batch.columns, *[(c["v"] if values[n].kind == "previous" else c).alias(n) for n, c in total.items()]
    )


class RunningValues(Incremental):
    """Running values per key: the rows with ``values`` (see ``ordered``) added."""

    def __init__(self, spark, folder, sink, keys: Sequence[str], seq: str, values: dict[str, o.Running]):
        super().__init__(spark, folder, sink)
        self.keys, self.seq, self.values = list(keys), seq, values

    def step(self, batch, batch_id, ended):
        out = carried(self.log("running", self.keys), batch, batch_id, self.keys, [self.seq], self.values)
        self.sink(out, batch_id)


class DistinctSoFar(Incremental):
    """Per row how many different values its key has shown. State: the pairs seen."""

    def __init__(self, spark, folder, sink, keys: Sequence[str], seq: str, value: str, name: str = "distinct_count"):
        super().__init__(spark, folder, sink)
        self.keys, self.seq, self.value, self.name = list(keys), seq, value, name

    def step(self, batch, batch_id, ended):
        pair = [*self.keys, self.value]
        shown = batch.where(F.col(self.value).isNotNull()).groupBy(*pair).agg(F.min(self.seq).alias(self.seq))
        seen = self.log("seen", pair)
        named, match = same_keys(shown, seen.before(batch_id, shown.select(*pair).schema), pair)
        marks = shown.join(named, match, "left_anti")
        both = batch.withColumn("_mark", F.lit(1)).unionByName(
            marks.withColumn("_mark", F.lit(0)), allowMissingColumns=True
        )
        count = {self.name: o.running_count(F.when(F.col("_mark") == 0, 1))}
        order = [self.seq, "_mark"]
        out = carried(self.log("count", self.keys), both, batch_id, self.keys, order, count)
        self.sink(out.where("_mark = 1").drop("_mark"), batch_id)
        seen.put(batch_id, shown.select(*pair).withColumn("_gone", F.lit(False)))


class CountWindows(Incremental):
    """After every ``slide`` rows of a key the sum of its last ``size`` rows, as a difference
    of two running sums. State: count and sum, and the running sums of the last rows."""

    def __init__(self, spark, folder, sink, keys: Sequence[str], seq: str, value: str, size: int, slide: int):
        super().__init__(spark, folder, sink)
        self.keys, self.seq, self.value, self.size, self.slide = list(keys), seq, value, size, slide

    def step(self, batch, batch_id, ended):
        value = F.col(self.value)
        values = {"_rn": o.running_count(), "_sum": o.running_sum(value), "_n": o.running_count(value)}
        rows = carried(self.log("running", self.keys), batch, batch_id, self.keys, [self.seq], values)
        rows = rows.select(*self.keys, "_rn", F.coalesce("_sum", F.lit(0)).alias("_sum"), "_n")
        tail = F.array_sort(F.collect_list(F.struct("_rn", "_sum", "_n"))).alias("_tail")
        kept = self.log("tail", self.keys)
        schema = rows.groupBy(*self.keys).agg(tail).schema
        old = kept.before(batch_id, schema).select(*self.keys, F.inline("_tail"))
        # Each firing meets the one row that stands just before its window.
        ends = rows.where(F.col("_rn") % self.slide == 0)
        starts = rows.unionByName(old).where((F.col("_rn") + self.size) % self.slide == 0).select(
            *self.keys,
            (F.col("_rn") + self.size).alias("_rn"),
            F.col("_sum").alias("_less"),
            F.col("_n").alias("_fewer"),
        )
        named, match = same_keys(ends, starts, [*self.keys, "_rn"])
        some = F.col("_n") > F.coalesce("_fewer", F.lit(0))
        out = ends.join(named, match, "left").select(
            *self.keys,
            (F.col("_rn") / self.slide).cast("long").alias("firing"),
            F.when(some, F.col("_sum") - F.coalesce("_less", F.lit(0))).alias("total"),
        )
        self.sink(out, batch_id)
        most = rows.groupBy(*self.keys).agg(F.max("_rn").alias("_most"))
        named, match = same_keys(rows, most, self.keys)
        recent = rows.unionByName(old).join(named, match).where(F.col("_rn") > F.col("_most") - self.size)
        kept.put(batch_id, recent.groupBy(*self.keys).agg(tail).withColumn("_gone", F.lit(False)))


class Firings(Incremental):
    """Tumbling windows with allowed lateness: the count when a window first fires, and again
    for each late row it still accepts, as ``eventtime.firings``. Every row finds the
    watermark of the rows before it. State: the counts of windows until they are gone."""

    def __init__(self, spark, folder, sink, keys, rt, seq, size, bound="0 seconds", lateness="0 seconds"):
        super().__init__(spark, folder, sink)
        self.keys, self.rt, self.seq = list(keys), rt, seq
        self.size, self.bound, self.lateness = size, bound, lateness

    def step(self, batch, batch_id, ended):
        before, after = self.watermarks(batch, self.rt, self.bound, batch_id)
        found = {"_latest": o.running_max(epoch_micros(F.col(self.rt)), before=True)}
        marked = o.running(batch, [], [self.seq], found)
        wm = F.col("_latest") - F.lit(micros(self.bound))
        marked = marked.withColumn("wm_before", F.greatest(wm, F.lit(before).cast("long"))).drop("_latest")
        accepted = with_status(marked, self.rt, self.size, self.lateness).where(F.col("status") != LATE)
        group = [*self.keys, "window_start", "window_end"]
        late = F.col("status") == REFIRE
        counts = accepted.groupBy(*group).agg(
            F.count(F.when(~late, 1)).alias("on_time"), F.count(F.when(late, 1)).alias("late")
        )
        state = self.log("windows", group)
        schema = T.StructType([*counts.schema.fields, T.StructField("fired", T.BooleanType())])
        old = state.before(batch_id, schema)
        both = old.unionByName(counts.withColumn("fired", F.lit(False))).groupBy(*group).agg(
            F.sum("on_time").alias("on_time"), F.sum("late").alias("late"), F.max("fired").alias("fired")
        )
        closing = epoch_micros(F.col("window_end")) - 1000
        now = F.lit(after).cast("long")
        due = F.lit(True) if ended else F.coalesce(closing <= now, F.lit(False))
        first = both.where(~F.col("fired") & due & (F.col("on_time") > 0)).select(
            *group, F.lit(None).cast("long").alias(self.seq), F.col("on_time").alias("cnt"), F.lit(ON_TIME).alias("firing")
        )
        # Rows on time precede the late ones of their window.
        refires = accepted.where(late)
        nth = o.running(refires, group, [self.seq], {"_nth": o.running_count()})
        named, match = same_keys(nth, both.select(*group, F.col("on_time").alias("_on")), group)
        nth = nth.join(named, match).drop(*[f"_k_{g}" for g in group])
        named, match = same_keys(nth, old.select(*group, F.col("late").alias("_late")), group)
        again = nth.join(named, match, "left").select(
            *group,
            F.col(self.seq).cast("long").alias(self.seq),
            (F.col("_on") + F.coalesce("_late", F.lit(0)) + F.col("_nth")).alias("cnt"),
            F.lit(REFIRE).alias("firing"),
        )
        self.sink(first.unionByName(again), batch_id)
        gone = F.coalesce(closing + F.lit(micros(self.lateness)) <= now, F.lit(False))
        state.put(batch_id, both.withColumn("fired", F.col("fired") | due).withColumn("_gone", gone))


class _InOrder(Incremental):
    """Base of operators in event-time order: rows wait until the watermark has passed them.

    A row whose time the watermark had passed before its micro-batch is late and left out,
    one without a time too.
    """

    rt, bound = "rt", "0 seconds"

    def released(self, batch, batch_id, ended, kept: DataFrame | None = None):
        """Rows now in order (with ``kept``), rows still waiting, the watermarks."""
        before, after = self.watermarks(batch, self.rt, self.bound, batch_id)
        time = epoch_micros(F.col(self.rt))
        fresh = batch.where(time.isNotNull() if before is None else time >= before)
        rows = fresh if kept is None else kept.unionByName(fresh)
        if ended:
            return rows, rows.where(F.lit(False)), before, None
        if after is None:
            return rows.where(F.lit(False)), rows, before, after
        return rows.where(time < after), rows.where(time >= after), before, after


class OverRange(_InOrder):
    """``count(column) over (partition by keys order by rt)`` of a stream: rows of equal time
    see each other. State: rows that wait, and the counts."""

    def __init__(self, spark, folder, sink, keys, rt, column, name, bound="0 seconds"):
        super().__init__(spark, folder, sink)
        self.keys, self.rt, self.column, self.name, self.bound = list(keys), rt, column, name, bound

    def step(self, batch, batch_id, ended):
        waiting = self.log("waiting")
        rows, later, _, _ = self.released(batch, batch_id, ended, waiting.before(batch_id, batch.schema))
        steps = rows.groupBy(*self.keys, self.rt).agg(F.count(self.column).alias("_n"))
        sums = {self.name: o.running_sum(F.col("_n"))}
        counted = carried(self.log("count", self.keys), steps, batch_id, self.keys, [self.rt], sums)
        named, match = same_keys(rows, counted.drop("_n"), [*self.keys, self.rt])
        self.sink(rows.join(named, match).select(*batch.columns, self.name), batch_id)
        waiting.put(batch_id, later)


class Patterns(_InOrder):
    """``patterns.match_pattern`` over a stream: matches when their last row is in order, and
    partial matches when the watermark has passed their timeout.

    The sink gets ``(kind, key, <a column per stage>, timeout_ts)``; ``kind`` is match or
    timeout. State: with ``within`` the rows it reaches back to; without, the rows from a key's
    first start that still waits, so a key without one keeps nothing.
    """

    def __init__(self, spark, folder, sink, key, time, seq, stages: Sequence[Stage], within=None, bound="0 seconds"):
        super().__init__(spark, folder, sink)
        if any(s.times != (1, 1) for s in stages):
            raise ValueError("times is not supported on a stream")
        if within is None and any(s.contiguity == FOLLOWED_BY_ANY for s in stages):
            raise ValueError("on a stream followed_by_any needs within")
        self.key, self.rt, self.seq = list(key), time, seq
        self.stages, self.within, self.bound = list(stages), within, bound

    def step(self, batch, batch_id, ended):
        log = self.log("rows")
        rows, later, before, after = self.released(batch, batch_id, ended, log.before(batch_id, batch.schema))
        found = match_pattern(rows, self.key, self.rt, self.seq, self.stages, self.within)
        names = [s.name for s in self.stages]
        # What ended before this micro-batch's rows came out then.
        new = F.lit(True) if before is None else epoch_micros(F.col(names[-1])[self.rt]) >= before
        shape = [*self.key, *names]
        out = found["matches"].where(new).select(
            F.lit("match").alias("kind"), *shape, F.lit(None).cast(found["timeouts"].schema["timeout_ts"].dataType).alias("timeout_ts")
        )
        if self.within is not None:
            due = epoch_micros(F.col("timeout_ts"))
            passed = F.lit(True) if before is None else due > before
            if not ended:
                passed = passed & (F.lit(False) if after is None else due <= after)
            partial = found["timeouts"].where(passed).withColumn("kind", F.lit("timeout"))
            out = out.unionByName(partial, allowMissingColumns=True)
        self.sink(out, batch_id)
        if after is None:
            kept = rows
        elif self.within is not None:
            kept = rows.where(epoch_micros(F.col(self.rt)) > after - micros(self.within))
        else:
            begins = F.struct(F.col(f"_first.{self.rt}"), F.col(f"_first.{self.seq}"))
            open_from = found["waiting"].groupBy(*self.key).agg(F.min(begins).alias("_from"))
            named, match = same_keys(rows, open_from, self.key)
            kept = rows.join(named, match).where(F.struct(self.rt, self.seq) >= F.col("_from")).select(*batch.columns)
        log.put(batch_id, kept.unionByName(later))


class Waiting(Incremental):
    """One-to-one matching of two sides (``joins.match_waiting``) over a stream whose rows have
    ``is_left``: matches, and rows without partner once ``deadline`` after their event time
    has passed, or at the end. The sink gets ``(keys, left, right)``, each the row's ``seq``
    or null. State: the row that waits for each key."""

    def __init__(self, spark, folder, sink, keys, seq, rt=None, deadline=None, bound="0 seconds"):
        super().__init__(spark, folder, sink)
        self.keys, self.seq, self.rt, self.deadline, self.bound = list(keys), seq, rt, deadline, bound

    def step(self, batch, batch_id, ended):
        state = self.log("waiting", self.keys)
        old = state.before(batch_id, batch.schema)
        rows = old.unionByName(batch)
        found = match_waiting(rows.where("is_left"), rows.where("not is_left"), self.keys, self.seq)
        left = found["left"].unionByName(found["right"])
        over = F.lit(ended)
        if self.deadline is not None:
            _, after = self.watermarks(batch, self.rt, self.bound, batch_id)
            if after is not None:
                past = epoch_micros(F.col(self.rt)) + F.lit(micros(self.deadline)) <= after
                over = over | F.coalesce(past, F.lit(False))
        pair = found["matches"].select(
            *[F.col(f"l_{k}").alias(k) for k in self.keys],
            F.col(f"l_{self.seq}").alias("left"),
            F.col(f"r_{self.seq}").alias("right"),
        )
        alone = left.where(over).select(
            *self.keys,
            F.when(F.col("is_left"), F.col(self.seq)).alias("left"),
            F.when(~F.col("is_left"), F.col(self.seq)).alias("right"),
        )
        self.sink(pair.unionByName(alone), batch_id)
        # All keys seen now change: they wait with a new row, or are done.
        still = left.where(~over).withColumn("_gone", F.lit(False))
        named, match = same_keys(rows, still.select(*self.keys), self.keys)
        done = rows.dropDuplicates(self.keys).join(named, match, "left_anti").withColumn("_gone", F.lit(True))
        state.put(batch_id, still.unionByName(done))


class TopWindows(Incremental):
    """The ``n`` most frequent keys of each sliding window, once the watermark has passed its
    end. Counts are combined before they are shuffled, and of a closed window each task sends
    its ``n`` best only. State: the counts of open windows."""

    def __init__(self, spark, folder, sink, key, rt, size, slide, n, bound="0 seconds"):
        super().__init__(spark, folder, sink)
        self.key, self.rt, self.size, self.slide, self.n, self.bound = key, rt, size, slide, n, bound

    def step(self, batch, batch_id, ended):
        before, after = self.watermarks(batch, self.rt, self.bound, batch_id)
        window = F.window(self.rt, self.size, self.slide)["end"].alias("window_end")
        counts = batch.select(self.key, window).groupBy("window_end", self.key).agg(F.count("*").alias("cnt"))
        closing = epoch_micros(F.col("window_end")) - 1000
        if before is not None:
            # Rows of windows that have been ranked are late.
            counts = counts.where(closing > before)
        state = self.log("counts", ["window_end", self.key])
        old = state.before(batch_id, counts.schema)
        both = old.unionByName(counts).groupBy("window_end", self.key).agg(F.sum("cnt").alias("cnt"))
        closed = F.lit(True) if ended else F.coalesce(closing <= F.lit(after).cast("long"), F.lit(False))
        best = ranking.top_n(both.where(closed), ["window_end"], "cnt", [self.key], self.n)
        self.sink(best.select("window_end", self.key, "cnt", "rank"), batch_id)
        state.put(batch_id, both.withColumn("_gone", closed))


def collect_incremental(
    spark: SparkSession, stream: DataFrame, name: str, make: Callable[..., Incremental], *args, **options
) -> DataFrame:
    """Run ``make(spark, folder, sink, ...)`` over the data available now to the end of the
    input; gives all its results."""
    folder = run_folder(spark, name)
    schemas = []
    write = parquet_log(f"{folder}/out")

    def sink(out: DataFrame, batch_id: int) -> None:
        schemas[:] = [out.schema]
        write(out, batch_id)

    operator = make(spark, folder, sink, *args, **options)
    start(stream, operator, f"{folder}/checkpoint").awaitTermination()
    operator.finish(stream.schema)
    out = spark.read.schema(schemas[0]).option("basePath", f"{folder}/out")
    return out.parquet(f"{folder}/out").select(*schemas[0].names)
