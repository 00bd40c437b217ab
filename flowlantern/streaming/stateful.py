"""Stateful streams: anchored rate limits and flow assembly.

Keys are dealt out to buckets by their hash, and a bucket has one state (``transformWithStateInPandas``): the open entries
of its keys, the rows that the watermark has not passed yet, and one event-time timer for the next of them to come due or
the next entry to end. A micro-batch costs one call for each bucket, not for each key, and a call works on columns. Rows
are applied in the order of their times, once no earlier one can come, so the result does not depend on how they were
delivered. Rows without a time belong nowhere and are left out. The waiting rows are read back only when one of them is
due, the entries only when a row or an end is. The state store has to be RocksDB (``session.STREAM_CONF``).

The number of buckets stays the same over the runs of a checkpoint.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import ListState, StatefulProcessor, StatefulProcessorHandle

from flowlantern.functions.measures import MICROS
from flowlantern.operators.alerts import TRACKERS
from flowlantern.operators.sessions import FIVE_TUPLE, IDLE_SECONDS

# The steps below travel to the executors as code, so these need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 256
BLOCK_ROWS = 1 << 16  # of the stored state

# A row until its time has come: its key, microseconds, two numbers and a text that the handlers read.
WAITING = ["key", "at", "a", "b", "label"]

# (rows of a bucket whose time has come, its open entries: key and numbers) -> finished rows, entries to keep
Handler = Callable[[pd.DataFrame, pd.DataFrame], tuple[pd.DataFrame, pd.DataFrame]]


def expiry_ms(micros: pd.Series) -> pd.Series:
    """The first millisecond after an instant; the entry is over once the watermark is past it."""
    return -(-(micros + 1) // 1000)


def _blocks(rows: pd.DataFrame) -> Iterator[tuple[bytes]]:
    for at in range(0, len(rows), BLOCK_ROWS):
        table = pa.Table.from_pandas(rows.iloc[at : at + BLOCK_ROWS], preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(table)
        yield (sink.getvalue().to_pybytes(),)


def _stored_rows(state: ListState) -> list[pd.DataFrame]:
    return [pa.ipc.open_stream(block).read_pandas() for (block,) in list(state.get())]


def _replace(state: ListState, rows: pd.DataFrame) -> None:
    state.put(list(_blocks(rows))) if len(rows) else state.clear()


class InOrder(StatefulProcessor):
    """Applies ``arrive`` to the rows of a bucket in the order of their times and takes out the entries that are over.

    Entries are a key and ``width`` numbers and over when the watermark is past ``ends_at``; results are rows of
    ``names`` behind the key, which is what ``leave`` makes of entries that are over.
    """

    def __init__(
        self,
        names: list[str],
        width: int,
        arrive: Handler,
        ends_at: Callable[[pd.DataFrame], pd.Series],
        leave: Callable[[pd.DataFrame], pd.DataFrame],
    ) -> None:
        self.names, self.numbers = ["key", *names], [f"n{i}" for i in range(width)]
        self.arrive, self.ends_at, self.leave = arrive, ends_at, leave

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # when the first waiting row is due, the first entry ends and the timer rings, in milliseconds
        self.times = handle.getValueState("times", "due bigint, ends bigint, timer bigint")
        self.entries = handle.getListState("entries", "block binary")
        self.waiting = handle.getListState("waiting", "block binary")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = pd.concat([part[WAITING] for part in rows], ignore_index=True)
        yield from self._step(fresh, timerValues.getCurrentWatermarkInMs(), False)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._step(None, timerValues.getCurrentWatermarkInMs(), True)

    def _step(self, fresh: pd.DataFrame | None, watermark: int, rang: bool) -> Iterator[pd.DataFrame]:
        known = self.times.get()
        due, ends, timer = known or (None, None, None)
        held = due is not None and due < watermark
        parts = (_stored_rows(self.waiting) if held else []) + ([] if fresh is None else [fresh])
        rows = pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({name: [] for name in WAITING})
        come = rows["at"] // 1000 < watermark
        kept = rows[~come]
        if held:
            _replace(self.waiting, kept)
        elif len(kept):
            self.waiting.appendList(list(_blocks(kept)))
        dues = [] if held or due is None else [due]
        due = min([*dues, int(kept["at"].min() // 1000)] if len(kept) else dues, default=None)

        if come.any() or (ends is not None and ends < watermark):
            entries = _stored_rows(self.entries) if ends is not None else []
            none = pd.DataFrame({"key": pd.Series(dtype=object), **{name: pd.Series(dtype="int64") for name in self.numbers}})
            done, entries = self.arrive(rows[come], pd.concat(entries, ignore_index=True) if entries else none)
            over = self.ends_at(entries) < watermark
            for found in (done, self.leave(entries[over])):
                if len(found):
                    found.columns = self.names
                    yield found
            entries = entries[~over]
            _replace(self.entries, entries)
            ends = int(self.ends_at(entries).min()) if len(entries) else None

        # A timer rings when the watermark reaches it and is deleted then, even if it was set again; work begins behind that.
        ring = min([x + 1 for x in (due, ends) if x is not None], default=None)
        if rang:
            timer = None  # it is gone
        if timer is not None and timer != ring:
            self.handle.deleteTimer(timer)
        if ring is not None and timer != ring:
            self.handle.registerTimer(ring)
        if ring is not None:
            self.times.update((due, ends, ring))
        elif known:
            self.times.clear()


def _in_order(
    rows: DataFrame,
    output: str,
    width: int,
    arrive: Handler,
    ends_at: Callable[[pd.DataFrame], pd.Series],
    leave: Callable[[pd.DataFrame], pd.DataFrame],
    buckets: int,
) -> DataFrame:
    """``key`` and ``output`` of the rows (``key``, the watermarked time, ``WAITING``) as their times pass."""
    names = [field.split()[0] for field in output.split(", ")]
    step = InOrder(names, width, arrive, ends_at, leave)
    dealt = rows.where(F.col("at").isNotNull()).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    return dealt.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=step, outputStructType=f"key string, {output}", outputMode="Append", timeMode="EventTime"
    )


def _keyed(table: DataFrame, key: Sequence[str]) -> DataFrame:
    # Keys travel as JSON text, which keeps their types and NULLs without Python knowing them.
    return table.withColumn("key", F.to_json(F.struct(*key)))


def _unpacked(found: DataFrame, table: DataFrame, key: Sequence[str]) -> DataFrame:
    layout = T.StructType([T.StructField(name, table.schema[name].dataType, True) for name in key])
    rest = [name for name in found.columns if name != "key"]
    return found.select(F.inline(F.array(F.from_json("key", layout))), *rest)


def _kept_ranks(rank: np.ndarray, kind: str, n: int) -> np.ndarray:
    if kind == "limit":
        return rank <= n
    return rank == n if kind == "both" else rank % n == 0


def limit_positions(
    times: np.ndarray, start: int | None, count: int, kind: str, n: int, period: int
) -> tuple[np.ndarray, int, int]:
    """Mask of kept events for sorted ``times``, and the open period's start and count.

    A period opens with the first event after the previous one ran out. The loop steps over periods,
    not events.
    """
    kept = np.zeros(len(times), dtype=bool)
    at = 0
    while at < len(times):
        if start is None or times[at] >= start + period:
            start, count = int(times[at]), 0
        end = int(np.searchsorted(times, start + period, side="left"))
        kept[at:end] = _kept_ranks(count + 1 + np.arange(end - at), kind, n)
        count += end - at
        at = end
    return kept, start, count


def rate_limit_stream(
    alerts: DataFrame,
    kind: str = "limit",
    n: int = 1,
    seconds: int = 60,
    track: str = "by_src",
    late: str = "10 minutes",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Alerts left after a limit whose periods start with the first alert (``sig_id``, address, ``ts``,
    ``alert_id``), once the watermark has passed them. State per signature and address is two numbers, dropped
    when the period is over, and the alerts within the lateness."""
    if kind not in ("limit", "threshold", "both"):
        raise ValueError(f"kind must be limit, threshold or both, not {kind!r}")
    key = ["sig_id", TRACKERS[track]]
    period = seconds * MICROS

    def arrive(rows: pd.DataFrame, entries: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
        rows = rows.assign(place=rows["label"].fillna("")).sort_values(["key", "at", "place"])  # of a moment by their texts
        keys, times = rows["key"].to_numpy(), rows["at"].to_numpy(np.int64)
        opened = {key: entry for key, *entry in entries.itertuples(index=False)}
        edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True]) if len(keys) else np.zeros(1, int)
        masks = [np.empty(0, bool)]
        for first, end in zip(edges[:-1], edges[1:]):
            kept, *opened[keys[first]] = limit_positions(times[first:end], *opened.get(keys[first], (None, 0)), kind, n, period)
            masks.append(kept)
        left = pd.DataFrame([(key, *entry) for key, entry in opened.items()], columns=entries.columns)
        return rows.loc[np.concatenate(masks), ["key", "at", "label"]], left

    timed = _keyed(alerts.withWatermark("ts", late), key).select(
        "key", "ts", F.unix_micros("ts").alias("at"), *[F.lit(0).cast("bigint").alias(c) for c in "ab"],
        F.col("alert_id").alias("label"),
    )
    kept = _in_order(
        timed,
        "at bigint, alert_id string",
        2,
        arrive,
        lambda entries: expiry_ms(entries["n0"] + period),
        lambda entries: pd.DataFrame(),
        buckets,
    )
    return _unpacked(kept, alerts, key).select(*key, F.timestamp_micros("at").alias("ts"), "alert_id")


def cut_flows(times: np.ndarray, start: int, last: int, idle: int, life: int) -> list[int]:
    """Positions at which a new flow begins, for sorted ``times`` following an open flow."""
    previous = np.concatenate(([last], times[:-1]))
    idle_cuts = np.flatnonzero(times - previous > idle)
    cuts: list[int] = []
    at = 0
    while True:
        nearest = np.searchsorted(idle_cuts, at)
        by_idle = int(idle_cuts[nearest]) if nearest < len(idle_cuts) else len(times)
        cut = min(by_idle, max(at, int(np.searchsorted(times, start + life, side="right"))))
        if cut >= len(times):
            return cuts
        cuts.append(cut)
        start, at = int(times[cut]), cut + 1


def assembled(rows: pd.DataFrame, entries: pd.DataFrame, idle: int, life: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The flows of many keys that end within ``rows``, and the last flow of each key. An open flow (start, last time,
    packets, bytes, records) goes on where it stood."""
    codes, keys = pd.factorize(pd.concat([entries["key"], rows["key"]], ignore_index=True))
    opened, new = entries.to_numpy()[:, 1:].astype(np.int64), rows[["at", "at", "a", "b"]].to_numpy().astype(np.int64)
    facts = np.concatenate([opened, np.c_[new, np.ones(len(new), np.int64)]])
    order = np.lexsort((facts[:, 0], codes))  # a key's open flow stays in front of its rows
    codes, facts = codes[order], facts[order]
    begin, last = facts[:, 0], facts[:, 1]
    quiet = np.r_[True, (codes[1:] != codes[:-1]) | (begin[1:] - last[:-1] > idle)][: len(codes)]
    first = np.flatnonzero(quiet)
    end = np.r_[first[1:], len(codes)][: len(first)]
    old = begin[end - 1] - begin[first] > life
    cuts = [x + np.array(cut_flows(begin[x:y], begin[x], begin[x], math.inf, life)) for x, y in zip(first[old], end[old])]
    first = np.sort(np.concatenate([first, *cuts]))
    ends = np.r_[first[1:], len(codes)][: len(first)] - 1
    sums = [np.add.reduceat(facts[:, i], first) if len(first) else begin for i in (2, 3, 4)]
    flows = pd.DataFrame(dict(zip(entries.columns, [keys.take(codes[first]), begin[first], last[ends], *sums])))
    newest = np.r_[codes[first][1:] != codes[first][:-1], True][: len(flows)]
    return flows[~newest], flows[newest]


def assemble_flows_stream(
    records: DataFrame,
    idle: int = IDLE_SECONDS,
    max_life: int | None = IDLE_SECONDS,
    key: Sequence[str] = FIVE_TUPLE,
    time: str = "event_time",
    late: str = "1 minute",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Flows of a stream: a flow ends when it is idle for longer than ``idle`` seconds or, with
    ``max_life``, at the first record more than that after its start.

    Output appears when the flow is over; flows still open stay in the state. Without ``max_life`` the
    built-in session window does the work.
    """
    timed = records.withWatermark(time, late)
    if max_life is None:
        session = F.session_window(time, f"{idle} seconds")
        merged = timed.groupBy(*key, session).agg(
            F.min(time).alias("start_time"),
            F.max(time).alias("end_time"),
            F.sum("packets").alias("packets"),
            F.sum("bytes").alias("bytes"),
            F.count(F.lit(1)).alias("records"),
        )
        return merged.select(*key, "start_time", "end_time", "packets", "bytes", "records")

    idle_micros, life_micros = idle * MICROS, max_life * MICROS

    def arrive(rows: pd.DataFrame, entries: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
        return assembled(rows, entries, idle_micros, life_micros)

    keyed = _keyed(timed, key).select(
        "key",
        time,
        F.unix_micros(time).alias("at"),
        F.coalesce(F.col("packets").cast("bigint"), F.lit(0)).alias("a"),
        F.coalesce(F.col("bytes").cast("bigint"), F.lit(0)).alias("b"),
        F.lit(None).cast("string").alias("label"),
    )
    over = _in_order(
        keyed,
        "start_at bigint, last_at bigint, packets bigint, bytes bigint, records bigint",
        5,
        arrive,
        lambda entries: expiry_ms(np.minimum(entries["n1"] + idle_micros, entries["n0"] + life_micros)),
        lambda entries: entries,
        buckets,
    )
    return _unpacked(over, records, key).select(
        *key,
        F.timestamp_micros("start_at").alias("start_time"),
        F.timestamp_micros("last_at").alias("end_time"),
        "packets",
        "bytes",
        "records",
    )
