"""The per-event rules as a stream, by transformWithState: closed windows and late events, exactly.

State is a WatermarkMachine for each pipeline; rows of a micro-batch are taken in order of arrival. Parallelism is the
number of pipelines, as the rules order all sources of one against each other; streams that only need results covered
by the allowed lateness are better served by `native`. Keys are remembered as long as the lateness asks for, unless told
otherwise, so state grows with open windows alone. Needs the RocksDB state store provider.

The clock, for sources that have fallen silent, is the time of arrival: a row tells the time to all sources of its pipeline,
and where no row comes a timer does, each tick_ms of processing time.
"""

from __future__ import annotations

import pickle
import time
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from aerolith.operators.windows import minimum_retention
from aerolith.streaming.machine import WatermarkMachine

OUTPUT = "pipeline long, kind string, window_us long, cell string, n long, alt long, vel long, icao24 string, event_us long, src long, frontier_us long"
ORDER = ["ingest_us", "icao24", "event_us", "copy"]
NAMES = [x.split()[0] for x in OUTPUT.split(", ")]


class WindowProcessor(StatefulProcessor):
    def __init__(self, width_us: int, lateness_us: int, keep_windows: int | None = None, idle_after_us: int | None = None, awaited: Sequence = (), tick_ms: int | None = None):
        self.config, self.awaited, self.tick_ms = (width_us, lateness_us, keep_windows, idle_after_us), tuple(awaited), tick_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("machine", "blob binary")

    def _machine(self) -> WatermarkMachine:
        return pickle.loads(self.state.get()[0]) if self.state.exists() else WatermarkMachine(*self.config, awaited=set(self.awaited))

    def _frame(self, rows: list) -> pd.DataFrame:
        frame = pd.DataFrame(rows, columns=NAMES)
        for c in ("window_us", "n", "alt", "vel", "event_us", "src", "frontier_us"):
            frame[c] = frame[c].astype("Int64")
        return frame

    def _window(self, key, machine: WatermarkMachine, k, x, kind: str) -> tuple:
        return (key[0], kind, k[0], k[1], x[0], x[1], x[2], None, None, None, machine.frontier)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        machine, out, clock = self._machine(), [], self.config[3] is not None
        for r in pd.concat(rows).sort_values(ORDER).itertuples():
            if r.icao24 == "":  # the end of a bounded stream
                out += [self._window(key, machine, k, x, "flushed") for k, x in machine.close()]
                continue
            now = int(r.ingest_us) if clock else None
            what, closed = machine.offer(int(r.src), (r.icao24, int(r.event_us)), r.cell, int(r.event_us), int(r.alt_cm), int(r.vel_cm), now)
            if what[0] == "late":
                out.append((key[0], "late", what[1], r.cell, None, None, None, r.icao24, int(r.event_us), int(r.src), what[2]))
            out += [self._window(key, machine, k, x, "closed") for k, x in closed]
        self.state.update((pickle.dumps(machine),))
        self._set_timer(timers)
        yield self._frame(out)

    def _set_timer(self, timers) -> None:
        if self.tick_ms is not None:
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at[0] if isinstance(at, tuple) else at)
            self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + self.tick_ms)

    def handleExpiredTimer(self, key, timers, expired) -> Iterator[pd.DataFrame]:
        machine = self._machine()
        out = [self._window(key, machine, k, x, "closed") for k, x in machine.tick(int(time.time() * 1e6))]
        self.state.update((pickle.dumps(machine),))
        self._set_timer(timers)
        yield self._frame(out)

    def close(self) -> None:
        pass


def exact_windows(
    arrivals: DataFrame, width_us: int, lateness_us: int, keep_windows: int | None = None, idle_after_us: int | None = None, awaited: Sequence = (), tick_ms: int | None = None
) -> DataFrame:
    """arrivals: a stream with a pipeline column. A row with an empty icao24, last in order, flushes its pipeline.

    idle_after_us: a source not heard for so long has no say in the watermark until it is heard again. awaited: sources before
    whose first row no window closes, unless they fall silent. tick_ms: how often a pipeline without rows looks at the clock.
    """
    keep = minimum_retention(lateness_us, width_us) if keep_windows is None else keep_windows
    minimum_retention(lateness_us, width_us, keep)
    processor = WindowProcessor(width_us, lateness_us, keep, idle_after_us, awaited, tick_ms)
    mode = "None" if tick_ms is None else "ProcessingTime"
    return arrivals.groupBy("pipeline").transformWithStateInPandas(statefulProcessor=processor, outputStructType=OUTPUT, outputMode="Append", timeMode=mode)
