"""Event-time windows over arrivals: ground truth, the processing-time baseline, and exact watermarks.

Arrivals have icao24, event_us, ingest_us, cell, src, alt_cm, vel_cm and a tiebreak column. Their total order is by
ingest time, then icao24, event time and the tiebreak. Rules, as the reference semantics have them: a repeated
(icao24, event time) counts once and moves nothing; a window closes when its end is at or before the frontier, the
highest watermark so far; an event is late if its window is closed when it arrives, and late or not it then raises its
source's mark; the watermark is the least mark of the sources heard, less the allowed lateness.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.functions.telemetry import iso_utc, mean_4dp, tumble
from aerolith.operators.slices import MINUTE_US, SLICE_ROWS, sliced

ORDER = ("ingest_us", "icao24", "event_us", "copy")
KEY = ("icao24", "event_us")


def first_copies(arrivals: DataFrame) -> DataFrame:
    """The first arrival of each key."""
    w = Window.partitionBy(*KEY).orderBy(*ORDER)
    return arrivals.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def aggregate(rows: DataFrame, time: str, width_us: int) -> DataFrame:
    """window_us, cell, n, avg_altitude, avg_velocity. Partial sums are taken before the shuffle."""
    out = rows.groupBy(tumble(F.col(time), width_us).alias("window_us"), "cell").agg(F.count(F.lit(1)).alias("n"), F.sum("alt_cm").alias("alt"), F.sum("vel_cm").alias("vel"))
    return out.select("window_us", "cell", "n", mean_4dp(F.col("alt"), F.col("n")).alias("avg_altitude"), mean_4dp(F.col("vel"), F.col("n")).alias("avg_velocity"))


def ground_truth(arrivals: DataFrame, width_us: int) -> DataFrame:
    return aggregate(first_copies(arrivals), "event_us", width_us)


def naive(arrivals: DataFrame, width_us: int) -> DataFrame:
    """Windows by the time of arrival."""
    return aggregate(first_copies(arrivals), "ingest_us", width_us)


def annotate(arrivals: DataFrame, sources: Sequence[int], width_us: int, lateness_us: int, slice_us: int = MINUTE_US, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """First copies with window_us, mark_us (the watermark after the row), frontier_us (before it) and is_late."""
    return _marked(first_copies(arrivals), sources, width_us, lateness_us, slice_us, slice_rows)


def _marked(rows: DataFrame, sources: Sequence[int], width_us: int, lateness_us: int, slice_us: int, slice_rows: int) -> DataFrame:
    """Running maxima over the whole order are taken in slices of it: maxima within a slice run in its own task, and what
    earlier slices add is a scan over one row a slice. An order of one slice needs neither."""
    rows, n = sliced(rows, ORDER[0], "_slice", slice_us, slice_rows)
    inside = Window.partitionBy("_slice").orderBy(*ORDER) if n > 1 else Window.orderBy(*ORDER)
    upto, before = inside.rowsBetween(Window.unboundedPreceding, 0), inside.rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    of = lambda s: F.max(F.when(F.col("src") == s, F.col("event_us")))
    # greatest and least pass over nulls, so a source that was not heard yet has no say
    skip = lambda f, cols: cols[0] if len(cols) == 1 else f(*cols)
    marks = [of(s).over(upto) for s in sources]
    if n > 1:
        carried = rows.groupBy("_slice").agg(*[of(s).alias(f"_s{s}") for s in sources])
        carried = carried.select("_slice", *[F.max(f"_s{s}").over(earlier).alias(f"_c{s}") for s in sources])
        rows = rows.join(carried, "_slice")
        marks = [F.greatest(F.col(f"_c{s}"), m) for s, m in zip(sources, marks, strict=True)]
    rows = rows.withColumns({f"_m{s}": m for s, m in zip(sources, marks, strict=True)})
    rows = rows.withColumn("mark_us", skip(F.least, [F.col(f"_m{s}") for s in sources]) - lateness_us)
    rows = rows.drop(*[f"{x}{s}" for s in sources for x in ("_c", "_m")])
    frontier = F.max("mark_us").over(before)
    if n > 1:
        reached = rows.groupBy("_slice").agg(F.max("mark_us").alias("_top")).select("_slice", F.max("_top").over(earlier).alias("_carried"))
        rows, frontier = rows.join(reached, "_slice"), F.greatest(F.col("_carried"), frontier)
    rows = rows.withColumn("frontier_us", frontier).withColumn("window_us", tumble(F.col("event_us"), width_us))
    late = F.col("frontier_us").isNotNull() & (F.col("window_us") + width_us <= F.col("frontier_us"))
    return rows.withColumn("is_late", late).drop("_slice", "_carried")


def outcomes(arrivals: DataFrame, sources: Sequence[int], width_us: int, lateness_us: int, keep_windows: int | None = None, slice_us: int = MINUTE_US, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """All arrivals, repeats among them, with window_us, mark_us, frontier_us and outcome: counted, late or duplicate.

    keep_windows: how many windows behind the frontier keys are remembered. A repeat of a key that is forgotten is reported
    late, as its window has long been closed; only where 0 are kept may it still be open, and the repeat counts again. A
    repeat has its first copy's source and moves no mark.
    """
    marked = _marked(arrivals, sources, width_us, lateness_us, slice_us, slice_rows)
    nth = F.row_number().over(Window.partitionBy(*KEY).orderBy(*ORDER))
    forgotten = F.lit(False) if keep_windows is None else F.coalesce(F.col("window_us") < F.col("frontier_us") - keep_windows * width_us, F.lit(False))
    outcome = F.when((F.col("_nth") > 1) & ~forgotten, "duplicate").when(F.col("is_late"), "late").otherwise("counted")
    return marked.withColumn("_nth", nth).withColumn("outcome", outcome).drop("_nth", "is_late")


def on_time_windows(annotated: DataFrame, width_us: int) -> DataFrame:
    return aggregate(annotated.filter("not is_late"), "event_us", width_us)


def late_events(annotated: DataFrame) -> DataFrame:
    """The side output: lateness counts from the start of the closed window."""
    return annotated.filter("is_late").select("icao24", "event_us", "ingest_us", "cell", "src", "window_us", F.col("frontier_us").alias("watermark_us"), (F.col("frontier_us") - F.col("window_us")).alias("lateness_us"))


def recent_late(annotated: DataFrame, keep: int) -> DataFrame:
    """The last `keep` late events by arrival; the count of all is a separate matter."""
    return late_events(annotated).orderBy(F.desc("ingest_us"), F.desc("icao24"), F.desc("event_us")).limit(keep)


def accounting(arrivals: DataFrame, annotated: DataFrame) -> DataFrame:
    """One row: arrived, processed, duplicates, windowed, late, final_watermark_us, max_event_us."""
    a = arrivals.agg(F.count(F.lit(1)).alias("arrived"))
    b = annotated.agg(
        F.count(F.lit(1)).alias("processed"), F.count_if(~F.col("is_late")).alias("windowed"), F.count_if("is_late").alias("late"),
        F.max(F.greatest("frontier_us", "mark_us")).alias("final_watermark_us"), F.max("event_us").alias("max_event_us"),
    )
    return a.crossJoin(b).select("arrived", "processed", (F.col("arrived") - F.col("processed")).alias("duplicates"), "windowed", "late", "final_watermark_us", "max_event_us")


def minimum_retention(lateness_us: int, width_us: int, keep_windows: int | None = None) -> int:
    """Windows for which seen keys must be kept, lest a repeat within the lateness be told as late; warns of fewer."""
    least = -(-lateness_us // width_us) + 1
    if keep_windows is not None and keep_windows < least:
        warnings.warn(f"keys are kept for {keep_windows} windows, which is less than the {least} that the lateness needs", stacklevel=2)
    return least


def misattributed(arrivals: DataFrame, width_us: int) -> DataFrame:
    """How many first copies the baseline puts into a window that is not theirs, of how many."""
    moved = tumble(F.col("ingest_us"), width_us) != tumble(F.col("event_us"), width_us)
    return first_copies(arrivals).agg(F.count(F.lit(1)).alias("events"), F.count_if(moved).alias("misattributed"))


KEYS = ["window_us", "cell"]


def compare(truth: DataFrame, got: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """A row a window of either side: its two counts and what is wrong with it (null: nothing)."""
    a = truth.select(*KEYS, F.col("n").alias("n_true"), F.col("avg_altitude").alias("alt_true"), F.col("avg_velocity").alias("vel_true"))
    b = got.select(*KEYS, F.col("n").alias("n_got"), F.col("avg_altitude").alias("alt_got"), F.col("avg_velocity").alias("vel_got"))

    def off(x: str) -> Column:
        t, g = F.col(f"{x}_true"), F.col(f"{x}_got")
        return F.abs(t - g) > F.lit(tolerance) * F.greatest(F.abs(t), F.abs(g), F.lit(1.0))

    wrong = F.when(F.col("n_got").isNull(), "missing").when(F.col("n_true").isNull(), "phantom").when(F.col("n_true") != F.col("n_got"), "count").when(off("alt") | off("vel"), "value")
    return a.join(b, KEYS, "full_outer").select(*KEYS, "n_true", "n_got", wrong.alias("wrong"))


def roll_up(compared: DataFrame) -> DataFrame:
    error = F.abs(F.coalesce("n_true", F.lit(0)) - F.coalesce("n_got", F.lit(0)))
    kinds = {"missing": "missing", "phantom": "phantom", "count": "count_mismatch", "value": "value_mismatch"}
    return compared.agg(
        F.count(F.lit(1)).alias("total"), F.count("wrong").alias("wrong"), *[F.count_if(F.col("wrong") == k).alias(v) for k, v in kinds.items()],
        F.coalesce(F.sum(error), F.lit(0)).alias("abs_count_error"), F.coalesce(F.max(error), F.lit(0)).alias("worst"),
    )


def disagreement(truth: DataFrame, got: DataFrame) -> DataFrame:
    """Of the true windows, how many the other side lacks or counts otherwise."""
    other = got.select(*KEYS, F.col("n").alias("n_got"))
    return truth.join(other, KEYS, "left").agg(F.count(F.lit(1)).alias("windows"), F.count_if(F.coalesce(F.col("n_got") != F.col("n"), F.lit(True))).alias("disagree"))


def sweep(marked: DataFrame, width_us: int, bounds_us: Sequence[int], tolerance: float = 1e-3) -> DataFrame:
    """bound_us, total, wrong, late, abs_count_error for each bound on lateness, from one relation.

    marked: annotate()'s at lateness 0. At lateness L all marks, and so the frontier, are earlier by L; so one aggregation
    gives the true windows and, by conditional sums, those under each bound.
    """
    on_time = {b: ~F.coalesce(F.col("window_us") + width_us <= F.col("frontier_us") - b, F.lit(False)) for b in bounds_us}
    sums = [F.count(F.lit(1)).alias("n"), F.sum("alt_cm").alias("alt"), F.sum("vel_cm").alias("vel")]
    for k, b in enumerate(bounds_us):
        sums += [F.count_if(on_time[b]).alias(f"n{k}"), *[F.sum(F.when(on_time[b], F.col(f"{c}_cm"))).alias(f"{c}{k}") for c in ("alt", "vel")]]
    per_window = marked.groupBy("window_us", "cell").agg(*sums)

    def off(c: str, k: int) -> Column:
        t, g = mean_4dp(F.col(c), F.col("n")), mean_4dp(F.col(f"{c}{k}"), F.col(f"n{k}"))
        return F.abs(t - g) > F.lit(tolerance) * F.greatest(F.abs(t), F.abs(g), F.lit(1.0))

    wrong = lambda k: (F.col(f"n{k}") != F.col("n")) | off("alt", k) | off("vel", k)
    each = [F.struct(F.lit(b).alias("bound_us"), F.coalesce(wrong(k), F.lit(True)).alias("wrong"), (F.col("n") - F.col(f"n{k}")).alias("error")) for k, b in enumerate(bounds_us)]
    rows = per_window.select(F.explode(F.array(*each)).alias("x")).select("x.*")
    # what a window lacks under a bound came late
    return rows.groupBy("bound_us").agg(F.count(F.lit(1)).alias("total"), F.count_if("wrong").alias("wrong"), F.sum("error").alias("late"), F.sum("error").alias("abs_count_error"))


def _both_sides(marked: DataFrame, width_us: int, on_time: dict[str, Column]) -> tuple[DataFrame, Callable[[str, str], Column]]:
    """Per window of either kind: moved, late, and n, alt, vel of truth (t), baseline (v) and each of on_time, whose names tell
    them apart; and whether two of them differ there. Each first copy counts in the window of its event time and, as the
    baseline has it, in that of its arrival, so one aggregation compares them."""
    here, there = F.col("window_us"), tumble(F.col("ingest_us"), width_us)
    side = lambda w, true: F.struct(w.alias("w"), F.lit(true).alias("true"))
    twice = marked.withColumn("moved", here != there).withColumn("x", F.explode(F.array(side(here, True), side(there, False))))
    true = F.col("x.true")
    sums = [F.count_if(true & F.col("moved")).alias("moved"), F.count_if(true & F.col("is_late")).alias("late")]
    for name, which in {"t": true, "v": ~true, **{k: true & c for k, c in on_time.items()}}.items():
        sums += [F.count_if(which).alias(f"n_{name}"), *[F.sum(F.when(which, F.col(f"{c}_cm"))).alias(f"{c}_{name}") for c in ("alt", "vel")]]

    def differ(a: str, b: str, tolerance: float = 1e-3) -> Column:
        mean = lambda c, x: mean_4dp(F.col(f"{c}_{x}"), F.col(f"n_{x}"))
        off = lambda c: F.abs(mean(c, a) - mean(c, b)) > F.lit(tolerance) * F.greatest(F.abs(mean(c, a)), F.abs(mean(c, b)), F.lit(1.0))
        return ((F.col(f"n_{a}") > 0) | (F.col(f"n_{b}") > 0)) & F.coalesce((F.col(f"n_{a}") != F.col(f"n_{b}")) | off("alt") | off("vel"), F.lit(True))

    return twice.groupBy("x.w", "cell").agg(*sums), differ


def headline(marked: DataFrame, width_us: int) -> DataFrame:
    """One row: events, misattributed, naive_wrong, naive_windows, watermark_wrong, reported, silent."""
    rows, differ = _both_sides(marked, width_us, {"g": ~F.col("is_late")})
    out = rows.agg(
        F.sum("n_t").alias("events"), F.sum("moved").alias("misattributed"), F.count_if(differ("t", "v")).alias("naive_wrong"), F.count(F.lit(1)).alias("naive_windows"),
        F.count_if(differ("t", "g")).alias("watermark_wrong"), F.sum("late").alias("reported"), F.sum(F.abs(F.col("n_t") - F.col("n_g"))).alias("error"),
    )
    return out.select("events", "misattributed", "naive_wrong", "naive_windows", "watermark_wrong", "reported", (F.col("error") - F.col("reported")).alias("silent"))


def report(marked: DataFrame, width_us: int, bounds_us: Sequence[int]) -> DataFrame:
    """sweep() and the baseline's part of headline() in one: a row a bound. marked: annotate()'s at lateness 0."""
    late = {f"g{k}": F.coalesce(F.col("window_us") + width_us <= F.col("frontier_us") - b, F.lit(False)) for k, b in enumerate(bounds_us)}
    rows, differ = _both_sides(marked, width_us, {k: ~c for k, c in late.items()})
    each = [F.struct(F.lit(b).alias("bound_us"), differ("t", f"g{k}").alias("wrong"), (F.col("n_t") - F.col(f"n_g{k}")).alias("late")) for k, b in enumerate(bounds_us)]
    rows = rows.select("n_t", "moved", differ("t", "v").alias("off"), F.explode(F.array(*each)).alias("x"))
    return rows.groupBy("x.bound_us").agg(
        F.sum("n_t").alias("events"), F.sum("moved").alias("misattributed"), F.count_if("off").alias("naive_wrong"), F.count(F.lit(1)).alias("naive_windows"),
        F.count_if(F.col("n_t") > 0).alias("total"), F.count_if("x.wrong").alias("wrong"), F.sum("x.late").alias("late"),
    )


def lines(windows: DataFrame) -> DataFrame:
    """window_us, cell and line, a window's canonical text; no session setting has a say in it."""
    line = F.concat_ws("|", iso_utc(F.col("window_us")), "cell", F.col("n").cast("string"), F.format_string("%.4f", "avg_altitude"), F.format_string("%.4f", "avg_velocity"))
    return windows.select("window_us", "cell", line.alias("line"))


def _joined(c: Column) -> Column:
    return F.array_join(F.transform(F.sort_array(F.collect_list(c)), lambda x: x["line"]), "\n")


def digest(windows: DataFrame) -> DataFrame:
    """One row: SHA-256 of all windows' lines in order of window and cell, joined by newlines, and how many there are.

    Such a hash is sequential, so its text meets in one task: it is for replays whose windows (not events) fit there, which
    have to agree with digests recorded elsewhere. tree_digest() is for any number of windows.
    """
    per_window = lines(windows).groupBy("window_us").agg(_joined(F.struct("cell", "line")).alias("line"), F.count(F.lit(1)).alias("n"))
    return per_window.agg(F.sha2(_joined(F.struct("window_us", "line")), 256).alias("digest"), F.coalesce(F.sum("n"), F.lit(0)).alias("windows"))


def tree_digest(windows: DataFrame) -> DataFrame:
    """One row: SHA-256 of the hashes of each window's lines in order, and how many lines there are. No task holds more than a
    window's lines or a hash a window."""
    per_window = lines(windows).groupBy("window_us").agg(F.sha2(_joined(F.struct("cell", "line")), 256).alias("line"), F.count(F.lit(1)).alias("n"))
    return per_window.agg(F.sha2(_joined(F.struct("window_us", "line")), 256).alias("digest"), F.coalesce(F.sum("n"), F.lit(0)).alias("windows"))


def safe_offsets(log: DataFrame, open_windows: Column) -> DataFrame:
    """Per partition the offset from which a restart loses nothing: that of the first event of a window still open, or
    the next one to come."""
    first_open = F.min(F.when(open_windows, F.col("offset")))
    return log.groupBy("partition").agg(F.least(F.max("offset") + 1, first_open).alias("safe"))
