"""Lag control: trend statistics as window aggregates, and the decisions as a fold over each run."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ControllerConfig:
    """Fixed values are the reference's defaults."""

    window_samples: int = 6
    min_workers: int = 1
    max_workers: int = 4
    growth_per_s: float = 5.0
    drain_per_s: float = -5.0
    significance: float = 4.6
    confirm: int = 2
    lag_floor: int = 200
    quiet_below: int = 100
    shed_after: int = 3
    unshed_after: int = 3
    cooldown_s: float = 10.0
    least_samples: int = 3


def trend(samples: DataFrame, by: str = "run", config: ControllerConfig = ControllerConfig()) -> DataFrame:
    """samples (by, at, lag) with slope and t_stat over the last samples, at which they are null below least_samples.

    The statistic is |slope| over its standard error: infinite on an exact fit, 0 without spread in time.
    """
    w = Window.partitionBy(by).orderBy("at").rowsBetween(1 - config.window_samples, 0)
    s = samples.withColumn("k", F.count(F.lit(1)).over(w)).withColumn("t0", F.first("at").over(w)).withColumn("points", F.collect_list(F.struct("at", "lag")).over(w))
    x = F.transform("points", lambda p: p["at"] - F.col("t0"))
    y = F.transform("points", lambda p: p["lag"].cast("double"))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda m, v: m + v)
    s = s.withColumns({"x": x, "y": y}).withColumns({"mx": total(F.col("x")) / F.col("k"), "my": total(F.col("y")) / F.col("k")})
    s = s.withColumn("sxx", total(F.transform("x", lambda v: (v - F.col("mx")) * (v - F.col("mx")))))
    s = s.withColumn("sxy", total(F.zip_with("x", "y", lambda a, b: (a - F.col("mx")) * (b - F.col("my")))))
    s = s.withColumn("slope", F.when(F.col("sxx") > 0, F.col("sxy") / F.col("sxx")).otherwise(0.0))
    residual = F.zip_with("x", "y", lambda a, b: F.pow(b - F.col("my") - F.col("slope") * (a - F.col("mx")), F.lit(2.0)))
    s = s.withColumn("sse", total(residual))
    t = F.when(F.col("k") < config.least_samples, None).when(F.col("sxx") <= 0, 0.0)
    t = t.when(F.col("sse") <= 0, F.when(F.col("slope") == 0, 0.0).otherwise(float("inf"))).otherwise(F.abs(F.col("slope")) / F.sqrt(F.col("sse") / (F.col("k") - 2) / F.col("sxx")))
    s = s.withColumn("t_stat", t)
    return s.select(*samples.columns, F.when(F.col("k") >= config.least_samples, F.col("slope")).alias("slope"), "t_stat")


def flags(trended: DataFrame, config: ControllerConfig = ControllerConfig()) -> DataFrame:
    """trended with growing, quiet and draining."""
    sure = F.coalesce(F.col("t_stat") >= config.significance, F.lit(False))
    growing = sure & (F.col("slope") > config.growth_per_s) & (F.col("lag") >= config.lag_floor)
    quiet = F.col("lag") < config.quiet_below
    return trended.withColumns({"growing": growing, "quiet": quiet}).withColumn("draining", (sure & (F.col("slope") < config.drain_per_s)) | (F.col("quiet") & ~F.col("growing")))


class Controller:
    """Decides on one sample at a time. Counters of consecutive samples run on through cooldown and are not reset by an
    action; shedding and its end do not wait for cooldown."""

    def __init__(self, config: ControllerConfig = ControllerConfig(), workers: int | None = None):
        self.config, self.workers = config, workers or config.min_workers
        self.shedding, self.acted_at = False, None
        self.growth = self.drain = self.stuck = self.seen = 0

    def observe(self, at: float, growing: bool, quiet: bool, draining: bool) -> str:
        c = self.config
        self.seen += 1
        if self.seen < c.least_samples:
            return "hold"
        self.growth = self.growth + 1 if growing else 0
        self.drain = self.drain + 1 if draining else 0
        self.stuck = self.stuck + 1 if growing and self.workers >= c.max_workers else 0
        action = self._choose(at, growing, quiet)
        if action != "hold":
            self.acted_at = at
        self.workers += {"scale_up": 1, "scale_down": -1}.get(action, 0)
        self.shedding = {"shed": True, "unshed": False}.get(action, self.shedding)
        return action

    def _choose(self, at: float, growing: bool, quiet: bool) -> str:
        c = self.config
        if self.stuck >= c.shed_after and not self.shedding:
            return "shed"
        if self.shedding and self.drain >= c.unshed_after:
            return "unshed"
        if self.acted_at is not None and at - self.acted_at < c.cooldown_s:
            return "hold"
        if self.growth >= c.confirm and self.workers < c.max_workers:
            return "scale_up"
        if self.drain >= c.confirm and quiet and not growing and not self.shedding and self.workers > c.min_workers:
            return "scale_down"
        return "hold"


def decide(samples: DataFrame, config: ControllerConfig = ControllerConfig()) -> DataFrame:
    """run, at, lag, slope, t_stat, action, workers, shedding. What is a function of the last samples is computed as
    columns; only the fold over decisions is sequential, a run of the controller at a time."""

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        rows, controller, out = rows.sort_values("at"), Controller(config), []
        for r in rows.itertuples():
            action = controller.observe(r.at, bool(r.growing), bool(r.quiet), bool(r.draining))
            out.append((action, controller.workers, controller.shedding))
        rows["action"], rows["workers"], rows["shedding"] = (list(x) for x in zip(*out, strict=True))
        return rows[["run", "at", "lag", "slope", "t_stat", "action", "workers", "shedding"]]

    ready = flags(trend(samples, "run", config), config).select("run", "at", "lag", "slope", "t_stat", "growing", "quiet", "draining")
    return ready.groupBy("run").applyInPandas(fold, "run long, at double, lag long, slope double, t_stat double, action string, workers long, shedding boolean")


def token_bucket(requests: DataFrame, rate: float, burst: float) -> DataFrame:
    """requests (client, at, seq) with allowed: a bucket for each client that refills with time and starts full."""

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        rows, tokens, last, out = rows.sort_values(["at", "seq"]), burst, None, []
        for at in rows["at"]:
            if last is not None and at > last:
                tokens = min(burst, tokens + (at - last) * rate)
            last = at if last is None else max(last, at)
            out.append(tokens >= 1 - 1e-9)
            tokens -= out[-1]
        rows["allowed"] = out
        return rows[["client", "at", "seq", "allowed"]]

    return requests.groupBy("client").applyInPandas(fold, "client long, at double, seq long, allowed boolean")


def stabilised(samples: DataFrame, threshold: int, hold: int = 3, by: str = "run") -> DataFrame:
    """Per run the time of the first of `hold` samples in a row at or below the threshold (null: never)."""
    ahead = Window.partitionBy(by).orderBy("at").rowsBetween(0, hold - 1)
    calm = (F.count_if(F.col("lag") <= threshold).over(ahead) == hold)
    return samples.withColumn("calm", calm).groupBy(by).agg(F.min(F.when(F.col("calm"), F.col("at"))).alias("stable_at"))


def time_to_stabilise(samples: DataFrame, threshold: int, from_index: int, interval_s: float, hold: int = 3, by: str = "run") -> DataFrame:
    """Per run the seconds from the sample at from_index until lag stays at or below the threshold for `hold` samples in a row
    (null: never)."""
    order = Window.partitionBy(by).orderBy("at")
    calm = F.count_if(F.col("lag") <= threshold).over(order.rowsBetween(0, hold - 1)) == hold
    rows = samples.withColumn("i", F.row_number().over(order) - 1).withColumn("calm", calm)
    return rows.groupBy(by).agg(((F.min(F.when(F.col("calm") & (F.col("i") >= from_index), F.col("i"))) - from_index) * F.lit(interval_s)).alias("seconds"))


def actions_before(decisions: DataFrame, index: int, by: str = "run") -> DataFrame:
    """Per run how many of its first `index` decisions did something: at a steady load each of them is a false alarm."""
    rows = decisions.withColumn("i", F.row_number().over(Window.partitionBy(by).orderBy("at")))
    return rows.groupBy(by).agg(F.count_if((F.col("action") != "hold") & (F.col("i") <= index)).alias("actions"))


def analyse(samples: DataFrame, threshold: int, from_index: int, interval_s: float, by: str = "run") -> DataFrame:
    """Per run (an arm) what it is judged on. samples: run, at, lag, published (events in the interval), and shed, if any were.
    What was published and neither shed nor drained by the end is the final lag."""
    shed = F.sum("shed") if "shed" in samples.columns else F.lit(0)
    one = samples.groupBy(by).agg(F.max("lag").alias("peak_lag"), F.max_by("lag", "at").alias("final_lag"), F.sum("published").alias("published"), shed.alias("shed"))
    one = one.withColumn("undrained", F.col("final_lag")).withColumn("stored", F.col("published") - F.col("shed") - F.col("undrained"))
    one = one.withColumn("absorbed_pct", F.round(F.col("stored") * 100.0 / F.col("published"), 4))
    steady = time_to_stabilise(samples, threshold, from_index, interval_s, by=by).withColumnRenamed("seconds", "stabilise_s")
    return one.join(steady, by).select(by, "peak_lag", "final_lag", "published", "stored", "undrained", "absorbed_pct", "stabilise_s")


@dataclass(frozen=True)
class Load:
    """Offered load in phases of (seconds, events a second), a worker's capacity, and the interval of samples."""

    phases: tuple[tuple[float, float], ...] = ((30.0, 120.0), (70.0, 720.0), (40.0, 120.0), (60.0, 0.0))
    per_worker: float = 250.0
    interval_s: float = 2.0
    shed_fraction: float = 0.25


def simulate(load: Load = Load(), config: ControllerConfig = ControllerConfig(cooldown_s=6.0), adaptive: bool = True) -> list[dict]:
    """One arm under load, a row a sample: workers drain up to their capacity of what was not shed; the controller sees each
    sample's lag, or, in the static arm, is only told of it. The supervised loop of a live pipeline in miniature."""
    controller, lag, at, points, rows = Controller(config), 0.0, 0.0, [], []
    for seconds, rate in load.phases:
        for _ in range(round(seconds / load.interval_s)):
            at += load.interval_s
            published = rate * load.interval_s
            shed = published * load.shed_fraction if controller.shedding and adaptive else 0.0
            workers = controller.workers if adaptive else config.min_workers
            lag = max(0.0, lag + published - shed - workers * load.per_worker * load.interval_s)
            points = [*points, (at, lag)][-config.window_samples :]
            slope, t = _fit(points)
            sure = len(points) >= config.least_samples and t >= config.significance
            growing = sure and slope > config.growth_per_s and lag >= config.lag_floor
            quiet = lag < config.quiet_below
            draining = (sure and slope < config.drain_per_s) or (quiet and not growing)
            action = controller.observe(at, growing, quiet, draining) if adaptive else "hold"
            rows.append({"at": at, "lag": round(lag), "published": round(published), "shed": round(shed), "action": action, "workers": controller.workers if adaptive else workers})
    return rows


def _fit(points: list[tuple[float, float]]) -> tuple[float, float]:
    """Slope of a line through the points and its t statistic, as in trend()."""
    k = len(points)
    mx, my = sum(x for x, _ in points) / k, sum(y for _, y in points) / k
    sxx, sxy = sum((x - mx) ** 2 for x, _ in points), sum((x - mx) * (y - my) for x, y in points)
    if k < 3 or sxx <= 0:
        return 0.0, 0.0
    slope = sxy / sxx
    sse = sum((y - my - slope * (x - mx)) ** 2 for x, y in points)
    if sse <= 0:
        return slope, 0.0 if slope == 0 else float("inf")
    return slope, abs(slope) / (sse / (k - 2) / sxx) ** 0.5
