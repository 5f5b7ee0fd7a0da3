"""Polling a service for positional vectors, with patience that grows on trouble and returns on success; as a batch, and as
a streaming source (`statevectors`) of bodies."""

from __future__ import annotations

import json
import logging
import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from aerolith.sources.positional import parse_states

log = logging.getLogger(__name__)


@dataclass
class Response:
    status: int
    body: str = ""
    retry_after_s: float | None = None


@dataclass
class Backoff:
    """Waits of base * 2**n up to most, each times a draw between 0.5 and 1.5; reset() after a success."""

    base_s: float = 1.0
    most_s: float = 60.0
    draw: Callable[[], float] = field(default_factory=lambda: random.Random().random)
    failures: int = 0

    def next(self, told_s: float | None = None) -> float:
        """told_s: what the service asked for, which is taken as it is up to most_s."""
        wait = min(self.most_s, self.base_s * 2**self.failures) * (0.5 + self.draw())
        self.failures += 1
        return wait if told_s is None else min(told_s, self.most_s)

    def reset(self) -> None:
        self.failures = 0


REFUSED = (401, 403)


def step(fetch: Callable[[], Response], interval_s: float, backoff: Backoff) -> tuple[str | None, float]:
    """One poll: its body, if there is one, and how long to wait. A 429 waits for what the service says, a 5xx or timeout
    backs off, and so does any other status, which is logged; being refused is an error of ours and raises."""
    try:
        got = fetch()
    except TimeoutError:
        got = Response(504)
    if got.status == 200:
        backoff.reset()
        return got.body, interval_s
    if got.status in REFUSED:
        raise ValueError(f"the service answered {got.status}")
    if got.status != 429 and got.status < 500:
        log.warning("the service answered %s", got.status)
    return None, backoff.next(got.retry_after_s if got.status == 429 else None)


def poll(fetch: Callable[[], Response], interval_s: float, backoff: Backoff, sleep: Callable[[float], None] = time.sleep, polls: int | None = None) -> Iterator[str]:
    """Bodies of successful polls."""
    done = 0
    while polls is None or done < polls:
        done += 1
        body, wait = step(fetch, interval_s, backoff)
        if body is not None:
            yield body
        sleep(wait)


def vectors(spark: SparkSession, body: str) -> DataFrame:
    """The parsed states of one poll's body, whose `states` are positional arrays; of a body that is no such object, none."""
    try:
        told = json.loads(body)
    except ValueError:
        told = None
    states = (told.get("states") if isinstance(told, dict) else None) or []
    return parse_states(spark.createDataFrame([(json.dumps(x),) for x in states], "value string"))


class VectorReader(SimpleDataSourceStreamReader):
    """A poll a micro-batch. The offset counts polls; a batch is kept by the engine until it is committed."""

    def __init__(self, options: dict):
        self.options, self.backoff = options, Backoff(base_s=float(options.get("backoff_s", 1.0)), most_s=float(options.get("most_s", 60.0)))
        self.ready_at = 0.0

    def initialOffset(self) -> dict:
        return {"poll": 0}

    def _fetch(self, n: int) -> Response:
        if folder := self.options.get("folder"):  # recorded answers: <number>.json, or <number>.<status>
            for path in sorted(Path(folder).glob(f"{n}.*")):
                return Response(200, path.read_text()) if path.suffix == ".json" else Response(int(path.suffix[1:]))
            return Response(204)
        from urllib.error import HTTPError
        from urllib.request import urlopen

        try:
            with urlopen(self.options["url"], timeout=float(self.options.get("timeout_s", 10.0))) as got:
                return Response(got.status, got.read().decode(errors="replace"))
        except HTTPError as e:
            told = e.headers.get("Retry-After")
            return Response(e.code, retry_after_s=float(told) if told and told.isdigit() else None)

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        n = start["poll"]
        if time.monotonic() < self.ready_at:
            return iter([]), start
        body, wait = step(lambda: self._fetch(n), float(self.options.get("interval_s", 10.0)), self.backoff)
        self.ready_at = time.monotonic() + wait
        return iter([] if body is None else [(n, body)]), {"poll": n + 1}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        """For replay after a failure: recorded answers are read again; what a live service said is gone."""
        for n in range(start["poll"], end["poll"]):
            got = self._fetch(n) if self.options.get("folder") else Response(204)
            if got.status == 200:
                yield (n, got.body)

    def commit(self, end: dict) -> None:
        pass


class StateVectors(DataSource):
    """spark.readStream.format("statevectors") with option url, or folder of recorded answers; interval_s, backoff_s, most_s."""

    @classmethod
    def name(cls) -> str:
        return "statevectors"

    def schema(self) -> str:
        return "poll long, body string"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return VectorReader(dict(self.options))


def stream_vectors(spark: SparkSession, **options: str) -> DataFrame:
    """The parsed states of a stream of polls."""
    spark.dataSource.register(StateVectors)
    bodies = spark.readStream.format("statevectors").options(**options).load()
    states = F.from_json("body", "states array<string>")["states"]
    return parse_states(bodies.select("poll", F.explode(states).alias("value")))


def with_retry(act: Callable[[], object], attempts: int = 5, base_s: float = 0.2, transient: tuple[type[Exception], ...] = (ConnectionError, TimeoutError), sleep: Callable[[float], None] = time.sleep, draw: Callable[[], float] = random.random):
    """act(), again after transient errors; the last one is raised, so that what was not written is not committed."""
    for n in range(1, attempts + 1):
        try:
            return act()
        except transient:
            if n == attempts:
                raise
            sleep(base_s * 2 ** (n - 1) * (0.5 + draw()))
