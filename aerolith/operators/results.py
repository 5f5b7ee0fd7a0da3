"""Results of benchmark runs as a table of measured values, and plans as text or with what their operators did."""

from __future__ import annotations

import platform
import sys
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.operators.store import summary

VALUES = "run string, name string, at timestamp, python string, machine string, metric string, value double"


def record(spark: SparkSession, path: str, name: str, values: Mapping[str, float]) -> str:
    """Adds a run's values to the table at path, a row a value, with when and where it ran; the run's id."""
    run = uuid.uuid4().hex
    rows = spark.createDataFrame([(k, float(v)) for k, v in values.items()], "metric string, value double")
    told = {"run": F.lit(run), "name": F.lit(name), "at": F.current_timestamp(), "python": F.lit(sys.version.split()[0]), "machine": F.lit(platform.machine())}
    rows.withColumns(told).select(*[x.split()[0] for x in VALUES.split(", ")]).coalesce(1).write.mode("append").json(path)
    return run


def runs(spark: SparkSession, path: str) -> DataFrame:
    """The table at path: a row a value of a run."""
    return spark.read.schema(VALUES).json(path)


def summarise(values: DataFrame) -> DataFrame:
    """Statistics of each metric of each name over its runs."""
    return summary(values, "value", ["name", "metric"])


def render(rows: DataFrame, limit: int = 20) -> str:
    """The first rows as a Markdown table."""
    out = [f"| {' | '.join(rows.columns)} |", f"|{'-|' * len(rows.columns)}"]
    return "\n".join(out + [f"| {' | '.join(map(str, r))} |" for r in rows.take(limit)])


def plan(rows: DataFrame, mode: str = "formatted") -> str:
    return rows._jdf.queryExecution().explainString(rows.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


def measured_plan(rows: DataFrame) -> list[tuple[int, str, int | None]]:
    """Runs rows and gives depth, operator and rows made of each operator of the plan that ran."""
    executed = rows._jdf.queryExecution().executedPlan()
    executed.execute().count()
    out = []

    def walk(node, depth: int) -> None:
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan(), depth)
        made = node.metrics().get("numOutputRows")
        out.append((depth, name, made.get().value() if made.isDefined() else None))
        below = [node.plan()] if name.endswith("QueryStage") else [node.children().apply(k) for k in range(node.children().size())]
        for x in below:
            walk(x, depth + 1)

    walk(executed, 0)
    return out
