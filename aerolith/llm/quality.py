"""Quality rules as a short-circuit cascade, with DataFrame operations only.

A rule says from measures of a text whether the text fails. On a bounded sample each rule's rejection rate and cost are
estimated; rules then run in order of rejection per cost, and a text that fails one is asked no further. The order changes
the cost and the rule that is named, never the verdict. A rule's cost is the CPU time of the tasks that evaluate it over
the sample, REPEATS times over, less that of a rule that reads the text's length alone, in steps of a factor of two, so that
runs agree on the order. Of the measures that a caller wants anyway only those are left to the cascade that it did not ask for.

Cases: a null text has no words; equal rows each get their result; texts are measured whole; an empty table gives an
empty result; other columns are kept by apply_rules() and may have any names but the measures'.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, WORD, materialise

WINDOW = 5


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _words(text: Column) -> Column:
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+"))


def _covered(windows: Column) -> Column:
    """Words in windows whose hash occurs more than once; windows[i] is the hash of the window from word i on."""

    def of_sorted(s: Column) -> Column:
        n = F.size(s)
        at = lambda j: F.get(s, j)["h"]
        twice = lambda x, j: ((j > 0) & (at(j - 1) == x["h"])) | ((j < n - 1) & (at(j + 1) == x["h"]))
        starts = F.array_sort(F.transform(F.filter(s, twice), lambda x: x["i"]))
        begin = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(starts, begin, lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])

    return let(F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), of_sorted)


def _repeats(words: Column) -> Column:
    def of_windows(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) < F.size(h), _covered(h)).otherwise(F.lit(0).cast("long"))

    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    return F.when(F.size(words) >= WINDOW, let(hashes, of_windows)).otherwise(F.lit(0).cast("long"))


def measures(text: Column) -> dict[str, Column]:
    """All measures as expressions on a text; what is never named is never computed."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("long")
    return {
        "n_words": count(WORD),
        "word_chars": (F.length(text) - F.regexp_count(text, F.lit(r"[\x20\x09-\x0D]"))).cast("long"),
        "n_symbols": count(r"[#*$%&|<>]"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": let(_words(text), _repeats),
        "n_marks": count("!"),
        "n_upper": count("[A-Z]"),
        "n_lower": count(r"\p{Ll}"),
    }


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Callable[[Mapping[str, Column]], Column]


#: The verdict's rules. Bounds are those of published web-text filters, or looser.
RULES = (
    Rule("symbols", lambda m: m["n_symbols"] * 10 > m["n_words"]),
    Rule("duplicate_lines", lambda m: m["n_dup_lines"] * 2 > m["n_lines"]),
    Rule("word_length", lambda m: (m["word_chars"] < m["n_words"] * 2) | (m["word_chars"] > m["n_words"] * 12)),
    Rule("exclamation", lambda m: m["n_marks"] * 2 > m["n_words"]),
    Rule("shouting", lambda m: m["n_upper"] * 3 > (m["n_upper"] + m["n_lower"]) * 2),
)


def base_failed(m: Mapping[str, Column]) -> Column:
    return (m["n_words"] < 10) | (m["n_repeat_words"] * 100 > m["n_words"] * 20)


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    rejection: float
    seconds: float


#: Times that a rule is evaluated on each text of the sample.
REPEATS = 2


def cpu_seconds(rows: DataFrame) -> tuple[float, float]:
    """The value of the only column and row, and the CPU seconds of the tasks that made it."""
    spark = rows.sparkSession
    context, group = spark.sparkContext, f"quality-{uuid.uuid4().hex}"
    before = context.getLocalProperty("spark.jobGroup.id")
    context.setJobGroup(group, "cost of a rule")
    try:
        value = rows.first()[0] or 0.0
    finally:
        context.setLocalProperty("spark.jobGroup.id", before)
    context._jsc.sc().listenerBus().waitUntilEmpty()
    tracker, store, spent = context.statusTracker(), context._jsc.sc().statusStore(), 0
    for job in tracker.getJobIdsForGroup(group):
        info = tracker.getJobInfo(job)
        for stage in info.stageIds if info else ():
            try:
                spent += store.lastStageAttempt(stage).executorCpuTime()
            except Py4JJavaError:  # a stage that was skipped
                pass
    return value, spent / 1e9


def estimate(documents: DataFrame, rules: tuple[Rule, ...] = RULES, sample_docs: int = 2000) -> list[Estimate]:
    """The rules with their figures on a sample of about sample_docs texts, best first."""
    every = max(1, documents.count() // sample_docs)
    sample = materialise(documents.filter(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).select("text"), "quality-sample")
    times = sample.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))
    # the text differs each time, lest it be measured once
    text = F.substring("text", F.lit(1), F.length("text") + F.col("again"))
    cost = lambda fails: cpu_seconds(times.agg(F.avg(F.when(fails(measures(text)), 1.0).otherwise(0.0)).alias("x")))
    idle = cost(lambda _: F.length(text) < 0)[1]
    found = [Estimate(rule, *cost(rule.fails)) for rule in rules]
    steps = lambda e: round(math.log2(max(e.seconds - idle, 1e-3)))
    return sorted(found, key=lambda e: (-e.rejection / 2.0 ** steps(e), e.rule.name))


def cascade(order: list[Estimate], m: Mapping[str, Column]) -> Column:
    """The name of the first rule that a text fails, or null; later rules are not evaluated then."""
    out = None
    for e in order:
        fails, name = e.rule.fails(m), F.lit(e.rule.name)
        out = F.when(fails, name) if out is None else out.when(fails, name)
    return F.lit(None).cast("string") if out is None else out


def apply_rules(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """documents with failed_rule (null: kept). Measures are computed inside the cascade, as far as it gets."""
    order = estimate(documents, rules)
    return documents.withColumn("failed_rule", cascade(order, measures(F.col("text"))))


def judge(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, the base measures, base_failed, kept and failed_rule ('base' where the base rules fail)."""
    order = estimate(documents, rules)
    m = measures(F.col("text"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = documents.select("doc_id", "text", *[m[c].alias(c) for c in base]).withColumn("base_failed", base_failed({c: F.col(c) for c in base}))
    failed = F.when(F.col("base_failed"), F.lit("base")).otherwise(cascade(order, m | {c: F.col(c) for c in base}))
    rows = rows.withColumn("failed_rule", failed)
    return rows.select("doc_id", *base, "base_failed", F.col("failed_rule").isNull().alias("kept"), "failed_rule")
