"""Secret scanning: rules as deterministic automata, one pass over the bytes of each text for all of them.

Rules are compiled (see automaton) into transition arrays on the driver. The combined automaton, by subset construction
and minimisation, holds each rule's trigger: something short that every kept match of the rule holds. One pass over all
bytes marks where triggers are met; only there, between bytes that no match can hold, the rule's own anchored automaton
settles the exact spans: leftmost, longest, not overlapping within a kind, in time linear in the bytes. A match that is
too short is dropped, and what it covered stays used. All rules in full would make one automaton of some 35,000 states.

Cases: a null or empty text has no spans; offsets are code points, ends exclusive; texts of any length are scanned
whole; equal rows each get their result; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrow_text import utf8_slices
from .automaton import Dfa, compile_rules, longest_matches, scan


@dataclass(frozen=True)
class Rule:
    """min_length: of the whole match. min_tail: of the repeated run that ends it. trigger: what the combined automaton
    looks for in the rule's place: something that every kept match holds. A run without a bound stays out of it, for
    each that goes on multiplies the states of the others."""

    kind: str
    pattern: str
    min_length: int = 0
    min_tail: int = 0
    trigger: str = ""


#: Fixed values of the contract.
BASE = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", min_tail=6, trigger=r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""),
    Rule("access", r"AKIA[A-Z0-9]+", min_length=20, trigger=r"AKIA[A-Z0-9]{4}"),
    Rule("hex", r"[0-9a-f]+", min_length=24, trigger=r"[0-9a-f]{24}"),
)
#: Public formats of credentials.
EXTRA = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", min_tail=36, trigger=r"gh[pousr]_[A-Za-z0-9]{4}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", min_tail=10, trigger=r"xox[abprs]-[A-Za-z0-9-]{4}"),
    Rule("google", r"AIza[A-Za-z0-9_-]+", min_tail=35, trigger=r"AIza[A-Za-z0-9_-]{4}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", trigger=r"eyJ[A-Za-z0-9_-]"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", trigger=r"-----BEGIN [A-Z]"),
    Rule("url", r"(https?|ftp|postgres|mysql|mongodb|redis|amqp)://[^\x00-\x20/:@]+:[^\x00-\x20/@]+@", trigger=r"(https?|ftp|postgres|mysql|mongodb|redis|amqp)://[^\x00-\x20/:@]"),
)


@dataclass(frozen=True)
class Scanner:
    rules: tuple[Rule, ...]
    combined: Dfa
    each: tuple[Dfa, ...]

    def borders(self) -> np.ndarray:
        """Of each byte: whether no match of any rule can hold it. Triggers alone don't tell: a rule goes on behind its own."""
        return np.logical_and.reduce([(d.next.reshape(-1, d.n_classes) == d.dead).all(0)[d.classes] for d in self.each])

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
        """Of the texts that have any: text -> (start, end, rule) in bytes of the text, by start and then rule."""
        hits, states = scan(self.combined, data, offsets)
        if not len(hits):
            return {}
        borders = np.flatnonzero(self.borders()[data])
        text = np.searchsorted(offsets, hits, "right") - 1
        after = np.searchsorted(borders, hits)
        low = np.maximum(offsets[text], np.where(after > 0, borders[after - 1] + 1, 0) if len(borders) else 0)
        high = np.minimum(offsets[text + 1], np.where(after < len(borders), borders[np.minimum(after, len(borders) - 1)], len(data)) if len(borders) else len(data))
        todo: dict[tuple[int, int, int], int] = {}
        for t, a, b, s in zip(text.tolist(), low.tolist(), high.tolist(), states.tolist(), strict=True):
            todo[t, a, b] = todo.get((t, a, b), 0) | self.combined.accepts[s]
        found: dict[int, list[tuple[int, int, int]]] = {}
        for (t, a, b), bits in todo.items():
            segment, base = data[a:b].tobytes(), a - int(offsets[t])
            for k, rule in enumerate(self.rules):
                if bits >> k & 1:
                    kept = [(base + i, base + j, k) for i, j, first in longest_matches(self.each[k], segment) if j - i >= rule.min_length and j - first + 1 >= rule.min_tail]
                    if kept:
                        found.setdefault(t, []).extend(kept)
        return {t: sorted(x, key=lambda y: (y[0], y[2])) for t, x in found.items()}


@lru_cache
def scanner(rules: tuple[Rule, ...] = BASE + EXTRA) -> Scanner:
    return Scanner(rules, compile_rules([r.trigger or r.pattern for r in rules], True), tuple(compile_rules([r.pattern], False) for r in rules))


def code_points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans with offsets in code points."""
    marks = np.frombuffer(text, np.uint8)
    before = np.concatenate([[0], np.cumsum((marks & 0xC0) != 0x80)])
    return [(int(before[a]), int(before[b]), k) for a, b, k in spans]


FOUND = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_spans long"


def find_secrets(documents: DataFrame, rules: tuple[Rule, ...] = BASE + EXTRA) -> DataFrame:
    """doc_id, counts and digest of the base kinds, and spans: kind:start:end by start, comma-joined."""
    ready = scanner(rules)
    n_base = len(BASE)
    empty = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in utf8_slices(batch):
                found, n = ready.spans(data, offsets), end - row
                counts = np.zeros((n_base, n), np.int64)
                digest, said, total = [empty] * n, [""] * n, np.zeros(n, np.int64)
                for t, spans in found.items():
                    spans = code_points(data[offsets[t] : offsets[t + 1]].tobytes(), spans)
                    texts = [f"{rules[k].kind}:{a}:{b}" for a, b, k in spans]
                    for _, _, k in spans:
                        if k < n_base:
                            counts[k, t] += 1
                    digest[t] = hashlib.sha256(",".join(x for x, s in zip(texts, spans, strict=True) if s[2] < n_base).encode()).hexdigest()
                    said[t], total[t] = ",".join(texts), len(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, n), *map(pa.array, counts), pa.array(digest), pa.array(said), pa.array(total)],
                    names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_spans"],
                )

    return documents.select("doc_id", "text").mapInArrow(run, FOUND)


def redact(documents: DataFrame, mark: str = "[SECRET]", rules: tuple[Rule, ...] = BASE + EXTRA) -> DataFrame:
    """documents with every span of a secret replaced in text, and n_chars, if there is one, counted anew where a text
    changed; overlapping spans count as one."""
    ready, cover = scanner(rules), mark.encode()
    names = documents.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            changed: dict[int, str] = {}
            for row, _, data, offsets in utf8_slices(batch):
                for t, spans in ready.spans(data, offsets).items():
                    text, out, done = data[offsets[t] : offsets[t + 1]].tobytes(), [], 0
                    for a, b, _ in spans:
                        if a >= done:
                            out += [text[done:a], cover]
                        done = max(done, b)
                    changed[row + t] = b"".join([*out, text[done:]]).decode()
            if changed:
                columns = list(batch.columns)
                texts = columns[at].to_pylist()
                for t, x in changed.items():
                    texts[t] = x
                columns[at] = pa.array(texts, columns[at].type)
                if "n_chars" in names:
                    k = names.index("n_chars")
                    sizes = columns[k].to_pylist()
                    for t, x in changed.items():
                        sizes[t] = len(x)
                    columns[k] = pa.array(sizes, columns[k].type)
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield batch

    return documents.mapInArrow(run, documents.schema)
