"""Packing token sequences by vector bin packing.

An item has three demands: tokens, segments (one each) and loss-bearing tokens. A bin has a limit on each, or none. The next item
of the open bin is the one, among those that fit, whose demands have the largest dot product with what the bin has left,
both in shares of the limits and weighted by the mean demand of the items. Where cutting is allowed, a bin that nothing
fits any more is filled by cutting the largest item.

Packing runs inside each input partition, in groups of bounded size; what cannot fill a bin is carried into the next
group, so no rows are shuffled and padding is one bin a partition at most. With cutting, that last bin is dealt into
sequences whose lengths are powers of two.

Cases: a null or empty text is a single end token; equal rows are packed each for itself; a text of any length is cut
into full bins and a rest; an empty table gives an empty result; other columns are ignored. Documents count each token as
loss-bearing; in conversations only the tokens of answers are, and an example longer than a sequence is cut.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

END_ID = 1
#: Texts that go through the tokenizer at once.
TOGETHER = 128
#: Fixed value: how byte-level tokenizers of this kind split a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int | None = None  # pieces a sequence, without a bound where None
    loss: int = 2048


@dataclass
class Bin:
    tokens: int = 0
    segments: int = 0
    loss: int = 0
    pieces: list = field(default_factory=list)  # (item, start in item, length)


class Packer:
    """Takes items (tokens, loss) and gives full bins; finish() gives the rest."""

    def __init__(self, limits: Limits = Limits(), cut: bool = True, group: int = 4096):
        self.limits, self.cut, self.group = limits, cut, group
        self.items: list = []  # [key, start, tokens, loss]

    def add(self, key, tokens: int, loss: int | None = None) -> list[Bin]:
        loss = tokens if loss is None else loss
        if not self.cut and (tokens > self.limits.tokens or loss > self.limits.loss):
            raise ValueError(f"an item of {tokens} tokens, {loss} of them with loss, is over the limits")
        self.items.append([key, 0, tokens, loss])
        return self._pack(False) if len(self.items) >= self.group else []

    def finish(self) -> list[Bin]:
        bins = self._pack(True)
        if self.cut and bins and bins[-1].tokens < self.limits.tokens:
            bins[-1:] = self._powers(bins[-1])
        return bins

    def _pack(self, last: bool) -> list[Bin]:
        items, limits = self.items, self.limits
        caps = np.array([limits.tokens, limits.segments or limits.tokens, limits.loss], np.float64)
        demand = np.array([[t, 1, lo] for _, _, t, lo in items], np.float64).reshape(-1, 3)
        weight = (demand / caps).mean(0) if len(items) else np.ones(3)
        alive = np.ones(len(items), bool)
        left_tokens, bins = float(demand[:, 0].sum()), []
        while alive.any() and (last or left_tokens >= 2 * limits.tokens):
            bin_, room = Bin(), caps.copy()
            while room[0] >= 1 and room[1] >= 1:
                fits = alive & (demand <= room).all(1)
                if fits.any():
                    score = np.where(fits, demand @ (weight * room / caps**2), -1.0)
                    at, take = int(score.argmax()), None
                elif self.cut and alive.any() and room[2] >= 1:
                    at = int(np.where(alive, demand[:, 0], -1.0).argmax())
                    take = int(min(room[0], room[2] + demand[at, 0] - demand[at, 2]))
                else:
                    break
                key, start, tokens, loss = items[at]
                if take is None or take >= tokens:
                    take, alive[at] = tokens, False
                    lost = loss
                else:
                    lost = max(0, take - (tokens - loss))  # an item's silent tokens come first
                    items[at] = [key, start + take, tokens - take, loss - lost]
                    demand[at] = [tokens - take, 1, loss - lost]
                bin_.pieces.append((key, start, take))
                bin_.tokens, bin_.segments, bin_.loss = bin_.tokens + take, bin_.segments + 1, bin_.loss + lost
                room -= [take, 1, lost]
                left_tokens -= take
            bins.append(bin_)
        self.items = [x for x, keep in zip(items, alive, strict=True) if keep]
        return bins

    def _powers(self, bin_: Bin) -> list[Bin]:
        out, pieces = [], list(bin_.pieces)
        for bit in reversed(range(bin_.tokens.bit_length())):
            if bin_.tokens >> bit & 1:
                now = Bin()
                while now.tokens < 1 << bit:
                    key, start, length = pieces.pop(0)
                    take = min(length, (1 << bit) - now.tokens)
                    now.pieces.append((key, start, take))
                    now.tokens, now.segments = now.tokens + take, now.segments + 1
                    if take < length:
                        pieces.insert(0, (key, start + take, length - take))
                out.append(now)
        return out


class Encoder:
    """Token ids of texts, as little-endian unsigned 32-bit bytes, by a public byte-level BPE tokenizer.

    The tokenizer splits a text before it merges bytes, and always before a single space between other characters. So
    a text is cut there and each part's ids are looked up here; only parts not seen lately go through the tokenizer,
    those of many texts at once. A text with a space beside other white space, or at its ends, is given to it whole.

    Parts of printable characters up to Latin Extended go through a second implementation of the same merges, built
    from the same file, which is quicker on short strings; it is used only if the file's merges are in order of id, and if
    both give equal ids for PROBES tokens of the vocabulary, spread over it, alone and in pairs.
    """

    MOST = 200_000
    PROBES = 2_000
    BYTES = {**{b: chr(b) for r in ((33, 126), (161, 172), (174, 255)) for b in range(r[0], r[1] + 1)}}
    BYTES |= {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(BYTES)))}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.quick = self._second(path)
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}  # by part without the space before it

    def _second(self, path: str):
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        vocab, merges = said["model"]["vocab"], said["model"].get("merges", [])
        pairs = ["".join(m.split(" ", 1) if isinstance(m, str) else m) for m in merges]
        if said["normalizer"] or said["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} or [vocab.get(x) for x in pairs] != list(range(256, 256 + len(pairs))):
            return None
        back = {c: b for b, c in self.BYTES.items()}
        special = {x["content"] for x in said["added_tokens"]}
        ranks = {bytes(back[c] for c in token): k for token, k in vocab.items() if token not in special}
        second = tiktoken.Encoding("same", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        tokens = sorted(ranks, key=ranks.get)[:: max(1, len(ranks) // self.PROBES)]
        probes = [x.decode(errors="ignore") for x in tokens]
        probes += [x + y for x, y in zip(probes, reversed(probes), strict=True)]
        if self._ids(probes) != [array("I", second.encode_ordinary(x)).tobytes() for x in probes]:
            return None
        return second, special

    def _new(self, parts: list[str]) -> list[bytes]:
        """Ids of parts of texts."""
        out: list[bytes | None] = [None] * len(parts)
        if self.quick is not None:
            encode, special = self.quick[0].encode_ordinary, self.quick[1]
            for k, part in enumerate(parts):
                if (part.isascii() or max(part) < "\u0250") and part.replace("\n", "").isprintable() and not any(x in part for x in special):
                    out[k] = array("I", encode(part)).tobytes()
        rest = [k for k, x in enumerate(out) if x is None]
        for k, ids in zip(rest, self._ids([parts[k] for k in rest]) if rest else (), strict=True):
            out[k] = ids
        return out

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array("I", x.ids).tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.first) + len(self.later) > self.MOST:
            self.first.clear()
            self.later.clear()
        first, later, whole, new, cut = self.first, self.later, {}, {}, []
        for at, text in enumerate(texts):
            parts = text.split(" ")
            got = [first.get(parts[0]), *map(later.get, parts[1:])]
            holes = [k for k, x in enumerate(got) if x is None] if None in got else []
            if "" in parts or any(parts[k][0].isspace() or parts[k][-1].isspace() for k in holes):
                whole[at] = text
            else:
                for k in holes:
                    new[k > 0, parts[k]] = None
            cut.append((parts, got, holes))
        if new:
            for (spaced, part), ids in zip(new, self._new([" " * spaced + part for spaced, part in new]), strict=True):
                (later if spaced else first)[part] = ids
        whole = dict(zip(whole, self._ids(list(whole.values())), strict=True)) if whole else whole
        out = []
        for at, (parts, got, holes) in enumerate(cut):
            if at in whole:
                out.append(whole[at])
                continue
            for k in holes:
                got[k] = (later if k else first)[parts[k]]
            out.append(b"".join(got))
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


PIECES = T.StructType(
    [T.StructField("doc_id", T.LongType())]
    + [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
)


def _pack(rows: DataFrame, tokenizer: str, limits: Limits, end_id: int, schema: T.StructType, names: int) -> DataFrame:
    """Pieces of rows of `names` naming columns, then the text that is read, and the text that loss counts on (null: on all
    of the text that is read, and there is no other). schema: of the result."""
    arrow = pa.schema([(f.name, pa.int64()) for f in schema.fields])
    loss_column = "loss" in schema.names

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(tokenizer).encode, Packer(limits)
        end, partition = end_id.to_bytes(4, "little"), TaskContext.get().partitionId() << 32
        out, sequences = [], 0

        def place(bins: list[Bin]) -> None:
            nonlocal sequences
            for b in bins:
                offset = 0
                for (name, ids, base, total, silent), start, length in b.pieces:
                    said = (max(0, base + start + length - max(silent, base + start)),) if loss_column else ()
                    out.append((*name, base + start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), total, partition + sequences, offset, *said))
                    offset += length
                sequences += 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [[]] * len(arrow)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=arrow)

        def encoded(batch: pa.RecordBatch) -> Iterator[tuple[tuple, bytes, int]]:
            """Name, ids, and how many of them come before those with loss."""
            for at in range(0, batch.num_rows, TOGETHER):
                some = batch.slice(at, TOGETHER)
                columns = [c.to_pylist() for c in some.columns]
                texts = [encode([x or "" for x in c]) for c in columns[names:]]
                for k, name in enumerate(zip(*columns[:names], strict=True)):
                    read, answer = texts[0][k], texts[1][k] if len(texts) > 1 else b""
                    yield name, read + answer + end, len(read) // 4 if len(texts) > 1 else 0

        full = min(limits.tokens, limits.loss)
        for batch in batches:
            for name, ids, silent in encoded(batch):
                total = len(ids) // 4
                whole = total - total % full if total > limits.tokens or not silent else 0
                for s in range(0, whole, full):
                    place([Bin(pieces=[((name, ids, 0, total, silent), s, full)])])
                if whole < total:
                    place(packer.add((name, ids[4 * whole :], whole, total, silent), total - whole, total - max(whole, silent)))
                if len(out) >= 20_000:
                    yield flush()
        place(packer.finish())
        yield flush()

    return rows.mapInArrow(run, schema)


def pack_documents(documents: DataFrame, tokenizer: str, limits: Limits = Limits(), end_id: int = END_ID) -> DataFrame:
    """One row a piece: doc_id, start and length in the document's ids, ids_crc32, doc_tokens, and its place."""
    return _pack(documents.select("doc_id", "text"), tokenizer, limits, end_id, PIECES, 1)


#: Of packed instruction data: loss-bearing tokens a sequence may hold, and examples.
INSTRUCTION = Limits(tokens=2048, segments=64, loss=1024)
EXAMPLES = T.StructType([T.StructField(c, T.LongType()) for c in ("conv_id", "turn", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss")])


def examples(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, prompt, answer: each turn of the assistant with the turn in front of it, if there is one. Joined by
    turn, so the turns of a long conversation do not meet in one task."""
    answers = conversations.filter("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("answer"))
    before = conversations.groupBy("conv_id", (F.col("turn") + 1).alias("turn")).agg(F.min("text").alias("prompt"))
    return answers.join(before, ["conv_id", "turn"], "left").select("conv_id", "turn", "prompt", "answer")


def pack_conversations(conversations: DataFrame, tokenizer: str, limits: Limits = INSTRUCTION, end_id: int = END_ID) -> DataFrame:
    """One row a piece of an example: conv_id, turn, start and length in its ids, ids_crc32, doc_tokens, its place, and loss:
    how many of its tokens count for loss, which are those of the answer and the end."""
    return _pack(examples(conversations), tokenizer, limits, end_id, EXAMPLES, 2)
