"""Exact top-k inner products of a query set against all vectors.

Rows are packed into pieces where they lie, and pieces into groups of bounded size. A task takes one group of queries and
one of candidates and goes through them a tile at a time: a matrix product of a block of queries and a shard of
candidates, and by partial selection those that can still be among a query's k best. Tasks' lists are merged in a tree of
bounded fan-in. So a vector travels once for each group of the other side, not once for each shard, and neither side is
broadcast. Components are floor(scale * x), so scores are integers, and a product is taken in the narrowest numbers
that hold all its sums exactly: 32-bit floats, 64-bit floats, or integers without a bound; a score beyond 64 bits is held
at the largest.

Cases: a row whose vec_id or vector is null, or whose vector holds a null or non-finite component, takes no part;
vectors are scored against those of equal length only; a row is never a candidate of a query with its own vec_id;
repeated query rows each get their list; ties go to the smaller vec_id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrow_text import loosened, squeezed
from .common import materialise, small, spread


@dataclass(frozen=True)
class TopKConfig:
    """shard_rows, block_rows: sides of a tile. piece_cells: components of a piece, one row at least. group_bytes: of a
    group, and a piece more at most; groups are smaller where cores would have nothing to do, down to least_bytes."""

    k: int = 5
    scale: float = 256.0
    shard_rows: int = 8192
    block_rows: int = 2048
    fan_in: int = 16
    piece_cells: int = 1 << 20
    group_bytes: int = 32 << 20
    least_bytes: int = 1 << 20


PIECES = "is_query boolean, dim long, piece long, bytes long, kind string, ids binary, matrix binary"
LISTS = "block long, query long, part long, query_id long, vec_id long, score long"
LOWEST = -(2**63) + 1
#: Of a tile's row, so many candidates above the floor, times k, are cut to k before they are merged.
MANY = 8
#: Numbers of a tile that are worked on at once where it takes several arrays of its size.
CELLS = 1 << 20


def usable(vectors: DataFrame) -> DataFrame:
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.size("embedding").cast("long").alias("dim")
    )


def _narrow(matrix: np.ndarray) -> np.ndarray:
    for kind in ("i1", "i2", "i4"):
        low, high = np.iinfo(kind).min, np.iinfo(kind).max
        if matrix.min(initial=0) >= low and matrix.max(initial=0) <= high:
            return matrix.astype(kind)
    return matrix


def _packer(config: TopKConfig):
    """Pieces of one length of vectors, candidates all and queries besides: ids, and floored components row by row."""

    def piece(is_query: bool, dim: int, number: int, ids: np.ndarray, matrix: np.ndarray) -> pa.RecordBatch:
        matrix = _narrow(matrix)
        row = {"is_query": is_query, "dim": dim, "piece": (TaskContext.get().partitionId() << 32) + number, "bytes": ids.nbytes + matrix.nbytes, "kind": matrix.dtype.str, "ids": squeezed(ids), "matrix": squeezed(matrix.reshape(-1))}
        kinds = (pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row.values(), kinds, strict=True)], names=list(row))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[bool, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        rows: dict[tuple[bool, int], int] = {}
        cells = number = 0

        def full(key: tuple[bool, int]) -> pa.RecordBatch:
            nonlocal cells, number
            ids, parts = zip(*held.pop(key), strict=True)
            cells, number = cells - rows.pop(key) * max(1, key[1]), number + 1
            return piece(*key, number, np.concatenate(ids), np.concatenate(parts))

        for batch in batches:
            ids, dims, asked = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("vec_id", "dim", "is_query"))
            vectors = batch.column("embedding")
            for dim in np.unique(dims).tolist():
                of = np.flatnonzero(dims == dim)
                most = max(1, min(config.shard_rows, config.piece_cells // max(1, dim)))
                for at in range(0, len(of), most):
                    some = of[at : at + most]
                    flat = vectors.take(pa.array(some)).flatten().to_numpy(zero_copy_only=False)
                    matrix = np.floor(config.scale * flat.reshape(len(some), dim))
                    for key, which in (((False, dim), slice(None)), ((True, dim), asked[some])):
                        n = len(ids[some][which])
                        if not n:
                            continue
                        if rows.get(key, 0) + n > most:
                            yield full(key)
                        held.setdefault(key, []).append((ids[some][which], matrix[which]))
                        rows[key] = rows.get(key, 0) + n
                        cells += n * max(1, dim)
                        while cells > 2 * config.piece_cells:  # vectors of many lengths
                            yield full(max(rows, key=lambda x: rows[x] * max(1, x[1])))
        for key in list(held):
            yield full(key)

    return run


def _product(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Scores of a tile. No sum of products, in whatever order, passes the product of the two rows' norms."""
    with np.errstate(over="ignore", invalid="ignore"):
        wide = queries.astype(np.float64), shard.astype(np.float64)
        norm = [float(np.sqrt((a * a).sum(1).max(initial=0.0))) * (1 + 1e-6) for a in wide]
        most = max(norm[0] * norm[1], *norm)
    if most < 2**24:
        return wide[0].astype(np.float32) @ wide[1].astype(np.float32).T
    if most < 2**53:
        return wide[0] @ wide[1].T
    exact = lambda a: np.array([[int(x) for x in row] for row in a], object).reshape(a.shape)
    score, right, step = np.zeros((len(queries), len(shard)), np.int64), exact(wide[1]).T, max(1, CELLS // max(1, len(shard)))
    for r in range(0, len(queries), step):
        score[r : r + step] = np.clip(exact(wide[0][r : r + step]).dot(right), LOWEST + 1, 2**63 - 1).astype(np.int64)
    return score


def best(queries: np.ndarray, own: np.ndarray, shard: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one tile: query rows, candidate rows and scores of what can be among each query's k best, which have to lie
    above its floor; ids ascend."""
    score = _product(queries, shard)
    lowest = LOWEST if score.dtype == np.int64 else -np.inf
    first, last = np.searchsorted(ids, own, "left"), np.searchsorted(ids, own, "right")
    for r in np.flatnonzero(first < last).tolist():
        score[r, first[r] : last[r]] = lowest
    bound = np.where(floor == LOWEST, lowest, floor.astype(score.dtype))
    take = score > bound[:, None]
    many = np.flatnonzero(np.count_nonzero(take, 1) > MANY * k)
    step = max(1, CELLS // max(1, len(ids)))
    for r in range(0, len(many), step):
        # the k-th score of each query, then every candidate above it and, of those that tie, the first by id
        some = score[many[r : r + step]]
        kth = np.partition(some, some.shape[1] - k, axis=1)[:, some.shape[1] - k]
        above, tied = some > kth[:, None], some == kth[:, None]
        take[many[r : r + step]] &= above | (tied & (np.cumsum(tied, 1) <= (k - above.sum(1))[:, None]))
    q, c = np.divmod(np.flatnonzero(take), max(1, len(ids)))
    return q, c, score[q, c].astype(np.int64)


def _whole(pieces: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a group: ids in order, the matrix in the numbers that hold all its pieces, and each row's piece and place there."""
    dim = pieces.column("dim")[0].as_py()
    got = sorted(zip(*(pieces.column(c).to_pylist() for c in ("piece", "kind", "ids", "matrix")), strict=True))
    ids = [loosened(x, np.int64) for _, _, x, _ in got]
    matrix = np.concatenate([loosened(m, kind).reshape(len(i), dim) for i, (_, kind, _, m) in zip(ids, got, strict=True)])
    block = np.repeat([p for p, *_ in got], [len(i) for i in ids])
    query = np.concatenate([np.arange(len(i)) for i in ids])
    order = np.argsort(np.concatenate(ids), kind="stable")
    return np.concatenate(ids)[order], matrix[order], block[order], query[order]


def _tiles(config: TopKConfig):
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            own, queries, block, query = _whole(left)
            ids, matrix, _, _ = _whole(right)
            for b in range(0, len(own), config.block_rows):
                rows = slice(b, b + config.block_rows)
                n = len(own[rows])
                q, c, score, floor = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.full(n, LOWEST)
                # ids ascend from shard to shard, so what ties with a full list's last comes too late
                for s in range(0, len(ids), config.shard_rows):
                    shard = slice(s, s + config.shard_rows)
                    more = best(queries[rows], own[rows], matrix[shard], ids[shard], config.k, floor)
                    if not len(more[0]):
                        continue
                    q, c, score = (np.concatenate(x) for x in ((q, more[0]), (c, more[1] + s), (score, more[2])))
                    order = np.lexsort((c, -score, q))
                    q, c, score = q[order], c[order], score[order]
                    rank = np.arange(len(q)) - np.searchsorted(q, q, "left")
                    floor[q[rank == config.k - 1]] = score[rank == config.k - 1]
                    q, c, score = q[rank < config.k], c[rank < config.k], score[rank < config.k]
                found.append((block[rows][q], query[rows][q], own[rows][q], ids[c], score))
        columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 5
        part = np.full(len(columns[0]), key[2].as_py())
        return pa.table(dict(zip(("block", "query", "part", "query_id", "vec_id", "score"), (*columns[:2], part, *columns[2:]), strict=True)))

    return run


def _grouped(pieces: DataFrame, config: TopKConfig) -> tuple[DataFrame, int, int]:
    """Of each piece that has a counterpart its group, and how many the other side has; the pieces; and the most groups of candidates.
    A row a piece is read for it, none of the vectors."""
    sizes = pieces.select("is_query", "dim", "piece", "bytes")
    n, total = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.when(~F.col("is_query"), F.col("bytes"))), F.lit(0))).first()
    cores = pieces.sparkSession.sparkContext.defaultParallelism
    bound = min(config.group_bytes, max(config.least_bytes, total // (4 * cores)))
    before = F.sum("bytes").over(Window.partitionBy("is_query", "dim").orderBy("piece")) - F.col("bytes")
    groups = materialise(sizes.select("is_query", "dim", "piece", F.floor(before / F.lit(bound)).alias("part")), "topk-groups")
    reach = groups.groupBy("dim").agg(*[F.max(F.when(F.col("is_query") == q, F.col("part") + 1)).alias(c) for q, c in ((True, "asked"), (False, "parts"))])
    widest = reach.agg(F.coalesce(F.max("parts"), F.lit(1))).first()[0]
    other = F.when(F.col("is_query"), F.col("parts")).otherwise(F.col("asked"))
    return groups.join(small(reach, n), "dim").filter("asked > 0").select("piece", "part", other.alias("other")), n, widest


def top_k(vectors: DataFrame, is_query: Column, config: TopKConfig = TopKConfig()) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of each row for which is_query holds."""
    rows = usable(spread(vectors.select("vec_id", "embedding"))).withColumn("is_query", F.coalesce(is_query, F.lit(False)))
    pieces = materialise(rows.mapInArrow(_packer(config), PIECES), "topk-pieces")
    groups, n, shards = _grouped(pieces, config)
    pieces = pieces.join(small(groups, n), "piece")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("other") - 1))
    held, keys = ["dim", "piece", "kind", "ids", "matrix"], ["dim", "asked", "part"]
    queries = pieces.filter("is_query").select(*held, F.col("part").alias("asked"), every.alias("part"))
    candidates = pieces.filter("not is_query").select(*held, every.alias("asked"), "part")
    queries, candidates = (x.toDF(*x.columns).groupBy(*keys) for x in (queries, candidates))  # columns of their own
    lists = queries.cogroup(candidates).applyInArrow(_tiles(config), LISTS)
    while True:
        lists = lists.withColumn("part", F.floor(F.col("part") / config.fan_in))
        lists = lists.groupBy("block", "query", "query_id", "part").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))), 1, config.k).alias("top"))
        shards = -(-shards // config.fan_in)
        if shards == 1:
            break
        lists = lists.withColumn("x", F.explode("top")).select("block", "query", "part", "query_id", "x.vec_id", (-F.col("x.minus")).alias("score"))
    return lists.select("query_id", F.posexplode("top").alias("at", "x")).select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "x.vec_id", (-F.col("x.minus")).alias("score"))
