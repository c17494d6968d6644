"""Exact top-k inner products by MaxScore.

A component is a term and the column of its values over a shard is its posting list. A
term's bound is the most it can add to any score in the shard. The terms with the smallest
bounds that together stay below a query's k-th best score so far are non-essential: they
cannot lift a vector into the result by themselves. The essential lists are traversed for
a block of queries at once, as one matrix product; the non-essential ones are only probed
for vectors that can still compete, the largest bound first. Scores are integers and the
comparisons keep ties, so nothing is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tierflow.llm.common import arrow_batch, numbered, stored

SHARD_ROWS = 4096
QUERY_ROWS = 512
AT_ONCE = 2048
_PACKED = pa.schema([("ids", pa.binary()), ("width", pa.int32()), ("cells", pa.binary())])
_PACKED_KIND = "ids binary, width int, cells binary"


def integer_rows(column: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """(places of the usable vectors, matrix of floor(scale * x)); shorter vectors end in zeros.

    Vectors that are null or hold null or non-finite components are left out.
    """
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    sizes = np.where(valid, column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0).astype(np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    broken = np.zeros(len(sizes), bool)
    broken[row[~np.isfinite(flat)]] = True
    cells = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    nth = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    cells[row, nth] = np.floor(scale * np.where(np.isfinite(flat), flat, 0.0)).astype(np.int64)
    usable = np.flatnonzero(valid & ~broken)
    return usable, cells[usable]


def _pack(batches, scale, rows):
    """Blocks of up to ``rows`` vectors as (ids, width, cells)."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            usable, cells = integer_rows(part.column(1), scale)
            if len(usable):
                ids = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)[usable]
                yield arrow_batch(_PACKED, [ids.astype("<i8").tobytes()], [cells.shape[1]], [cells.astype("<i8").tobytes()])


def _unpack(ids: bytes, width: int, cells: bytes, to: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, "<i8")
    cells = np.frombuffer(cells, "<i8").reshape(len(ids), width)
    return ids, np.pad(cells, ((0, 0), (0, to - width)))


def exact_kind(queries: np.ndarray, vectors: np.ndarray):
    """The fastest number type in which no inner product is rounded."""
    most = int(np.abs(queries).max(initial=0)) * int(np.abs(vectors).max(initial=0)) * max(1, queries.shape[1])
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64


class Best:
    """The k best (score, id) of each query of a block, and MaxScore over further vectors."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.queries, self.k = ids, queries, k
        self.of, self.score, self.found = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(len(ids), -np.inf)  # k-th best score so far

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        kind = exact_kind(self.queries, vectors)
        q, x = self.queries.astype(kind), vectors.astype(kind)
        bound = np.maximum(q * x.max(axis=0), q * x.min(axis=0)).astype(np.float64)
        order = np.argsort(bound, axis=1, kind="stable")
        rising = np.cumsum(np.take_along_axis(bound, order, axis=1), axis=1)
        # Number of non-essential terms: the longest beginning of the order that stays below.
        below = rising < self.least[:, None]
        weak = np.where(below.all(axis=1), below.shape[1], below.argmin(axis=1)) if below.size else np.zeros(len(q), int)
        rest = np.concatenate([np.zeros((len(q), 1)), rising], axis=1)
        essential = q.copy()
        np.put_along_axis(essential, order, np.where(
            np.arange(q.shape[1]) < weak[:, None], 0, np.take_along_axis(q, order, axis=1)), axis=1)
        score = (essential @ x.T).astype(np.float64) if kind != np.int64 else essential @ x.T
        own = self.ids[:, None] == ids[None, :]
        # Where all terms were essential the scores are final and raise the bar at once.
        full = weak == 0
        if full.any() and len(ids) - 1 > self.k:
            ranked = np.where(own[full], score.min() - 1, score[full])
            bar = np.partition(ranked, len(ids) - self.k, axis=1)[:, len(ids) - self.k]
            self.least[full] = np.maximum(self.least[full], bar)
        reach = np.take_along_axis(rest, weak[:, None], axis=1)
        qi, xi = np.nonzero((score + reach >= self.least[:, None]) & ~own)
        got = score[qi, xi]
        left = weak[qi]
        while len(left) and left.max() > 0:
            probe = np.flatnonzero(left > 0)
            term = order[qi[probe], left[probe] - 1]
            got[probe] += q[qi[probe], term] * x[xi[probe], term]
            left[probe] -= 1
            alive = got + rest[qi, left] >= self.least[qi]
            qi, xi, got, left = qi[alive], xi[alive], got[alive], left[alive]
        self._merge(qi, got.astype(np.int64), ids[xi])

    def _merge(self, of, score, found):
        of, score, found = (np.concatenate(p) for p in ((self.of, of), (self.score, score), (self.found, found)))
        order = np.lexsort((found, ~score, of))
        of, score, found = of[order], score[order], found[order]
        start = np.searchsorted(of, np.arange(len(self.ids)))
        kept = np.arange(len(of)) - start[of] < self.k
        self.of, self.score, self.found = of[kept], score[kept], found[kept]
        counts = np.bincount(self.of, minlength=len(self.ids))
        last = np.cumsum(counts) - 1
        full = counts == self.k
        self.least[full] = self.score[last[full]]


def _search(batches, k):
    best: dict[int, Best] = {}
    for batch in batches:
        for number, *packed in zip(*(c.to_pylist() for c in batch.columns)):
            width = max(packed[1], packed[4])
            ids, vectors = _unpack(*packed[3:], width)
            if number not in best:
                best[number] = Best(*_unpack(*packed[:3], width), k)
            own = best[number]
            if own.queries.shape[1] < width:
                own.queries = np.pad(own.queries, ((0, 0), (0, width - own.queries.shape[1])))
            elif width < own.queries.shape[1]:
                vectors = np.pad(vectors, ((0, 0), (0, own.queries.shape[1] - width)))
            for start in range(0, len(ids), AT_ONCE):
                own.add(ids[start:start + AT_ONCE], vectors[start:start + AT_ONCE])
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    for own in best.values():
        yield arrow_batch(schema, pa.array(own.ids[own.of]), pa.array(own.found), pa.array(own.score))


def top_k(vectors: DataFrame, every: int = 20, k: int = 20, scale: float = 64.0, key: str = "vec_id",
          column: str = "embedding", shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of each row whose key is divisible by ``every``.

    The score is the inner product of floor(scale * x); ties go to the smaller key. Rows
    with a null key, a null vector, or null or non-finite components take no part. Missing
    components of a shorter vector count as 0. Repeated rows are candidates each, but not of
    a query with their own key; a repeated query is asked once (with its smallest vector).
    Products have to fit in 64 bits. No rows give no rows.

    Queries and vectors travel in blocks: every block of queries meets every shard, and a
    task holds one shard and the results of its queries at a time.
    """
    usable = vectors.select(vectors[key].cast("long").alias("id"), vectors[column].alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull())
    asked = usable.filter(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    shards = usable.mapInArrow(lambda batches: _pack(batches, scale, shard_rows), _PACKED_KIND)
    blocks = asked.mapInArrow(lambda batches: _pack(batches, scale, query_rows), _PACKED_KIND)
    blocks = stored(numbered(blocks, "number", "queries"), "queries")
    count = blocks.count()
    every_block = F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")) if count else F.array().cast("array<long>")
    pairs = shards.select(F.col("ids").alias("ids_x"), F.col("width").alias("width_x"), F.col("cells").alias("cells_x"),
                          F.explode(every_block).alias("number"))
    met = blocks.join(pairs, "number").select("number", "ids", "width", "cells", "ids_x", "width_x", "cells_x")
    found = met.mapInArrow(lambda batches: _search(batches, k), "query_id long, vec_id long, score long")
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
