"""Hard negatives by cover trees over norm-augmented vectors.

Vectors are dealt into shards. Inside a shard every vector gets one more component, which
brings all of them to the same length M, and a cover tree is built over them: the children
of a node are points more than half its level's radius apart, and each point lies within
that half of the child it belongs to. For a query, which has 0 in the added component, a
node with centre c and covering radius r bounds the inner products of all points below it
twice: by the triangle inequality on the distances from the query, as |q - x|^2 is
|q|^2 + M^2 - 2 qx, and by |qx - qc| <= |q| r. The descent takes the node with the highest
bound first, leaves out nodes that lie outside all windows of scores still wanted, and
computes the scores of a leaf's points exactly, in integers.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tierflow.llm.common import arrow_batch, numbered
from tierflow.llm.shelf import Shelf
from tierflow.llm.topk import exact_kind, integer_rows

SHARD_ROWS = 2048
SHARDS_AT_ONCE = 4
QUERY_ROWS = 256
LEAF = 64
AT_ONCE = 1 << 14  # scores that are taken before the bars are raised

_NODE = np.dtype([("begin", "<i4"), ("end", "<i4"), ("children", "<i4"), ("last", "<i4"), ("centre", "<i4"), ("radius", "<f8")])
_PACK = pa.schema([(n, pa.binary()) for n in ("ids", "labels", "cells", "tree", "windows")] + [("width", pa.int32())])
_PACK_KIND = "ids binary, labels binary, cells binary, tree binary, windows binary, width int"
_FOUND = pa.schema([("query_id", pa.int64()), ("window", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])


def augmented(vectors: np.ndarray) -> np.ndarray:
    """The vectors with a component that brings all to the length of the longest."""
    x = vectors.astype(np.float64)
    squares = (x * x).sum(axis=1)
    return np.column_stack([x, np.sqrt(np.maximum(squares.max(initial=0.0) - squares, 0.0))])


def _split(points: np.ndarray, at: np.ndarray, radius: float) -> list[tuple[np.ndarray, float]]:
    """The points ``at`` in groups around centres that lie more than ``radius`` apart.

    The first point of a group is its centre; the number is the group's covering radius.
    """
    groups = []
    while len(at):
        away = np.sqrt(((points[at] - points[at[0]]) ** 2).sum(axis=1))
        near = away <= radius
        near[0] = True
        groups.append((at[near], float(away[near].max())))
        at = at[~near]
    return groups


def cover_tree(vectors: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """(order of the vectors, nodes); a node covers a range of that order.

    Points that are left with few others around their centre share leaves with their kind.
    """
    points = augmented(vectors)
    order = np.arange(len(points))
    away = np.sqrt(((points - points[0]) ** 2).sum(axis=1))
    nodes = [[0, len(points), 0, 0, 0, float(away.max())]]
    i = 0
    while i < len(nodes):
        begin, end, _, _, _, radius = nodes[i]
        if end - begin > leaf and radius > 0:
            half, groups = radius, []
            while len(groups) < 2:
                half /= 2
                groups = _split(points, order[begin:end], half)
            large = [g for g in groups if len(g[0]) * 4 >= leaf]
            few = [g[0] for g in groups if len(g[0]) * 4 < leaf]
            if few:
                loose = np.concatenate(few)
                for start in range(0, len(loose), leaf):
                    part = loose[start:start + leaf]
                    spread = np.sqrt(((points[part] - points[part[0]]) ** 2).sum(axis=1))
                    large.append((part, float(spread.max())))
            nodes[i][2], nodes[i][3] = len(nodes), len(nodes) + len(large)
            at = begin
            for members, covering in large:
                order[at:at + len(members)] = members
                nodes.append([at, at + len(members), 0, 0, int(members[0]), covering])
                at += len(members)
        i += 1
    found = np.array([tuple(n) for n in nodes], _NODE)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    found["centre"] = place[found["centre"]]
    return order, found


class _Shard:
    """A shard's vectors in the order of its tree."""

    def __init__(self, ids, labels, cells, tree, width):
        self.ids = np.frombuffer(ids, "<i8")
        self.labels = np.frombuffer(labels, "<i8")
        self.vectors = np.frombuffer(cells, "<i8").reshape(len(self.ids), width)
        self.nodes = np.frombuffer(tree, _NODE)
        self.longest = float((self.vectors.astype(np.float64) ** 2).sum(axis=1).max())

    def meet(self, width):
        """Vectors and centres for queries of a width; missing components are 0."""
        if self.vectors.shape[1] < width:
            self.vectors = np.pad(self.vectors, ((0, 0), (0, width - self.vectors.shape[1])))
        self.centres = self.vectors[self.nodes["centre"]].astype(np.float64)

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, most) inner product of each query with any point below each node, with room for rounding."""
        square, radius = (queries * queries).sum(axis=1)[:, None], self.nodes["radius"][None, :]
        product = queries @ self.centres.T
        far = np.sqrt(np.maximum(square + self.longest - 2 * product, 0.0))
        reach = np.sqrt(square) * radius
        half = (square + self.longest) / 2
        most = np.minimum(product + reach, half - np.maximum(far - radius, 0.0) ** 2 / 2)
        least = np.maximum(product - reach, half - (far + radius) ** 2 / 2)
        room = 1e-9 * (square + self.longest) + 1e-6
        return least - room, most + room


class _Wanted:
    """The best ``k`` scores inside each window of each query of a block."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low, high, k
        self.bar = low.copy()  # what a score has to reach
        self.of, self.score, self.found = (np.zeros(0, np.int64) for _ in range(3))
        self.new, self.size = [], 0

    def open(self, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Which queries may want a point whose score lies within the bounds?"""
        inside = (most[:, None] >= self.bar) & (least[:, None] <= self.high) & (self.low <= self.high)
        return inside.any(axis=1)

    def add(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray, fit: np.ndarray) -> None:
        """Scores of points (rows) for some of the queries (columns), where they fit."""
        for window in range(self.low.shape[1]):
            take = fit & (scores >= self.bar[queries, window]) & (scores <= self.high[queries, window])
            point, query = np.nonzero(take)
            if len(point):
                self.new.append((queries[query] * self.low.shape[1] + window, scores[point, query], ids[point]))
                self.size += len(point)
        if self.size >= AT_ONCE:
            self.settle()

    def settle(self) -> None:
        """Keep the best and raise the bars."""
        of, score, found = (np.concatenate(p) for p in zip((self.of, self.score, self.found), *self.new))
        order = np.lexsort((found, ~score, of))
        of, score, found = of[order], score[order], found[order]
        start = np.searchsorted(of, np.arange(self.bar.size))
        kept = np.arange(len(of)) - start[of] < self.k
        self.of, self.score, self.found = of[kept], score[kept], found[kept]
        counts = np.bincount(self.of, minlength=self.bar.size)
        full = counts == self.k
        self.bar.reshape(-1)[full] = self.score[(np.cumsum(counts) - 1)[full]]
        self.new, self.size = [], 0


def descend(shards: list[_Shard], ids: np.ndarray, labels: np.ndarray, queries: np.ndarray, wanted: _Wanted, same: bool) -> None:
    """Best-first through the trees of all shards, for a block of queries at once.

    The next node is the one with the highest bound for any query that is open to it, and
    only those queries go on below it. Points of a leaf are scored by one product.
    """
    exact = queries.astype(np.float64)
    bounds = [shard.bounds(exact) for shard in shards]
    heap = []

    def push(i, at):
        least, most = bounds[i][0][:, at], bounds[i][1][:, at]
        open_ = wanted.open(least, most)
        if open_.any():
            heapq.heappush(heap, (-float(most[open_].max()), i, at))

    for i in range(len(shards)):
        push(i, 0)
    while heap:
        _, i, at = heapq.heappop(heap)
        shard, node = shards[i], shards[i].nodes[at]
        own = np.flatnonzero(wanted.open(bounds[i][0][:, at], bounds[i][1][:, at]))
        if not len(own):
            continue
        if node["children"]:
            for child in range(node["children"], node["last"]):
                push(i, child)
            continue
        part = slice(node["begin"], node["end"])
        vectors, points = shard.vectors[part], shard.ids[part]
        kind = np.float64 if exact_kind(queries[own], vectors) != np.int64 else np.int64
        scores = (vectors.astype(kind) @ queries[own].astype(kind).T).astype(np.int64)
        fit = ((shard.labels[part][:, None] == labels[own]) == same) & (points[:, None] != ids[own])
        wanted.add(own, scores, points, fit)
    wanted.settle()


def _pack_shards(batches, scale, rows):
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            usable, cells = integer_rows(part.column(2), scale)
            if len(usable):
                ids, labels = (part.column(i).to_numpy(zero_copy_only=False).astype("<i8")[usable] for i in (0, 1))
                order, nodes = cover_tree(cells)
                yield arrow_batch(_PACK, [ids[order].tobytes()], [labels[order].tobytes()],
                                  [cells[order].astype("<i8").tobytes()], [nodes.tobytes()], [None], [cells.shape[1]])


def _pack_queries(batches, scale, rows, low, high):
    """Blocks of anchors; a window is [low, high] percent of a positive's score, or unbounded."""
    ends = np.iinfo(np.int64)
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            usable, cells = integer_rows(part.column(2), scale)
            if not len(usable):
                continue
            ids, labels = (part.column(i).to_numpy(zero_copy_only=False).astype("<i8")[usable] for i in (0, 1))
            sizes, windows = np.ones(len(usable), "<i8"), np.array([[ends.min, ends.max]] * len(usable), "<i8")
            if part.num_columns > 3:
                scores = part.column(3).take(pa.array(usable))
                sizes = scores.value_lengths().to_numpy(zero_copy_only=False).astype("<i8")
                flat = scores.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                windows = np.column_stack([-((-low * flat) // 100), (high * flat) // 100]).astype("<i8")
            yield arrow_batch(_PACK, [ids.tobytes()], [labels.tobytes()], [cells.astype("<i8").tobytes()], [None],
                              [sizes.tobytes() + windows.tobytes()], [cells.shape[1]])


def _search(batches, k, same):
    """Rows come by group: its shards first, then the blocks of queries one after the other."""
    group, shards = None, []
    for batch in batches:
        for number, ids, labels, cells, tree, windows, width in zip(*(c.to_pylist() for c in batch.columns)):
            if number != group:
                group, shards = number, []
            if tree is not None:
                shards.append(_Shard(ids, labels, cells, tree, width))
                continue
            if not shards:
                continue
            ids, labels = np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8")
            most = max(width, *(s.vectors.shape[1] for s in shards))
            queries = np.pad(np.frombuffer(cells, "<i8").reshape(len(ids), width), ((0, 0), (0, most - width)))
            for shard in shards:
                shard.meet(most)
            sizes, windows = np.frombuffer(windows[:8 * len(ids)], "<i8"), np.frombuffer(windows[8 * len(ids):], "<i8").reshape(-1, 2)
            # Queries with fewer windows than others get empty ones.
            nth = np.arange(len(windows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            low = np.ones((len(ids), int(sizes.max(initial=1))), np.int64)
            high = np.zeros_like(low)
            low[np.repeat(np.arange(len(ids)), sizes), nth], high[np.repeat(np.arange(len(ids)), sizes), nth] = windows.T
            wanted = _Wanted(low, high, k)
            descend(shards, ids, labels, queries, wanted, same)
            query, window = np.divmod(wanted.of, low.shape[1])
            yield arrow_batch(_FOUND, pa.array(ids[query]), pa.array(window.astype(np.int32)), pa.array(wanted.found), pa.array(wanted.score))


def _nearest(shards: DataFrame, blocks: DataFrame, k: int, same: bool) -> DataFrame:
    """query_id, window, vec_id, score, rank: the ``k`` best of each window over all shards."""
    groups = max(1, -(-shards.count() // SHARDS_AT_ONCE))
    dealt = shards.select((F.col("number") % groups).cast("long").alias("group"), *_PACK.names)
    asked = blocks.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group"), *_PACK.names)
    met = dealt.unionByName(asked).repartition("group").sortWithinPartitions("group", F.col("tree").isNull())
    found = met.mapInArrow(lambda batches: _search(batches, k, same), "query_id long, window int, vec_id long, score long")
    place = Window.partitionBy("query_id", "window").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)


def mine_negatives(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30,
                   high: int = 90, scale: float = 256.0, key: str = "vec_id", column: str = "embedding",
                   label: str = "label", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose key is divisible by ``every``. A score is the inner product of
    floor(scale * x), and higher ones come first, then smaller keys. An anchor's positives
    are the first other rows of its label, and a positive's negatives the first rows of other
    labels whose score lies from ``low`` to ``high`` percent of the positive's.

    Rows with a null key, label or vector, or a null or non-finite component take no part.
    Missing components of a shorter vector count as 0. Repeated rows count each, but never
    for an anchor with their own key; a repeated anchor is asked once (smallest label, then
    vector). A negative or absent positive score has no negatives, and anchors without any
    give no rows; neither does an empty table. Products, times ``high``, have to fit in 64 bits.

    Anchors meet every shard in blocks; a task holds a few shards and one block at a time.
    """
    shelf = Shelf(vectors.sparkSession, "negatives")
    usable = vectors.select(vectors[key].cast("long").alias("id"), vectors[label].cast("long").alias("label"),
                            vectors[column].alias("v")).dropna()
    shards = shelf.put("shards", numbered(
        usable.mapInArrow(lambda batches: _pack_shards(batches, scale, shard_rows), _PACK_KIND), "number", "shards"))
    anchors = usable.filter(F.col("id") % every == 0).groupBy("id").agg(F.min(F.struct("label", "v")).alias("a"))
    anchors = shelf.put("anchors", anchors.select("id", "a.label", "a.v"))

    def blocks(df):
        return df.mapInArrow(lambda batches: _pack_queries(batches, scale, QUERY_ROWS, low, high), _PACK_KIND)

    near = shelf.put("positives", _nearest(shards, blocks(anchors), positives, True).select(
        "query_id", F.col("rank").alias("nth"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    listed = near.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("nth", "positive_score"))).alias("p"))
    bound = anchors.join(listed, F.col("id") == F.col("query_id")).select("id", "label", "v", F.col("p.positive_score").alias("scores"))
    found = _nearest(shards, blocks(bound), negatives, False)
    return found.join(near.withColumnRenamed("query_id", "anchor_id"),
                      (F.col("query_id") == F.col("anchor_id")) & (F.col("window") + 1 == F.col("nth"))).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
