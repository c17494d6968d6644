"""Near-duplicate components: an n-gram Jaccard join by T-occurrence search.

Two sets can only reach the similarity if they share some of their first shingles in a
common order: infrequent ones first, those known to be frequent last. With ``SHARED`` more
shingles in each beginning, they share that many. So

1. equal sets are one record;
2. each record's first shingles meet in buckets, and those of a single record end there, as
   do records that meet others in too few shingles;
3. a shingle's records are searched: one record is the query, the others' sets are indexed
   by inverted lists, and DivideSkip finds those that share enough shingles: the short
   lists are merged by a heap, the long ones are probed by binary search;
4. in the first rounds one record per component and shingle is searched for, which joins
   most of a large group with one search per record; then every pair of records in
   different components that share enough first shingles is searched. What is in one component
   already needs no link, so no group is expanded into its pairs. Shingles with the same
   foremost record are counted together: a block of records by its shingles is a matrix, whose
   products are the shared ones of all pairs, and only pairs that can be linked leave the task.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tierflow.llm import bloom
from tierflow.llm.common import arrow_batch, attach, bytes_of, slices, stored
from tierflow.llm.components import components
from tierflow.llm.shingles import set_hash, shingle_sets
from tierflow.session import bound_batches, scratch_path
from tierflow.sources.buckets import write_bucketed

PERCENT = 80
#: Candidates that are indexed together.
GROUP = 64
#: A shingle counts as frequent if partitions that hold it three times or more hold it so often in all.
FREQUENT, FREQUENT_MOST = 24, 1 << 18
ROUNDS = 2
#: Shingles that linked sets share in their beginnings, or all that they have to share if that is less.
SHARED = 8
#: First shingles of a block of records; shingles of more records than this are counted by products.
BLOCK, LISTED = 1 << 18, 32
#: Rows and bytes of texts whose words are hashed together: they take some forty times the bytes.
AT_ONCE = 64, 1 << 19
#: Shingles among which a task looks for frequent ones.
DESCRIBED = 4_000_000
#: First shingles that a task deals into buckets at once: they take some hundred bytes each.
DEALT = 1 << 18
#: Sets in a bucket of the stored ones.
SETS_AT_ONCE = 2048


def least_overlap(n: int, percent: int = PERCENT) -> int:
    """Shared shingles that a set of n needs at least with any set: ceil(percent % of n)."""
    return -(-percent * n // 100)


def linked(shared: int, a: int, b: int, percent: int = PERCENT) -> bool:
    return 100 * shared >= percent * (a + b - shared)


def divide_skip(lists: list[list[int]], least: int) -> dict[int, int]:
    """Ids that occur in ``least`` (1 or more) of the sorted lists, with their numbers of occurrences.

    Of the longest lists less than ``least`` are set aside. An id has to occur in the others
    often enough that the long lists could make up for the rest; those lists are merged by a
    heap. Only such ids are looked up in the long lists, while they can still reach ``least``.
    """
    lists = sorted(lists, key=len)
    cut = max(0, len(lists) - (least - 1))
    short, long = lists[:cut], lists[cut:]
    found = {}
    for candidate, run in groupby(heapq.merge(*short)):
        count = sum(1 for _ in run)
        left = len(long)
        for probe in long:
            if count + left < least:
                break
            left -= 1
            at = bisect_left(probe, candidate)
            count += at < len(probe) and probe[at] == candidate
        if count >= least:
            found[candidate] = count
    return found


def search(query: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT) -> list[int]:
    """The places of those sets that are linked with ``query``."""
    if not sets or not len(query):
        return []
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    tokens = np.concatenate(sets)
    at = np.minimum(np.searchsorted(query, tokens), len(query) - 1)
    hit = query[at] == tokens
    at, owner = at[hit], owner[hit]
    order = np.argsort(at, kind="stable")  # the owners of a shingle stay in order
    at, owner = at[order], owner[order].tolist()
    borders = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(owner)]
    lists = [owner[a:b] for a, b in zip(borders, borders[1:])] if owner else []
    found = divide_skip(lists, least_overlap(len(query), percent))
    return [i for i, shared in found.items() if linked(shared, len(query), len(sets[i]), percent)]


def _sets(part: pa.RecordBatch, column: int, width: int) -> list[np.ndarray]:
    return shingle_sets(bytes_of(part.column(column)), width)


def repeated(tokens: np.ndarray, least: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """The tokens that occur ``least`` times or more, ascending, and how often; ``tokens`` is sorted in place."""
    tokens.sort()
    reached = tokens[least - 1:][tokens[least - 1:] == tokens[:len(tokens) - least + 1]] if len(tokens) >= least else tokens[:0]
    # A token that occurs k times is found at k - least + 1 places.
    found, places = np.unique(reached, return_counts=True)
    return found, places + least - 1


def _describe(batches, width):
    """A row per document, and the shingles that are frequent in the partition (doc is null there)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("sig", pa.int64()), ("token", pa.int64())])
    held, size = np.empty(0, np.uint64), 0

    def frequent():
        tokens, counts = repeated(held[:size])
        return arrow_batch(schema, [None] * len(tokens), pa.array(counts), [None] * len(tokens), pa.array(tokens.view(np.int64)))

    for part in slices(batches, *AT_ONCE):
        sets = _sets(part, 1, width)
        yield arrow_batch(schema, part.column(0), [len(s) for s in sets], [set_hash(s) for s in sets], [None] * len(sets))
        more = sum(map(len, sets))
        if size + more > len(held):
            held = np.concatenate([held[:size], np.empty(max(more, min(size, DESCRIBED)), np.uint64)])
        if more:
            held[size:size + more] = np.concatenate(sets)
        size += more
        if size > DESCRIBED:
            yield frequent()
            size = 0
    if size:
        yield frequent()


class Order:
    """The common order of shingles: by hash, the frequent ones behind the others and by frequency."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        order = np.argsort(tokens)
        self.tokens = tokens[order]
        self.rank = np.empty(len(tokens), np.int64)
        self.rank[np.lexsort((self.tokens, counts[order]))] = np.arange(1, len(tokens) + 1)

    def ranks(self, shingles: np.ndarray) -> np.ndarray:
        """0 for the infrequent ones."""
        if not len(self.tokens):
            return np.zeros(len(shingles), np.int64)
        at = np.minimum(np.searchsorted(self.tokens, shingles), len(self.tokens) - 1)
        return np.where(self.tokens[at] == shingles, self.rank[at], 0)

    def first(self, shingles: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """The beginning of a set in this order, and the ranks of its shingles."""
        least = least_overlap(len(shingles), percent)
        count = len(shingles) - least + min(SHARED, least)
        rank = self.ranks(shingles)
        order = np.lexsort((shingles, rank))[:count]
        return shingles[order], rank[order]


_BUCKET = pa.schema([("bucket", pa.int64()), ("tokens", pa.binary()), ("sigs", pa.binary()), ("sizes", pa.binary()), ("places", pa.binary())])
_BUCKET_KIND = "bucket long, tokens binary, sigs binary, sizes binary, places binary"
_MET = pa.schema([("token", pa.int64()), ("sig", pa.int64()), ("n", pa.int64()), ("place", pa.int64())])
_MET_KIND = "token long, sig long, n long, place long"


def _deal(batches, order, buckets, width, percent):
    """First shingles by bucket, packed. The frequent ones are met for sure; they go to buckets below 0 by record."""
    seen: set[int] = set()
    held: list[tuple[np.ndarray, ...]] = []
    size = 0

    def flush():
        columns = list(zip(*held))
        held.clear()
        tokens, ranks, sigs, sizes, places = (np.concatenate(columns.pop(0)) for _ in range(5))
        bucket = np.where(ranks > 0, -1 - (sigs & (buckets - 1)), (tokens & np.uint64(buckets - 1)).astype(np.int64))
        by = np.argsort(bucket, kind="stable")
        tokens, sigs, sizes, places, bucket = tokens[by], sigs[by], sizes[by], places[by], bucket[by]
        borders = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
        parts = [slice(low, min(b, low + (1 << 16))) for a, b in zip(borders, borders[1:]) for low in range(a, b, 1 << 16)]
        for some in (parts[i:i + 1024] for i in range(0, len(parts), 1024)):
            yield arrow_batch(_BUCKET, [bucket[part.start] for part in some],
                              *([c[part].tobytes() for part in some] for c in (tokens, sigs, sizes, places)))

    for part in slices(batches, *AT_ONCE):
        for shingles in _sets(part, 0, width):
            if not len(shingles):
                continue
            sig = set_hash(shingles)
            if sig in seen:
                continue
            if len(seen) < 1_000_000:
                seen.add(sig)
            tokens, ranks = order.first(shingles, percent)
            held.append((tokens, ranks, np.full(len(tokens), sig, np.int64), np.full(len(tokens), len(shingles), np.int32),
                         np.arange(len(tokens), dtype=np.int32)))
            size += len(tokens)
        if size > DEALT:
            yield from flush()
            size = 0
    if held:
        yield from flush()


def _meet(batches):
    """Shingles of two or more records, from rows sorted by bucket; one bucket is held at a time."""
    def shared(rows, often):
        tokens = np.frombuffer(b"".join(r[0] for r in rows), np.int64)
        sigs = np.frombuffer(b"".join(r[1] for r in rows), np.int64)
        sizes = np.frombuffer(b"".join(r[2] for r in rows), np.int32).astype(np.int64)
        places = np.frombuffer(b"".join(r[3] for r in rows), np.int32).astype(np.int64)
        order = np.lexsort((sigs, tokens))
        tokens, sigs, sizes, places = tokens[order], sigs[order], sizes[order], places[order]
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (sigs[1:] != sigs[:-1])
        tokens, sigs, sizes, places = tokens[new], sigs[new], sizes[new], places[new]
        same = tokens[1:] == tokens[:-1]
        met = np.concatenate([[often], same | often]) | np.concatenate([same, [False]])
        return arrow_batch(_MET, *(pa.array(c[met]) for c in (tokens, sigs, sizes, places)))

    bucket, rows = None, []
    for batch in batches:
        for own, *packed in zip(*(c.to_pylist() for c in batch.columns)):
            if own != bucket and rows:
                yield shared(rows, bucket < 0)
                rows = []
            bucket = own
            rows.append(packed)
    if rows:
        yield shared(rows, bucket < 0)


def _needed_sets(batches, wanted, bits, width):
    """The sets of wanted records, from their representatives; other rows that pass the filter are copies."""
    schema = pa.schema([("sig", pa.int64()), ("shingles", pa.binary())])
    held = np.frombuffer(wanted.value, np.uint8)
    seen: set[int] = set()
    for part in slices(batches, *AT_ONCE):
        keyed = [(k or 0, s) for k, s in zip(part.column(0).to_pylist(), _sets(part, 1, width)) if len(s)]
        sets = [s for _, s in keyed]
        sigs = np.array([set_hash(s) for s in sets], np.int64)
        own = sigs ^ np.array([k for k, _ in keyed], np.int64)
        hit = bloom.contains(held, own, bits) if len(sigs) else np.zeros(0, bool)
        rows = []
        for sig, shingles, needed in zip(sigs.tolist(), sets, hit.tolist()):
            if needed and sig not in seen:
                if len(seen) < 1_000_000:
                    seen.add(sig)
                rows.append((sig, shingles.tobytes()))
        if rows:
            yield arrow_batch(schema, *zip(*rows))


def _by_sig(found: DataFrame, buckets: int) -> DataFrame:
    """The sets, once each, as a table in buckets, so that no round shuffles all of them again."""
    path = scratch_path(found.sparkSession, "sets")
    once = found.repartition(buckets, "sig").dropDuplicates(["sig"])
    return write_bucketed(once, f"sets_{path.rsplit('-', 1)[1]}", path, ["sig"], buckets)


def _search_groups(batches, percent):
    """Links of each query with the sets of its group, from rows sorted by group, the query first."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    group, query, sigs, sets = None, None, [], []

    def links():
        found = search(query, sets, percent)
        return arrow_batch(schema, [group[0]] * len(found), [sigs[i] for i in found])

    for batch in slices(batches, *AT_ONCE):
        for a, chunk, asked, sig, shingles in zip(*(c.to_pylist() for c in batch.columns)):
            if (a, chunk) != group:
                if sets:
                    yield links()
                group, query, sigs, sets = (a, chunk), None, [], []
            if asked:
                query = np.frombuffer(shingles, np.uint64)
            else:
                sigs.append(sig)
                sets.append(np.frombuffer(shingles, np.uint64))
    if sets:
        yield links()


def _searched(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The linked ones among the distinct pairs (a, b) of records."""
    pairs = stored(pairs, "pairs")
    degrees = stored(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("size")), "degrees")
    groups = F.ceil(F.col("size") / GROUP)
    candidates = attach(pairs, degrees, "a", "size", pairs.count()).select(
        "a", F.pmod(F.xxhash64("b"), groups).alias("chunk"), F.lit(False).alias("asked"), F.col("b").alias("sig"))
    queries = degrees.select("a", F.explode(F.sequence(F.lit(0).cast("long"), groups - 1)).alias("chunk"),
                             F.lit(True).alias("asked"), F.col("a").alias("sig"))
    dressed = candidates.unionByName(queries).join(sets, "sig").select("a", "chunk", "asked", "sig", "shingles")
    return dressed.repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.desc("asked")).mapInArrow(
        lambda batches: _search_groups(batches, percent), "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = PERCENT,
                    rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    component_id is the smallest key reachable by links. Null texts and texts without words
    have no shingles and are linked with nothing: their component is their own key. Equal
    texts are one component. Rows may repeat. A null key is never the smallest unless there
    is no other. Other columns are not read. Sets and shingles are told apart by 64-bit hashes.
    """
    bound_batches(docs.sparkSession)  # sets of shingles are wide rows
    rows = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
    described = stored(rows.mapInArrow(lambda b: _describe(b, width), "doc_id long, n long, sig long, token long"), "described")
    # A document's row has its set's hash, a frequent shingle's row has none.
    documents = described.filter("sig IS NOT NULL").select("doc_id", "n", "sig")
    records = stored(documents.filter("n > 0").groupBy("sig").agg(
        F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n")), "records")
    count = records.count()
    frequent = described.filter("sig IS NULL").groupBy("token").agg(F.sum("n").alias("c")).filter(F.col("c") >= FREQUENT)
    frequent = frequent.orderBy(F.desc("c"), "token").limit(FREQUENT_MOST).toArrow()
    order = docs.sparkSession.sparkContext.broadcast(
        Order(frequent.column("token").to_numpy().view(np.uint64), frequent.column("c").to_numpy()))
    buckets = 1 << max(8, (count // 512).bit_length())

    dealt = rows.select("text").mapInArrow(lambda b: _deal(b, order.value, buckets, width, percent), _BUCKET_KIND)
    met = stored(dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_meet, _MET_KIND), "met")
    # A record's frequent shingles lie in one bucket, so they are told apart there too.
    entries = stored(_entries(met, percent), "entries")
    sigs = entries.groupBy("sig").agg(F.first("n").alias("n"), F.first("shared").alias("shared"))
    sigs = stored(sigs.join(records.select("sig", "least"), "sig"), "met-records")
    searched = sigs.count()
    bits = bloom.filter_bits(searched)
    representative = F.col("sig").bitwiseXOR(F.coalesce("least", F.lit(0).cast("long")))
    wanted, _ = bloom.build(sigs.select(representative.alias("sig")), bits)
    wanted = docs.sparkSession.sparkContext.broadcast(wanted)
    found = rows.mapInArrow(lambda b: _needed_sets(b, wanted, bits, width), "sig long, shingles binary")
    sets = _by_sig(found, max(8, -(-searched // SETS_AT_ONCE)))

    roots = stored(sigs.select("sig", F.col("sig").alias("root")), "roots")
    for turn in range(rounds + 1):
        placed = entries.join(roots, "sig") if turn else entries.withColumn("root", F.col("sig"))
        if turn < rounds:
            pairs = _star_pairs(placed, turn, percent)
        else:
            pairs = _all_pairs(placed, percent)
        links = stored(_searched(pairs, sets, percent), "links")
        by_root = roots.select(F.col("sig").alias("a"), F.col("root").alias("ra"))
        joined = links.join(by_root, "a").join(by_root.select(F.col("a").alias("b"), F.col("ra").alias("rb")), "b")
        merged = components(joined.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
        sizes = stored(roots.groupBy("root").agg(F.count(F.lit(1)).alias("size")).join(
            merged.select(F.col("node").alias("root"), F.col("root").alias("new")), "root", "left").select(
                "root", "size", F.coalesce("new", "root").alias("new")), "renamed")
        roots = stored(attach(roots, sizes, "root", "size", max(1, count)).select("sig", F.col("new").alias("root")), "roots")

    named = stored(records.join(roots, "sig", "left").select("sig", "least", "copies", "n", F.coalesce("root", "sig").alias("root")), "named")
    least = stored(named.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("size")), "least")
    known = stored(attach(named, least, "root", "size", max(1, count)).select("sig", "component_id", "copies"), "known")
    filled = documents.filter("n > 0")
    result = attach(filled, known, "sig", "copies", max(1, documents.count()))
    return result.select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(
        documents.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def _fits(a: str, b: str, percent: int) -> F.Column:
    """Can sets of these sizes be linked?"""
    return 100 * F.least(F.col(a), F.col(b)) >= percent * F.greatest(F.col(a), F.col(b))


def _entries(met: DataFrame, percent: int) -> DataFrame:
    """token, sig, n, own, shared: the first shingles by which records can be linked.

    What no other record has among its first shingles and what comes before a shared one in
    the common order, the other set cannot have at all. So ``own``, a set's size without
    those, bounds what it shares with any record that it meets there; ``shared`` counts a
    record's rows.
    """
    record = Window.partitionBy("sig")
    own = F.col("n") - F.col("place") + F.row_number().over(record.orderBy("place")) - 1
    kept = met.withColumn("own", own).filter(100 * F.col("own") >= percent * F.col("n"))
    enough = F.least(F.lit(SHARED), F.ceil(F.col("n") * percent / 100))
    kept = kept.withColumn("shared", F.count(F.lit(1)).over(record)).filter(F.col("shared") >= enough)
    return kept.select("token", "sig", "n", "own", "shared")


def _least_shared(n, m, percent: int, greatest, least, ceil):
    """First shingles that linked sets of these sizes share at least.

    Where the first of two beginnings ends, all shared shingles up to there are counted, and the
    others lie in what that set has left; together they have to reach the overlap of linked sets.
    """
    def left(size):
        required = ceil(size * percent / 100)
        return required - least(SHARED, required)

    return greatest(1, ceil((n + m) * percent / (100 + percent)) - greatest(left(n), left(m)))


def _foremost(lot) -> F.Column:
    """The record that speaks for a shingle."""
    return F.min(F.struct(lot.alias("lot"), "sig", "n", "shared"))


def _strength() -> F.Column:
    # First the record with most shared shingles for its size: the text that others were made from
    # shares all of its own, a changed copy only what the change has left.
    return -F.col("shared") / F.col("n")


def _star_pairs(placed: DataFrame, turn: int, percent: int) -> DataFrame:
    """One record per shingle and component, paired with one of them per shingle, if they can be linked."""
    lot = _strength() if turn == 0 else F.xxhash64(F.lit(turn), "sig")
    members = stored(placed.groupBy("token", "root").agg(_foremost(lot).alias("member")) if turn else placed.select(
        "token", F.struct(lot.alias("lot"), "sig", "n", "shared").alias("member")), "members")
    centres = members.groupBy("token").agg(F.min("member").alias("centre"), F.count(F.lit(1)).alias("size"))
    centres = stored(centres.filter("size > 1").select("token", "centre.*", "size").withColumnsRenamed(
        {"sig": "a", "n": "na", "shared": "all"}), "centres")
    met = attach(members, centres, "token", "size", max(1, members.count())).select(
        "a", "na", "all", F.col("member.sig").alias("b"), F.col("member.n").alias("nb"), F.col("member.shared").alias("shared"))
    met = met.filter((F.col("a") != F.col("b")) & _fits("na", "nb", percent)).groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("here"), *[F.first(c).alias(c) for c in ("na", "nb", "all", "shared")])
    spoken = centres.groupBy("a").agg(F.count(F.lit(1)).alias("spoken"))
    # They may also share shingles for which another record speaks.
    most = F.col("here") + F.least(F.col("shared") - F.col("here"), F.col("all") - F.col("spoken"))
    least = _least_shared(F.col("na"), F.col("nb"), percent, *_COLUMNS)
    return met.join(spoken, "a").filter(most >= least).select("a", "b")


_COLUMNS = (lambda a, b: F.greatest(*(F.lit(c) if isinstance(c, int) else c for c in (a, b))),
            lambda a, b: F.least(*(F.lit(c) if isinstance(c, int) else c for c in (a, b))), F.ceil)


def _all_pairs(placed: DataFrame, percent: int) -> DataFrame:
    """All pairs of records in different components that share enough first shingles and fit in size.

    A shingle is counted with all others for which the same record speaks. Many records of
    one such group are dealt into blocks, and each two blocks meet in a task.
    """
    placed = stored(placed, "placed")
    spread = placed.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("size"),
                                         _foremost(_strength()).alias("centre"))
    spread = stored(spread.filter("low <> high").select("token", "size", F.col("centre.sig").alias("centre")), "spread")
    open_ = stored(attach(placed, spread, "token", "size", max(1, placed.count())).select(
        "centre", "token", "sig", "n", "own", "shared", "root"), "open")
    sizes = open_.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks")).filter("blocks > 1")
    blocks = F.coalesce("blocks", F.lit(1).cast("long"))
    dealt = open_.join(F.broadcast(sizes), "centre", "left").withColumn("block", F.pmod(F.xxhash64("sig"), blocks))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    dealt = dealt.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    group = ["centre", "low", "high"]
    dealt = dealt.select(*group, "token", "sig", "n", "own", "shared", "root", "block")
    found = dealt.repartition(*group).sortWithinPartitions(*group).mapInArrow(
        lambda batches: _candidates(batches, percent), "a long, b long, shared long, least long")
    # A pair that can be linked comes from each of its groups, so this is all that they share.
    return found.groupBy("a", "b").agg(F.sum("shared").alias("shared"), F.first("least").alias("least")).filter(
        "shared >= least").select("a", "b")


def _numbers(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(each row's number among the distinct keys in order, the first row of each)."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, order[new]


def _candidates(batches, percent):
    """Pairs that can be linked, from rows sorted by group; some whole groups are held at a time."""
    schema = pa.schema([(name, pa.int64()) for name in ("a", "b", "shared", "least")])
    held: list[np.ndarray] = []
    size = 0

    def pairs(rows):
        for found in _pairs_of_groups(rows, percent):
            if len(found[0]):
                yield arrow_batch(schema, *map(pa.array, found))

    for batch in batches:
        held.append(np.stack([c.to_numpy() for c in batch.columns]))
        size += batch.num_rows
        if size >= BLOCK // 4:
            rows = np.concatenate(held, axis=1)
            borders = np.flatnonzero((rows[:3, 1:] != rows[:3, :-1]).any(axis=0)) + 1
            cut = borders[-1] if len(borders) else 0
            if cut:
                yield from pairs(rows[:, :cut])
            held, size = [rows[:, cut:].copy()], 0
    if held:
        rows = np.concatenate(held, axis=1)
        if rows.shape[1]:
            yield from pairs(rows)


def _pairs_of_groups(rows: np.ndarray, percent: int):
    """Arrays of records in different components that may share enough: both, what they share in a group, the least in all."""
    centre, low, high, token, sig, n, own, shared, root, block = rows
    group, _ = _numbers(centre, low, high)
    member, first = _numbers(group, sig)
    column, first_column = _numbers(group, token)
    of, crossed = group[first], (low != high)[first]
    sig, n, root, block, rest = sig[first], n[first], root[first], block[first], shared[first] - np.bincount(member)
    most = np.zeros(len(first), np.int64)
    np.maximum.at(most, member, own)

    def able(a, b, count):
        at = (root[a] != root[b]) & (count + np.minimum(rest[a], rest[b]) >= 1) & ~(crossed[a] & (block[a] == block[b]))
        a, b, count = a[at], b[at], count[at]
        na, nb = n[a], n[b]
        least = _least_shared(na, nb, percent, np.maximum, np.minimum, lambda x: np.ceil(x).astype(np.int64))
        at = (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)) & (count + np.minimum(rest[a], rest[b]) >= least)
        at &= (100 + percent) * np.minimum(most[a], most[b]) >= percent * (na + nb)
        a, b = sig[a[at]], sig[b[at]]
        return np.minimum(a, b), np.maximum(a, b), count[at], least[at]

    by = np.lexsort((member, column))
    column, member = column[by], member[by]
    # A group whose shingles all have few records is counted by lists, any other by products.
    largest = np.zeros(of[-1] + 1, np.int64)
    np.maximum.at(largest, group[first_column], np.bincount(column))
    listed = largest[of[member]] <= LISTED
    columns, members = column[listed], member[listed]
    codes = []
    for step in range(1, LISTED):
        same = columns[step:] == columns[:-step]
        if not same.any():
            break
        codes.append(members[:-step][same] * len(first) + members[step:][same])
    if codes:
        codes, counts = np.unique(np.concatenate(codes), return_counts=True)
        yield able(codes // len(first), codes % len(first), counts)
    borders = np.searchsorted(of, np.arange(of[-1] + 2))
    heavy = np.flatnonzero(largest > LISTED)
    for g in heavy.tolist():
        inside = of[member] == g
        columns, members = column[inside] - column[inside][0], member[inside]
        width, by = columns[-1] + 1, np.argsort(members, kind="stable")
        columns, members = columns[by], members[by]
        at_once = int(np.clip((1 << 22) // width, 1, 1024))
        starts = range(borders[g], borders[g + 1], at_once)

        def matrix(start):
            part = slice(*np.searchsorted(members, (start, start + at_once)))
            out = np.zeros((min(at_once, borders[g + 1] - start), width), np.float32)
            out[members[part] - start, columns[part]] = 1
            return out

        for i in starts:
            left = matrix(i)
            for j in range(i, borders[g + 1], at_once):
                product = left @ (left if i == j else matrix(j)).T
                a, b = np.nonzero(np.triu(product, 1) if i == j else product)
                yield able(a + i, b + j, product[a, b].astype(np.int64))
