"""Large groups of texts that are nearly, but not all, linked."""

import random
import re
import tracemalloc
from itertools import combinations

import numpy as np
import pyarrow as pa

from tierflow.llm import langid, near_dup


def brute_force(sets, roots, percent=80):
    """Pairs of sets in different components that share at least ``percent``."""
    return {(a, b) for a, b in combinations(sorted(sets), 2) if roots[a] != roots[b]
            and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}


def group_of_copies(seed, members):
    """Sets made from one base, each with some shingles of its own instead; components by chance."""
    rng = random.Random(seed)
    sets, roots = {}, {}
    for i in range(members):
        changed = rng.randint(4, 28)
        kept = rng.sample(range(120), 120 - changed)
        sets[i] = {1_000_000 + k for k in kept} | {1000 * i + k for k in range(changed)}
        roots[i] = i if rng.random() < 0.5 else 0
    return sets, roots


def rows_met(sets, percent=80):
    """token, sig, n, place: the beginnings of the sets, from the common order, as far as others hold them."""
    every = [t for s in sets.values() for t in s]
    tokens, counts = np.unique(np.array(every, np.uint64), return_counts=True)
    order = near_dup.Order(tokens[counts > 1], counts[counts > 1])
    first = {sig: order.first(np.array(sorted(s), np.uint64), percent)[0].tolist() for sig, s in sets.items()}
    held = {}
    for sig, beginning in first.items():
        for t in beginning:
            held.setdefault(t, set()).add(sig)
    return [(t, sig, len(sets[sig]), place) for sig, beginning in first.items()
            for place, t in enumerate(beginning) if len(held[t]) > 1]


def test_no_pair_is_lost_and_none_is_made_by_a_join(spark, monkeypatch):
    sets, roots = group_of_copies(3, 60)
    links = brute_force(sets, roots)
    assert links
    met = spark.createDataFrame(rows_met(sets), "token long, sig long, n long, place long")
    placed = near_dup._entries(met, 80).join(spark.createDataFrame(list(roots.items()), "sig long, root long"), "sig")
    for block in (1 << 18, 150):  # one block, and several that meet each other
        monkeypatch.setattr(near_dup, "BLOCK", block)
        pairs = near_dup._all_pairs(placed, 80)
        found = [(r.a, r.b) for r in pairs.collect()]
        assert len(found) == len(set(found)) and links <= set(found)
        assert all(roots[a] != roots[b] for a, b in found)
        # No self-join of records makes the pairs.
        assert not re.search(r"a#\d+L < b#\d+L", pairs._jdf.queryExecution().toString())


def test_lists_and_products_find_the_same(monkeypatch):
    sets, roots = group_of_copies(5, 50)
    tokens = sorted({t for s in sets.values() for t in s if t >= 1_000_000})
    rows = [(7, 0, 0, t, sig, len(s), len(s), len(s & set(tokens)), roots[sig], 0)
            for sig, s in sets.items() for t in tokens if t in s]
    found = []
    for listed in (1000, 2):
        monkeypatch.setattr(near_dup, "LISTED", listed)
        groups = list(near_dup._pairs_of_groups(np.array(rows, np.int64).T, 80))
        found.append(sorted(zip(*(np.concatenate(c).tolist() for c in zip(*groups)))))
    assert found[0] == found[1]
    assert brute_force(sets, roots) <= {(a, b) for a, b, *_ in found[0]}
    assert all(shared == len(sets[a] & sets[b]) for a, b, shared, _ in found[0])


def test_repeated_shingles_are_found_in_little_memory():
    rng = np.random.default_rng(2)
    for size in (0, 1, 2, 3, 5000):
        tokens = rng.integers(0, 1500, size).astype(np.uint64)
        distinct, counts = np.unique(tokens, return_counts=True)
        found, often = near_dup.repeated(tokens.copy())
        assert found.tolist() == distinct[counts >= 3].tolist() and often.tolist() == counts[counts >= 3].tolist()
    tokens = rng.integers(0, 1 << 62, 1 << 20).astype(np.uint64)
    tracemalloc.start()
    near_dup.repeated(tokens)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < tokens.nbytes // 2


def test_texts_are_read_in_small_slices():
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["alpha", "beta", "gamma", "delta"], k=400)) for _ in range(512)]
    batches = [pa.RecordBatch.from_arrays([pa.array(range(512)), pa.array(texts)], ["doc_id", "text"])]
    labelled = [pa.RecordBatch.from_arrays([pa.array(["en"] * 512), pa.array(texts)], ["lang", "text"])]
    size = sum(map(len, texts))
    for run in (lambda: near_dup._describe(iter(batches), 5), lambda: langid._count(iter(labelled))):
        tracemalloc.start()
        assert sum(out.num_rows for out in run())
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert most < 15 * size


def test_searched_sets_are_copied_in_small_slices():
    shingles = np.arange(4000, dtype=np.uint64).tobytes()
    names = ["a", "chunk", "asked", "sig", "shingles"]
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary()]
    rows = [(a, 0, not i, 2 * a + i, shingles) for a in range(150) for i in range(2)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
    tracemalloc.start()
    links = [(r["a"], r["b"]) for out in near_dup._search_groups(iter([batch]), 80) for r in out.to_pylist()]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert links == [(a, 2 * a + 1) for a in range(150)] and most < batch.nbytes // 2


def test_first_shingles_are_dealt_in_small_shares():
    numbers = np.random.default_rng(3).integers(0, 1 << 40, (8000, 400))
    texts = (pa.array([" ".join(map(str, row)) for row in numbers[i:i + 500].tolist()]) for i in range(0, 8000, 500))
    batches = (pa.RecordBatch.from_arrays([t], ["text"]) for t in texts)
    order = near_dup.Order(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    tracemalloc.start()
    dealt, yielded = 0, 0
    for out in near_dup._deal(batches, order, 256, 5, 80):
        dealt, yielded = dealt + sum(len(b) // 8 for b in out.column(1).to_pylist()), yielded + 1
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert dealt == 8000 * (396 - near_dup.least_overlap(396) + near_dup.SHARED)
    assert most < 64_000_000 and yielded < 10
