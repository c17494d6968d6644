"""Phrases, hard negatives and repeated passages: against brute force on small tables."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierflow.llm import hard_negatives, phrases, repeats
from tierflow.llm.hard_negatives import cover_tree, mine_negatives
from tierflow.llm.phrases import count_pairs, mine_phrases, split_pieces
from tierflow.llm.repeats import first_documents, remove_repeats


# --- phrases ---------------------------------------------------------------------------

def phrase_rows(docs, least, first, swallow=80, scale=2_000_000):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = lang or "und"
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i:i + size])] += 1
    out = []
    for lang, own in counts.items():
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        rows = []
        for phrase, a in candidates.items():
            over = [f for q, f in candidates.items() if len(q) > len(phrase)
                    and any(q[i:i + len(phrase)] == phrase for i in range(len(q)))]
            if any(100 * f >= swallow * a for f in over):
                continue
            score, _, left, right = min((scale * a // (own[phrase[:k]] + own[phrase[k:]]), k, own[phrase[:k]], own[phrase[k:]])
                                        for k in range(1, len(phrase)))
            rows.append((-score, -a, " ".join(phrase).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def test_phrases(documents, clashing):
    rng = random.Random(5)
    words = ["a", "B", "c", "dd", "É", "漢", "x\xa0y", "\x1f"]
    texts = [" ".join(rng.choice(words) + rng.choice(["", "", "", ",", "\n", "\t", " "]) for _ in range(rng.randint(0, 60))) for _ in range(120)]
    docs = [(t, rng.choice(["en", "de", None, "und"])) for t in texts] + [("", "en"), (None, "en"), (". , \n", "fr"), ("alone", "fr")]
    docs += [("copy of a line, copy of a line", "en")] * 9
    df = clashing(documents(*[(i, t, lang) for i, (t, lang) in enumerate(docs)])).repartition(3)
    for least, first in ((2, 10**6), (5, 7)):
        got = sorted(tuple(r) for r in mine_phrases(df, least=least, first=first, block_bytes=400).collect())
        assert got == phrase_rows(docs, least, first)


def test_phrases_of_odd_tables(documents):
    assert mine_phrases(documents()).count() == 0
    assert mine_phrases(documents((1, None), (2, " . "))).count() == 0
    long = documents((1, "x y " * 40_000, "en"))
    got = [tuple(r) for r in mine_phrases(long, block_bytes=1000).collect()]
    assert got == [tuple(r) for r in phrase_rows([("x y " * 40_000, "en")], 30, 2000)]


def test_pieces():
    words, pieces = split_pieces("Ab\tc. d\x0be  ,,f".encode())
    assert words == [b"ab", b"c", b"d", b"e", b"f"] and pieces.tolist() == [0, 0, 1, 2, 4]


def test_tiles_count_every_pair(monkeypatch):
    monkeypatch.setattr(phrases, "TILE", 8)
    monkeypatch.setattr(phrases, "TILES", 3)
    monkeypatch.setattr(phrases, "DENSE", 8)
    rng = np.random.default_rng(3)
    a, b = ((rng.pareto(0.7, 5000) * 2).astype(np.int64) % 300 for _ in range(2))
    codes, counts, place = count_pairs(a, b, 300)
    assert len(set(codes.tolist())) == len(codes)
    assert dict(zip(codes.tolist(), counts.tolist())) == Counter((a * 300 + b).tolist())
    assert (codes[place] == a * 300 + b).all()


# --- hard negatives --------------------------------------------------------------------

def negative_rows(rows, every, positives=5, negatives=10, scale=256):
    usable = [(i, lab, [int(np.floor(scale * x)) for x in v]) for i, lab, v in rows
              if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, lab, v in usable:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, other == lab) for j, other, w in usable if j != i]
        for score, positive, _ in sorted(s for s in scored if s[2])[:positives]:
            fit = sorted((s, j) for s, j, same in scored if not same and 30 * -score <= 100 * -s <= 90 * -score)
            out += [(i, positive, rank, j, -score, -s) for rank, (s, j) in enumerate(fit[:negatives], 1)]
    return sorted(out)


VECTORS = "vec_id long, embedding array<float>, label int"


def vectors_of(count, dims=6, seed=4, ties=False):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(7, dims))
    rows = []
    for i in range(count):
        v = centres[i % 7] + rng.normal(size=dims) * 0.4
        rows.append((i, [float(np.float32(round(x) if ties else x)) for x in v], int(rng.integers(0, 4))))
    return rows


@pytest.mark.parametrize("ties", [False, True])
def test_hard_negatives(spark, monkeypatch, ties):
    monkeypatch.setattr(hard_negatives, "QUERY_ROWS", 7)
    rows = vectors_of(600, ties=ties)
    rows += [(600, None, 1), (610, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (620, [float("nan")] * 6, 1), (630, [float("inf")] * 6, 2),
             (None, [1.0] * 6, 1), (640, [1.0] * 6, None), (650, [0.0] * 6, 3)]
    df = spark.createDataFrame(rows, VECTORS).withColumns({n: F.lit("x") for n in ("id", "score", "rank", "v", "window")}).repartition(5)
    got = sorted(tuple(r) for r in mine_negatives(df, every=10, shard_rows=50).collect())
    assert got == negative_rows([(i, lab, v) for i, v, lab in rows], 10)


def test_hard_negatives_of_odd_tables(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert mine_negatives(empty).count() == 0
    alone = spark.createDataFrame([(0, [1.0, 2.0], 1)], VECTORS)
    assert mine_negatives(alone).count() == 0
    short = spark.createDataFrame([(0, [1.0, 2.0, 0.5], 1), (1, [1.0, 2.0], 1), (2, [0.5, 1.0], 0), (3, [0.5], 0)], VECTORS)
    padded = [(0, 1, [1.0, 2.0, 0.5]), (1, 1, [1.0, 2.0, 0.0]), (2, 0, [0.5, 1.0, 0.0]), (3, 0, [0.5, 0.0, 0.0])]
    got = sorted(tuple(r) for r in mine_negatives(short).collect())
    assert got == negative_rows(padded, 100) and got
    same = spark.createDataFrame([(0, [1.0, 1.0], 1)] * 3 + [(5, [1.0, 1.0], 1)] * 2 + [(6, [0.5, 0.5], 2)] * 200, VECTORS)
    found = mine_negatives(same).collect()
    # Both copies of row 5 are positives, with ten copies of row 6 each.
    assert len(found) == 20 and {(r.positive_id, r.negative_id) for r in found} == {(5, 6)}


def test_cover_tree():
    rng = np.random.default_rng(1)
    vectors = np.concatenate([rng.integers(-50, 50, (700, 5)), np.tile([[3, 3, 3, 3, 3]], (300, 1))])
    order, nodes = cover_tree(vectors)
    assert sorted(order.tolist()) == list(range(1000))
    points = hard_negatives.augmented(vectors)[order]
    for node in nodes:
        own = points[node["begin"]:node["end"]]
        assert np.sqrt(((own - points[node["centre"]]) ** 2).sum(axis=1)).max() <= node["radius"] + 1e-9
        if node["children"]:
            parts = nodes[node["children"]:node["last"]]
            assert parts["begin"].tolist() == [node["begin"], *parts["end"][:-1].tolist()] and parts["end"][-1] == node["end"]


# --- repeated passages -----------------------------------------------------------------

def repeat_rows(docs, length=50):
    texts = [(i, (t or "").encode()) for i, t in docs]
    first = {}
    for i, data in texts:
        for s in range(len(data) - length + 1):
            w = data[s:s + length]
            if i is not None and (w not in first or i < first[w]):
                first[w] = i
    out = []
    for i, data in texts:
        gone = np.zeros(len(data) + 1, bool)
        for s in range(len(data) - length + 1):
            if i is not None and first[data[s:s + length]] < i:
                gone[s:s + length] = True
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-1]])[:len(data)]).sum()) if data else 0
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((i, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages(seed=7):
    rng = random.Random(seed)

    def some(size):
        return "".join(rng.choice("abé 漢\n") for _ in range(size))

    shared = [some(n) for n in (49, 50, 51, 60, 200, 400)]
    docs = []
    for i in range(60):
        parts = [some(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 3)):
            text = rng.choice(shared)
            at = rng.randint(0, max(0, len(text) - 40))
            parts += [text[at:], some(rng.choice([0, 1, 30]))]
        docs.append((rng.randint(0, 40), "".join(parts)))
    docs += [(i, shared[5]) for i in range(100, 130)]  # whole copies
    docs += [(200, "x" * 49), (201, "x" * 49), (202, "x" * 50), (203, "x" * 51), (204, "x" * 300), (205, "xy" * 90), (206, "yx" * 70)]
    docs += [(None, shared[4]), (None, shared[4]), (300, None), (301, ""), (7, shared[3]), (7, shared[3])]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("common", [1 << 16, 3])
@pytest.mark.parametrize("block_bytes", [300, 1 << 22])
def test_repeats(documents, clashing, common, block_bytes):
    docs = passages()
    df = clashing(documents(*docs)).repartition(3)
    got = sorted((tuple(r) for r in remove_repeats(df, common=common, block_bytes=block_bytes).collect()), key=str)
    assert got == repeat_rows(docs)


def test_anchors_do_not_depend_on_the_step(monkeypatch):
    """Every window has one anchor, at the same gram wherever the windows are cut."""
    texts = [(t or "").encode() for _, t in passages()]
    block = repeats._Block(np.array([(i, True) for i in range(len(texts))], repeats._DOC).tobytes(),
                           np.array([len(t) for t in texts], "<i8").tobytes(), b"".join(texts))

    def windows():
        return sorted((int(s) + n, int(s) + int(lead), int(d)) for _, s, count, lead, d in zip(*block.all_anchors(50, 16)) for n in range(count))

    whole = windows()
    assert len(whole) == sum(max(0, len(t) - 49) for t in texts) == len({w for w, _, _ in whole})
    monkeypatch.setattr(repeats, "STEP", 97)
    assert windows() == whole


def test_repeats_of_other_lengths(documents):
    docs = passages(8)
    got = sorted((tuple(r) for r in remove_repeats(documents(*docs), length=29, gram=11).collect()), key=str)
    assert got == repeat_rows(docs, 29)
    with pytest.raises(ValueError):
        remove_repeats(documents(), length=20, gram=4)


def test_repeats_of_odd_tables(documents):
    assert remove_repeats(documents()).count() == 0
    page = "".join(random.Random(2).choices("abcdefgh ", k=400_000))
    got = {r.doc_id: r for r in remove_repeats(documents((2, page), (1, page[1000:300_000]), (3, "a" * 200_000), (4, "a" * 60))).collect()}
    assert got[1].n_removed == 0 and got[2].n_removed == 299_000 and got[2].n_spans == 1 and got[3].n_removed == 0
    assert got[2].kept_sha256 == hashlib.sha256((page[:1000] + page[300_000:]).encode()).hexdigest()
    assert got[4].n_removed == 60


def test_digit_passes_end_at_the_threshold():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    data[1000:1200] = data[3000:3200]
    words = np.ndarray((len(data) + 248,), ">u8", data.tobytes() + bytes(256), 0, (1,))
    starts, docs = np.arange(3900), rng.integers(0, 50, 3900)
    group = np.arange(3900) % 2
    want = {}
    for s in starts:
        w = (group[s], data[s:s + 20].tobytes())
        want[w] = min(want.get(w, 99), docs[s])
    got = first_documents(words, group, starts, docs, 20)
    assert got.tolist() == [want[group[s], data[s:s + 20].tobytes()] for s in starts]
