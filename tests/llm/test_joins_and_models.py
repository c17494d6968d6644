"""Duplicates, mixing, search, extraction and scoring: against brute force and planted cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierflow.llm import bloom, html_content, lm, mixing, near_dup, topk
from tierflow.llm.components import components
from tierflow.llm.exact_dedup import exact_dedup
from tierflow.llm.html_tree import read_blocks, shown
from tierflow.llm.shingles import shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sentence(rng, count):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(count))


def test_exact_groups(documents, clashing, rows):
    df = clashing(documents((3, "a b\n"), (1, "ab"), (2, " a  b "), (9, "A b"), (4, None), (5, " \t"), (5, " \t"), (None, "ab"),
                            (7, "x" * 300_000), (8, "é\x1c"), (10, "é")))
    got = rows(exact_dedup(df), "doc_id", "keep_id", "group_size", "kept")
    same = [(1, 2, 4, False), (2, 2, 4, True), (3, 2, 4, False), (None, 2, 4, False)]
    for row in same + [(9, 9, 1, True), (4, 5, 3, False), (5, 5, 3, True), (5, 5, 3, False), (7, 7, 1, True), (8, 8, 1, True), (10, 10, 1, True)]:
        assert row in got
    assert len(got) == 11
    digests = {r.doc_id: r.text_sha256 for r in exact_dedup(df).collect()}
    assert digests[3] == hashlib.sha256(b"ab").hexdigest() and digests[4] == hashlib.sha256(b"").hexdigest()
    assert exact_dedup(documents()).count() == 0


def test_exact_groups_with_a_filter_that_is_too_small(documents):
    """A saturated filter sends rows to the shuffle and loses nothing."""
    texts = [(i, f"text {i % 700}") for i in range(1000)]
    got = exact_dedup(documents(*texts), max_bits=1).collect()
    assert sum(r.kept for r in got) == 700
    assert all(r.keep_id == r.doc_id % 700 and r.group_size == (2 if r.keep_id < 300 else 1) for r in got)


def test_bloom_filters(spark):
    hashes = spark.range(0, 4000, 1, 6).select(F.xxhash64(F.col("id") % 3000).alias("h"))
    bits = bloom.filter_bits(4000)
    seen, again = bloom.build(hashes, bits)
    told = bloom.probed(hashes.withColumn("x", F.lit(1)), "h", again, bits, "twice").groupBy("h").agg(F.count("*").alias("n"), F.max("twice").alias("t"))
    assert told.filter("n > 1 AND NOT t").count() == 0
    assert told.filter("n = 1 AND t").count() < 100
    assert all(r.seen for r in bloom.probed(hashes, "h", seen, bits, "seen").collect())


def brute_components(texts):
    """n_shingles and component of each key, from the definition."""
    sets = {}
    for key, text in texts:
        words = WORD.findall(lower(text))
        sets[key] = {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {k: (len(sets[k]), find(k)) for k in keys}


@pytest.mark.parametrize("rounds", [0, 2])
def test_near_duplicates(documents, clashing, rounds):
    rng = random.Random(rounds)
    texts, key = [], 0
    passage = sentence(rng, 60)
    for _ in range(12):
        base = sentence(rng, rng.choice((7, 30, 80, 200))).split()
        for _ in range(rng.randint(1, 7)):
            own = base[:]
            for _ in range(rng.randint(0, max(1, len(own) // 25))):
                own[rng.randrange(len(own))] = "new" + str(rng.randrange(99))
            texts.append((key, " ".join(own) if rng.random() < 0.8 else " ".join(own).upper() + "\n"))
            key += 1
    # A chain of overlapping windows, a passage in many documents, copies, few words, none.
    line = sentence(rng, 150).split()
    texts += [(100 + i, " ".join(line[4 * i:4 * i + 110])) for i in range(9)]
    texts += [(200 + i, sentence(rng, 40) + " " + passage + " " + sentence(rng, 40)) for i in range(12)]
    texts += [(300 + i, texts[0][1]) for i in range(5)]
    texts += [(400, "one two"), (401, "ONE two"), (402, "one"), (403, ""), (404, None), (405, " \n"), (406, "two one")]
    rng.shuffle(texts)
    got = near_dup.near_duplicates(clashing(documents(*texts)), rounds=rounds).collect()
    expected = brute_components(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected
    assert len({c for _, c in expected.values()}) < len(texts) - 15


def test_near_duplicates_of_odd_tables(documents):
    long = sentence(random.Random(1), 30_000)
    got = near_dup.near_duplicates(documents((2, long), (1, long + " end"), (5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (None, None)))
    found = Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect())
    assert found[(2, 29_996, 1)] == 1 and found[(1, 29_997, 1)] == 1 and found[(5, 2, 5)] == 2
    assert found[(None, 2, 5)] == 1 and found[(None, 0, None)] == 1
    assert near_dup.near_duplicates(documents()).count() == 0


def test_divide_skip():
    rng = random.Random(6)
    for _ in range(400):
        lists = [sorted(rng.sample(range(20), rng.randint(0, 12))) for _ in range(rng.randint(1, 9))]
        counts, least = Counter(x for own in lists for x in own), rng.randint(1, 7)
        assert near_dup.divide_skip(lists, least) == {k: c for k, c in counts.items() if c >= least}


def test_shingle_counts_in_pieces(monkeypatch):
    text = sentence(random.Random(3), 3000)
    whole = shingle_sets([text.encode(), b"a b", b""])
    monkeypatch.setattr("tierflow.llm.shingles.AT_ONCE", 64)
    pieces = shingle_sets([text.encode(), b"a b", b""])
    assert [len(s) for s in whole] == [2996, 1, 0]
    assert all((a == b).all() for a, b in zip(whole, pieces))


def test_components(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(0, 40)] + [(1000, 1000 + i) for i in range(1, 300)] + [
        (rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(150)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if any(x in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_mix(documents, clashing):
    rng = random.Random(2)
    docs = [(i, sentence(rng, rng.randint(1, 60)), None, rng.choices(("a", "B", "é", "z", None), (60, 3, 20, 10, 7))[0]) for i in range(600)]
    docs += [(700, None, None, "a"), (701, "", None, "empty"), (5, docs[5][1], None, docs[5][3]), (None, "one two", None, "a")]
    got = mixing.mix_sources(clashing(documents(*docs))).collect()
    assert len(got) == len(docs)
    size = defaultdict(int)
    for _, text, _, source in docs:
        size[source] += len(WORD.findall(text or ""))
    order = sorted(size, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    level, full = 0.0, set()
    while True:
        rest = sum(size.values()) - sum(3 * size[s] for s in full)
        level = rest / sum(weight[s] for s in order if s not in full)
        over = {s for s in order if s not in full and weight[s] * level >= 3 * size[s]}
        if not over:
            break
        full |= over
    target = {s: 3.0 * size[s] if s in full else weight[s] * level for s in order}
    taken = defaultdict(int)
    by_size = {v: s for s, v in size.items()}
    for row in got:
        source = by_size[row.source_size]
        assert row.target == pytest.approx(target[source]) and row.taken in {row.size * n for n in range(4)}
        taken[source] += row.taken
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    for source in order:
        assert abs(taken[source] - target[source]) <= 5
    again = mixing.mix_sources(documents(*docs)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.size, r.taken)
    assert sorted(map(key, again)) == sorted(map(key, got))
    assert mixing.mix_sources(documents()).count() == 0
    assert [r.taken for r in mixing.mix_sources(documents((1, None), (2, ""))).collect()] == [0, 0]


def test_top_k(spark, rows):
    rng = np.random.default_rng(4)
    vectors = [(i, [float(x) for x in rng.normal(0, 0.1, 8)], "q") for i in range(230)]
    vectors += [(300, [0.5] * 8, "q"), (301, [0.5] * 8, "q"), (302, [0.5] * 8, "q"), (303, None, "q"), (304, [float("nan")] * 8, "q"),
                (305, [None] * 8, "q"), (306, [float("inf")] + [0.0] * 7, "q"), (None, [1.0] * 8, "q"), (307, [1.0], "q"), (308, [], "q"), (301, [0.5] * 8, "q")]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, score string")
    usable = [(k, np.floor(64 * np.pad(np.array(v, np.float32).astype(float), (0, 8 - len(v))))) for k, v, _ in vectors
              if k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    expected = []
    for key, own in usable:
        if key % 20 == 0:
            found = sorted((-int(own @ other), k) for k, other in usable if k != key)[:20]
            expected += [(key, i + 1, k, -s) for i, (s, k) in enumerate(found)]
    for size in (4096, 16):
        assert rows(topk.top_k(df, shard_rows=size, query_rows=size)) == sorted(expected, key=lambda t: tuple((False, str(v)) for v in t))
    assert topk.top_k(df.limit(0)).count() == 0
    assert rows(topk.top_k(df.filter("vec_id in (20, 21)"))) == [r for r in [(20, 1, 21, int(dict(usable)[20] @ dict(usable)[21]))]]


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>if (a<b) "<p>no</p>"</script></head><body>
<header class="site-header"><h1>Site name</h1></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="cookie-consent"><p>We use cookies here.</p></div>
<article><h1>The title</h1><p>First &amp; <b>bold</b>&nbsp;words,
 over lines.<p>Second paragraph without an end tag.<div class="ad"><p>Buy now, it is cheap.</p></div><p>Third &#233;nd.</p></article>
<section class="comments"><h3>Comments</h3><div class="comment"><p>I liked this one a lot.</p></div></section>
<aside class="sidebar"><p>Other things to read.</p></aside><form class="newsletter"><p>Sign up here.</p><button>Go</button></form><footer>&copy; Someone</footer>"""


@pytest.fixture(scope="module")
def model(spark):
    return html_content.learn_content(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def test_main_text_of_a_page(model):
    text, _ = html_content.main_text(PAGE, model)
    assert text == "The title\n\nFirst & bold words, over lines.\n\nSecond paragraph without an end tag.\n\nThird énd."


def test_main_text_of_all_pages(spark, model):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for row in html_content.extract_content(pages, model).join(pages.select("page_id", "html"), "page_id").collect():
        inner = row.html[row.html.index("<article>"):].split("</article>")[0]
        blocks = re.split(r"</?(?:article|p|h1)>", inner)
        expected = "\n\n".join(filter(None, (shown([re.sub(r"<[^>]*>", " " if "br" in b else "", b)]) for b in blocks)))
        assert re.sub(r" +", " ", row.text) == re.sub(r" +", " ", expected) and row.n_chars == len(row.text)


def test_unseen_dress(spark, model):
    """Held-out pages in other markup: block decisions against the labels that the markup gives."""
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").filter("page_id % 9 = 4").limit(150).collect()]
    right = total = 0
    for i, html in enumerate(pages):
        for blocks, labels in filter(None, map(html_content.labelled, html_content.dressed(html, 10_000 + i))):
            scores = [sum(model["weights"].get(f, 0.0) for f in found) for found in html_content.features(blocks)]
            chance, _ = html_content.marginals(blocks, scores, model["edges"])
            hits = [(p > 0.5) == bool(label) for b, p, label in zip(blocks, chance, labels) if b.texts]
            right, total = right + sum(hits), total + len(hits)
    assert total > 5000 and right >= 0.99 * total


def test_marginals_by_enumeration(model):
    blocks = read_blocks("<div>a<p>b</p><ul><li>c<li>d</ul></div><p>e")
    rng = random.Random(3)
    scores, edges = [rng.uniform(-2, 2) for _ in blocks], [[[rng.uniform(-1, 1) for _ in "ab"] for _ in "ab"] for _ in "ab"]
    weights = defaultdict(float)
    for state in range(1 << len(blocks)):
        y = [state >> i & 1 for i in range(len(blocks))]
        energy = sum(s for s, on in zip(scores, y) if on) + sum(
            edges[html_content._kind(b)][y[b.parent]][y[i]] for i, b in enumerate(blocks) if i)
        for i, on in enumerate(y):
            weights[i, on] += math.exp(energy)
    chance, _ = html_content.marginals(blocks, scores, edges)
    assert chance == pytest.approx([weights[i, 1] / (weights[i, 0] + weights[i, 1]) for i in range(len(blocks))])


def test_broken_pages(spark, model):
    odd = [None, "", "plain text", "<p>cut <!-- off", "<![foo bar]]><p>x", "<a <b> <c", "\0\x01<div", "</p></p>", "<p a='>", "<" * 5000,
           "<div>" * 3000 + "deep", "<article><p>" + "word " * 50_000]
    frame = spark.createDataFrame([(i, "u", h, "x") for i, h in enumerate([*odd, PAGE, PAGE])] + [(None, None, PAGE, "x")],
                                  "page_id long, url string, html string, text string")
    got = html_content.extract_content(frame, model).collect()
    assert len(got) == len(odd) + 3 and all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got[:2]] == ["", ""] and len({r.text for r in got[-3:]}) == 1
    assert html_content.extract_content(frame.limit(0), model).count() == 0
    assert html_content.learn_content(frame.limit(0))["weights"]


def test_language_model(spark, documents, clashing, monkeypatch):
    rng = random.Random(1)
    lines = ["the cat sat on the mat", "A dog\tran off", "le chat noir é"]
    texts = [(i, " ".join(rng.choice(lines) for _ in range(40)) + f" rare{i}") for i in range(60)] + [
        (1, "the cat"), (1, "the cat"), (2, None), (3, ""), (None, "The CAT unknown1 unknown1"), (4, "word " * 30_000)]
    # With few held tokens most counts come from the join.
    monkeypatch.setattr(lm, "HELD", 8)
    got = lm.score_documents(clashing(documents(*texts))).collect()
    held = {k: zlib.crc32(str("" if k is None else k).encode()) % 5 == 1 for k, _ in texts}
    words = [(k, WORD.findall(lower(t)) + ["\0"]) for k, t in texts]
    counts = Counter(w for k, own in words if not held[k] for w in own)
    n, v = sum(counts.values()), len(counts)
    expected = Counter((k, held[k], len(own), sum(counts[w] > 0 for w in own), n,
                        round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own), 6)) for k, own in words)
    assert Counter((*tuple(r)[:5], round(r.base_score, 6)) for r in got) == expected
    assert sum(r.score for r in got) > sum(r.base_score for r in got) + 100
    assert lm.score_documents(documents()).count() == 0
    only_held = [(k, "some text") for k in range(50) if zlib.crc32(str(k).encode()) % 5 == 1]
    for row in lm.score_documents(documents(*only_held)).collect():
        assert (row.n_known, row.train_tokens) == (0, 0) and math.isfinite(row.score)


def test_language_model_is_normalised():
    chances = np.where(np.arange(lm.CLASSES) < 7, 0.14, 0.02 / (lm.CLASSES - 7))
    model = lm.LogBilinear.start(chances)
    trainer = lm.Trainer(model, chances, 1)
    rng = np.random.default_rng(2)
    before = rng.integers(0, 5, 30_000)
    for low in range(0, len(before), 256):
        b = before[low:low + 256]
        trainer.step(b, b, (b * 3 + 1) % 7)
    score = lm.Scorer(trainer.model())
    every = np.arange(lm.CLASSES)
    for b in range(3):
        one = np.full(lm.CLASSES, b)
        got = score(one, one, every)
        assert (10 ** got).sum() == pytest.approx(1, abs=1e-3)
        assert got[(b * 3 + 1) % 7] > -0.4  # from -0.85 by chance
