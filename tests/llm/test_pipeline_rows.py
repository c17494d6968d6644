"""The whole pipeline against its stages in plain Python, on a small table."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import public_tokenizers as P
import tiktoken

import corpus_pipeline
from tierflow.llm import bpe

EN = "the cat and the dog were in the house of the old man with that hat".split()
DE = "der hund und die katze sind in dem haus und der mann ist nicht da".split()
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def key_order(key):
    return key is None, key or 0


def exact(rows):
    best = {}
    for row in rows:
        text, order = "".join(WORD.findall(row[1] or "")), (-len(row[1] or ""), key_order(row[0]))
        if text not in best or order < best[text][0]:
            best[text] = order, row
    return [row for _, row in best.values()]


def near(rows):
    sets = []
    for row in rows:
        words = WORD.findall(row[1].lower())
        sets.append({tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))})
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                group = [group[b] if g == group[a] else g for g in group]
    least = {}
    for g, row in zip(group, rows):
        order = (key_order(row[0]), hashlib.sha256(row[1].encode()).hexdigest())
        least[g] = min(least.get(g, (order, row)), (order, row), key=lambda x: x[0])
    return [row for _, row in least.values()]


def number(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) / 2**32


def mixed(rows):
    sources = defaultdict(list)
    for row in rows:
        sources[row[3]].append((-len(WORD.findall(row[1])), hashlib.md5(f"mix:{'' if row[0] is None else row[0]}".encode()).hexdigest(), row))
    names = sorted(sources, key=lambda s: (s is None, s or ""))
    size = {s: -sum(x[0] for x in sources[s]) for s in names}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full = set()
    while True:
        level = (sum(size.values()) - sum(3 * size[s] for s in full)) / sum(weight[s] for s in names if s not in full)
        over = {s for s in names if 3 * size[s] <= weight[s] * level} - full
        if not over:
            break
        full |= over
    out = []
    for s in names:
        docs = sorted(sources[s], key=lambda x: x[:2])
        target = min(3.0 * size[s], weight[s] * level)
        whole, phase = math.floor(target / size[s]), number("mix:" + ("1" if s is None else "0" + s))
        part = target / size[s] - whole
        more = [math.floor((i + 1) * part + phase) > math.floor(i * part + phase) for i in range(len(docs))]
        for _ in range(3):
            off = target - sum(-d[0] * (whole + m) for d, m in zip(docs, more))
            left, at = min((abs(off - (d[0] if m else -d[0])), i) for i, (d, m) in enumerate(zip(docs, more)))
            if left < abs(off) and whole < 3:
                more[at] = not more[at]
        out += [d[2] for d, m in zip(docs, more) for _ in range(whole + m)]
    return out


def test_pipeline_row_by_row(spark, documents, tmp_path):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.sample((EN if i % 2 else DE) * 4, 26 + i % 7)), "en" if i % 2 else "de", f"s{i % 3}") for i in range(40)]
    fresh = [" ".join(rng.sample(EN * 4, 30 + i)) for i in range(6)]
    rows += [(None, t, "en", f"s{i % 3}") for i, t in enumerate(fresh[:4])] + [(7, t, "en", "s1") for t in fresh[4:]]
    rows += [(50, rows[3][1], "en", "s0"), (51, rows[3][1] + " ", "en", None), (60, rows[5][1] + " hat", "en", None),
             (None, rows[6][1] + " da", "de", "s0"), (52, None, "en", "s1"), (53, "!!!", None, "s1"), (54, "漢字" * 99, None, "s2")]
    documents(*rows).write.parquet(f"{tmp_path}/documents.parquet")
    known = {w for w in EN + DE}
    kept = [r for r in rows if any(w in known for w in WORD.findall(r[1] or ""))]
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path(corpus_pipeline.RANKS)), special_tokens={})
    expected = Counter((r[0], tuple(library.encode_ordinary(r[1]))) for r in mixed(near(exact(kept))))
    got = Counter((r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == expected and sum(c for (k, _), c in expected.items() if k is None) > 1
