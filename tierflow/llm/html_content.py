"""Main content of pages by a tree-structured graphical model.

Every block element is a binary variable, content or not. Its features give a potential,
and each parent and child share one: the model is a tree, so one pass of sum-product
messages from the leaves to the root and one back give exact marginals. The weights are
fitted to labelled pages by the gradient of their likelihood, which needs the same
marginals.

Labelled pages are pages whose own markup says what is content (``article``, ``main`` and
the like). So that the model does not depend on these elements alone, each is also shown
in other dress: with named ``div`` elements in their place, and with further boilerplate
around and inside the article.
"""

from __future__ import annotations

import math
import random
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tierflow.llm.common import arrow_batch, slices, texts_of
from tierflow.llm.html_tree import LEAF_BLOCKS, Block, read_blocks, shown

#: Pages used for fitting at most, and the longest of them: a bounded sample of labelled rows.
TRAINING_PAGES = 240
TRAINING_CHARS = 40_000

# Words in class, id and role attributes that tell something; each is a feature of its own.
WORDS = (
    "ad ads advert advertisement sponsor sponsored promo banner nav navbar navigation menu breadcrumb breadcrumbs header "
    "masthead logo footer foot copyright sidebar side aside widget related recommended cookie consent notice alert popup "
    "modal overlay newsletter subscribe signup form search login share social comment comments respond reply discussion "
    "disqus meta byline tags pagination pager toolbar article content main post entry body story text"
).split()
_WORD = re.compile(r"[a-z]+")
_KNOWN = frozenset(WORDS)
_TEXT_END = (".", "!", "?", "…", ":", ";", '"', "”", "»")

Model = dict


def features(blocks: list[Block]) -> list[list[str]]:
    """The features of every block."""
    own = [shown([t for _, t, _ in b.texts]) for b in blocks]
    size = [len(t) for t in own]
    linked = [sum(len(t.strip()) for _, t, link in b.texts if link) for b in blocks]
    below, linked_below = size[:], linked[:]
    for i in range(len(blocks) - 1, 0, -1):
        below[blocks[i].parent] += below[i]
        linked_below[blocks[i].parent] += linked_below[i]
    whole = max(1, below[0])
    out = []
    for i, block in enumerate(blocks):
        named = [block.tag]
        found = ["tag=" + block.tag, "bias"]
        for word in set(_WORD.findall(block.marks.lower())):
            stem = word[:-1] if word.endswith("s") and word[:-1] in _KNOWN else word
            if stem in _KNOWN:
                found.append("mark=" + stem)
                named.append(stem)
        found.append(f"size={min(6, size[i].bit_length() // 2)}")
        found.append(f"share={min(4, 5 * below[i] // whole)}")
        if below[i]:
            found.append(f"links={min(3, 4 * linked_below[i] // below[i])}")
        if size[i]:
            found.append("ended" if own[i].endswith(_TEXT_END) else "open")
            if "©" in own[i]:
                found.append("sign")
        out.append(found)
    return out


def _kind(block: Block) -> int:
    return 1 if block.tag in LEAF_BLOCKS else 0


def _add(a: float, b: float) -> float:
    """log(exp(a) + exp(b))"""
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


def marginals(blocks: list[Block], scores: list[float], edges) -> tuple[list[float], list]:
    """P(content) of every block, and the joint probabilities with its parent.

    ``scores``: log-odds of the node potentials; ``edges[kind][parent][child]``: log potentials.
    """
    n = len(blocks)
    no, yes = [0.0] * n, list(scores)  # node and all messages from below
    up_no, up_yes = [0.0] * n, [0.0] * n  # message to the parent being 0 or 1
    for i in range(n - 1, 0, -1):
        e, p = edges[_kind(blocks[i])], blocks[i].parent
        up_no[i] = _add(no[i] + e[0][0], yes[i] + e[0][1])
        up_yes[i] = _add(no[i] + e[1][0], yes[i] + e[1][1])
        no[p] += up_no[i]
        yes[p] += up_yes[i]
    total_no, total_yes = no[:], yes[:]  # with the message from above
    joint: list = [None] * n
    for i in range(1, n):
        e, p = edges[_kind(blocks[i])], blocks[i].parent
        above_no, above_yes = total_no[p] - up_no[i], total_yes[p] - up_yes[i]
        total_no[i] += _add(above_no + e[0][0], above_yes + e[1][0])
        total_yes[i] += _add(above_no + e[0][1], above_yes + e[1][1])
        cells = [above_no + e[0][0] + no[i], above_no + e[0][1] + yes[i], above_yes + e[1][0] + no[i], above_yes + e[1][1] + yes[i]]
        most = max(cells)
        cells = [math.exp(c - most) for c in cells]
        norm = sum(cells)
        joint[i] = [c / norm for c in cells]
    chance = []
    for a, b in zip(total_no, total_yes):
        chance.append(1 / (1 + math.exp(min(700.0, a - b))))
    return chance, joint


def fit(pages: list[tuple[list[Block], list[int]]], rounds: int = 5, rate: float = 0.3, decay: float = 1e-4) -> Model:
    """Weights that make the labels of the pages likely (adaptive gradient steps, page by page)."""
    weights: dict = {}
    edges = [[[0.0, 0.0], [0.0, 0.0]] for _ in range(2)]
    squares: dict = {}

    def step(key, gradient):
        squares[key] = squares.get(key, 1e-6) + gradient * gradient
        return rate * gradient / math.sqrt(squares[key])

    described = [(blocks, features(blocks), labels) for blocks, labels in pages]
    order = random.Random(7)
    for _ in range(rounds):
        order.shuffle(described)
        for blocks, told, labels in described:
            scores = [sum(weights.get(f, 0.0) for f in found) for found in told]
            chance, joint = marginals(blocks, scores, edges)
            gradient: dict = {}
            pairs: dict = {}
            for i, found in enumerate(told):
                miss = labels[i] - chance[i]
                for f in found:
                    gradient[f] = gradient.get(f, 0.0) + miss
                if i:
                    for cell in range(4):
                        key = _kind(blocks[i]), cell >> 1, cell & 1
                        hit = (labels[blocks[i].parent], labels[i]) == key[1:]
                        pairs[key] = pairs.get(key, 0.0) + hit - joint[i][cell]
            for f, g in gradient.items():
                weights[f] = weights.get(f, 0.0) + step(f, g - decay * weights.get(f, 0.0))
            for (kind, p, c), g in pairs.items():
                edges[kind][p][c] += step((kind, p, c), g)
    return {"weights": weights, "edges": edges}


def main_text(html: str, model: Model) -> tuple[str, list[float]]:
    """The content blocks' texts, joined by an empty line, and the marginals of all blocks."""
    blocks = read_blocks(html)
    weights = model["weights"]
    chance, _ = marginals(blocks, [sum(weights.get(f, 0.0) for f in found) for found in features(blocks)], model["edges"])
    runs: dict[int, list[str]] = {}
    for block, p in zip(blocks, chance):
        if p > 0.5:
            for run, text, _ in block.texts:
                runs.setdefault(run, []).append(text)
    return "\n\n".join(filter(None, map(shown, (runs[r] for r in sorted(runs))))), chance


CONTENT_TAGS, CONTENT_ROLES = ("article", "main"), ("main", "articleBody")
OTHER_TAGS = ("nav", "aside", "footer", "form", "button", "select", "textarea", "dialog")
OTHER_MARKS = frozenset(WORDS[:WORDS.index("article")])


def labelled(html: str) -> tuple[list[Block], list[int]] | None:
    """A page with the labels that its own markup gives, or None if it names no content."""
    blocks = read_blocks(html)
    labels = [0]
    for block in blocks[1:]:
        marks = block.marks.split()
        words = {w for m in marks for w in _WORD.findall(m.lower())}
        if block.tag in OTHER_TAGS or words & OTHER_MARKS:
            labels.append(0)
        elif block.tag in CONTENT_TAGS or any(r in marks for r in CONTENT_ROLES) or "content" in words:
            labels.append(1)
        else:
            labels.append(labels[block.parent])
    return (blocks, labels) if any(labels) else None


# Boilerplate that may surround an article, and what may stand inside or right behind it. {0} to {3} are lines of text.
AROUND = (
    '<header class="site-header"><div class="logo"><a href="/">{1}</a></div><p>{0}</p></header>',
    '<div id="header"><h2>{1}</h2><p class="tagline">{2}</p></div>', '<header><h1><a href="/">{1}</a></h1></header>',
    '<div class="menu"><ul><li><a href="#">{1}</a></li><li><a href="#">{2}</a></li></ul></div>',
    '<div class="navbar"><a href="#">{1}</a> <a href="#">{2}</a></div>', '<ol class="breadcrumb"><li><a href="#">{1}</a></li><li>{2}</li></ol>',
    '<aside><h3>{1}</h3><p>{0}</p><ul><li><a href="#">{2}</a></li></ul></aside>',
    '<div class="sidebar"><h3>{1}</h3><p>{0}</p></div>', '<div id="side-widget"><p>{0}</p><a href="#">{1}</a></div>',
    '<div class="cookie-consent"><p>{0}</p><button>{1}</button></div>', '<div role="alert" class="notice">{0}</div>',
    '<div class="cookie-banner">{0} <a href="#">{1}</a></div>', '<div class="popup modal"><p>{0}</p></div>',
    '<form action="/s"><label>{1}</label><input name="q"><button>{2}</button></form>', '<form class="newsletter"><p>{0}</p><input><button>{1}</button></form>',
    '<form><p>{0}</p><label>{1}<select><option>{2}</option></select></label><textarea>{3}</textarea></form>',
    '<div class="advertisement"><p>{0}</p></div>', '<div class="ads">{0}</div>', '<div class="sponsored promo"><p>{0}</p><p>{3}</p></div>',
    '<section class="related"><h3>{1}</h3><ul><li><a href="#">{2}</a></li><li><a href="#">{3}</a></li></ul></section>',
    '<section class="comments"><h3>{1}</h3><div class="comment"><p>{0}</p></div><div class="comment"><p>{3}</p></div></section>',
    '<div id="comments"><ol><li><p>{0}</p></li><li><p>{3}</p></li></ol></div>', '<div class="comment-list"><article class="comment"><p>{0}</p></article></div>',
    '<div class="footer"><p>{0}</p><p>&copy; {1}</p></div>', '<div id="footer">&copy; {1} <a href="#">{2}</a></div>', '<footer><p>{0}</p></footer>',
)
INSIDE = (
    '<div class="ad">{0}</div>', '<aside class="related"><p>{0}</p></aside>', '<div class="share-social"><a href="#">{1}</a> <a href="#">{2}</a></div>',
    '<aside><p>{0}</p></aside>', '<form class="subscribe"><p>{0}</p><input><button>{1}</button></form>', '<nav><a href="#">{1}</a></nav>',
    '<section class="comments"><h2>{1}</h2><p>{0}</p><p>{3}</p></section>', '<div class="newsletter-signup"><p>{0}</p></div>',
    '<footer><p>{0}</p></footer>', '<div class="comments"><div class="comment"><p>{0}</p></div></div>',
)
ARTICLES = ("article", "main", 'div class="content"', 'div class="article-body"', 'div id="main-content"', 'div class="post-content"', 'section class="story content"')


def dressed(html: str, seed: int) -> list[str]:
    """The page itself and variants of it; the article's markup and the boilerplate differ."""
    found = re.search(r"<(article|main)\b[^>]*>(.*?)</\1>", html, re.S | re.I)
    out = [html]
    if not found:
        return out
    rng = random.Random(seed)
    inner = found[2]
    words = shown([re.sub(r"<[^>]*>", " ", inner)]).split() or ["text"]

    def line(longest):
        start = rng.randrange(len(words))
        return " ".join(words[start:start + rng.randint(1, longest)]).replace("<", " ").replace("&", " ")

    def piece(form):
        return form.format(line(40), line(3), line(4), line(25))

    for _ in range(3):
        paragraphs = re.split(r"(?=<p\b)", inner)
        for form in rng.sample(INSIDE, rng.randint(0, 3)):
            paragraphs.insert(rng.randint(1, len(paragraphs)), "</b></p>" + piece(form))
        parts = "".join(paragraphs)
        extra = rng.choice(("", f"<ul><li>{line(12)}</li><li>{line(9)}</li></ul>", f"<h2>{line(5)}</h2><p>{line(30)}</p>",
                            f"<blockquote><p>{line(30)}</p></blockquote>", f"<div><p>{line(30)}</p></div>",
                            f"<table><tr><td>{line(4)}</td><td>{line(4)}</td></tr></table>", f"<section><h3>{line(4)}</h3><p>{line(20)}</p></section>"))
        tag = rng.choice(ARTICLES)
        before = "".join(map(piece, rng.sample(AROUND, rng.randint(1, 4))))
        after = "".join(map(piece, rng.sample(AROUND, rng.randint(1, 4))))
        wrapped = f"<{tag}>{parts}</b></p>{extra}</{tag.split()[0]}>"
        if rng.random() < 0.4:
            outer = rng.choice(("div", 'div class="wrapper"', 'div id="page"', "section"))
            wrapped = f"<{outer}>{wrapped}</{outer.split()[0]}>"
        out.append(f"<html><body>{before}{wrapped}{after}</body></html>")
    return out


SAMPLE = ("<html><body><nav><ul><li><a href='/'>Home</a></li></ul></nav><article><h1>A title</h1><p>The first paragraph of the text, "
          "which is long enough to be read.</p><p>A second one follows here, with more words in it.</p></article><footer>&copy; Someone</footer></body></html>")


def learn_content(pages: DataFrame, key: str = "page_id", html: str = "html", most: int = TRAINING_PAGES) -> Model:
    """Fit the model to up to ``most`` pages with telling markup, chosen by a hash of key and html.

    Without such pages a built-in page is dressed up instead.
    """
    tagged = pages.select(F.xxhash64(pages[key].cast("string"), pages[html]).alias("lot"), pages[html].alias("html")).filter(
        F.col("html").rlike("(?i)<(article|main)\\b") & (F.length("html") <= TRAINING_CHARS))
    # The numbers alone are ranked; only the chosen pages themselves come to the driver, each once.
    last = tagged.select("lot").distinct().orderBy("lot").limit(most).agg(F.max("lot")).first()[0]
    chosen = tagged.filter(F.col("lot") <= F.lit(last).cast("long")).dropDuplicates(["lot"])
    sample = [row.html for row in chosen.orderBy("lot").limit(most).collect()]
    shown_pages = [page for i, html_ in enumerate([SAMPLE] * 5 + sample) for page in dressed(html_, i)]
    return fit([p for p in map(labelled, shown_pages) if p])


SCHEMA = "page_id long, url string, text string, n_chars long, certainty double"
_OUT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()), ("certainty", pa.float64())])


def extract_content(pages: DataFrame, model: Model, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row, without a shuffle; certainty is the least |2p - 1| of its blocks.

    Null, empty and text-free pages have the empty text. Broken markup is read as far as it
    goes. Rows may repeat; other columns are not read.
    """
    def run(batches):
        for part in slices(batches):
            rows = []
            for page, address, html_ in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts_of(part.column(2))):
                text, chance = main_text(html_, model)
                rows.append((page, address, text, len(text), min(abs(2 * p - 1) for p in chance)))
            yield arrow_batch(_OUT, *zip(*rows))

    return pages.select(pages[key].cast("long").alias("page_id"), pages[url].cast("string").alias("url"), pages[html].alias("html")).mapInArrow(run, SCHEMA)
