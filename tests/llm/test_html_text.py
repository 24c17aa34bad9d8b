import html
import itertools
import random
import re

import numpy as np

from statuta.llm import html_text as H

from .data import WORDS

TREE = H.trained()


def test_tree_fits_its_table():
    x, y = H.labelled()
    assert len(y) < 300 and all(H.classify(TREE, tuple(r)) == label for r, label in zip(x, y))


def test_named_parts_decide_where_there_are_any():
    """Whatever their shape, blocks in a repeated part or outside the article go, and others in the article stay."""
    shapes = itertools.product((1, 4, 16, 60), (0, 0.35, 1), (0, 5, 40), (0, 0.6, 1), (0, 5, 40), (0, 0.6, 1))
    for row in shapes:
        assert not any(H.classify(TREE, (*row, 1, a)) for a in (-1, 0, 1)) and H.classify(TREE, (*row, 0, 1)) and not H.classify(TREE, (*row, 0, -1))


def plain_page(rng):
    """A page of plain containers, and its main text: menu, perhaps a notice, title, paragraphs with subheadings, related links, footer."""
    out, main = [], []

    def block(words, links, good):
        w = [rng.choice(WORDS) for _ in range(words)]
        k = round(words * links)
        out.append(f"<div>{'<a href=/x>' + ' '.join(w[:k]) + '</a> ' if k else ''}{' '.join(w[k:])}</div>")
        if good:
            main.append(" ".join(w))

    for _ in range(rng.randint(2, 6)):
        block(rng.randint(1, 3), 1, False)
    if rng.random() < 0.4:
        block(rng.randint(7, 12), 0, False)
        block(1, 1, False)
    block(rng.randint(5, 11), 0, True)
    for _ in range(rng.randint(2, 5)):
        block(rng.randint(24, 90), rng.choice([0, 0, 0.1]), True)
        if rng.random() < 0.5:
            block(rng.randint(2, 7), 0, True)
            block(rng.randint(24, 60), 0, True)
    for _ in range(rng.randint(2, 5)):
        block(rng.randint(4, 12), 1, False)
    block(rng.randint(7, 14), 0, False)
    for _ in range(rng.randint(0, 2)):
        block(rng.randint(1, 3), 1, False)
    return "".join(out), main


def test_words_links_and_neighbours_decide_on_plain_pages():
    """Without names of parts the tree finds the main text; flags alone, or a block without its neighbours, do worse."""
    rng = random.Random(5)
    x, y = H.labelled()
    trees = {"all": (TREE, slice(0, 8)), "flags": (H.grow(x[:, 6:], y), slice(6, 8)), "no neighbours": (H.grow(x[:, [0, 1, 6, 7]], y), [0, 1, 6, 7])}
    right, total = dict.fromkeys(trees, 0), 0
    for _ in range(200):
        page, main = plain_page(rng)
        found = H.blocks(page)
        rows = np.array(H.rows_of([(n, m / n, int(p), 0) for _, n, m, p, _ in found]), dtype=float)
        total += len(found)
        for name, (tree, used) in trees.items():
            right[name] += sum(H.classify(tree, tuple(r[used])) == (b[0] in main) for r, b in zip(rows, found))
    share = {k: v / total for k, v in right.items()}
    print("blocks of plain pages judged right:", share)
    assert share["all"] > 0.95 and share["flags"] < 0.7 and share["no neighbours"] < share["all"] - 0.01


def splits(tree):
    return {H.FEATURES[tree.feature]} | splits(tree.low) | splits(tree.high) if tree.feature >= 0 else set()


def test_neighbours_change_verdicts():
    """The same block is main text between paragraphs and none among links; all kinds of features are in use."""
    assert {"words", "link density", "link density before", "words after", "part", "article"} <= splits(TREE) and splits(TREE) & {"link density after", "words before"}
    assert H.classify(TREE, (5, 0, 60, 0, 55, 0, 0, 0)) and not H.classify(TREE, (5, 0, 2, 1, 2, 1, 0, 0))


def test_given_pages(spark):
    """All pages of a given table against their article cut out by patterns."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: (r.text, r.n_chars) for r in H.extract(pages).collect()}
    for r in pages.collect():
        article = r.html[r.html.index("<article>") + 9 : r.html.index("</article>")]
        blocks = (" ".join(html.unescape(re.sub("</?b>", "", p)).split()) for p in re.split(r"</?(?:p|h1|br)[^>]*>", article))
        want = " ".join(b for b in blocks if b)
        assert got[r.page_id] == (want, len(want))


def test_parts_that_go():
    page = """<!DOCTYPE html><html><body class="has-sidebar"><header><h1>Site</h1></header><div id="cookie-notice">We use cookies</div><main><h1>T</h1><p class=intro>Hello <b>wor</b>ld &amp; all&nbsp;x<p>Two
      <div class="comments"><p>nice post</div><aside>rel</aside><form>name <input></form><p>Three <a href="x>y">link</a><ul><li>a<li>b</ul><!-- c --><script>if(a<b){}</script><div class="adBox">buy</div><p hidden>no</p></main><footer>f</footer>"""
    assert H.main_text(page, TREE) == "T Hello world & all x Two Three link a b"


def test_page_without_article():
    body = "<p>" + "A sentence of plain running text that goes on for a while without links. " * 3 + "</p>"
    assert H.main_text(f"<body><ul><li><a>Home</a></li><li><a>News</a></li></ul>{body}{body}</body>", TREE).count("plain running") == 6


def test_awkward(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p></p><br><!-- unended"), (4, "u", "<script>never ends <p>x"), (4, "u", "<script>never ends <p>x"), (5, "u", "<article><p>1 < 2 &copy &unknown; &#x41;</article>"), (None, "u", "<article>" + "<div><p>ord</p>" * 20_000)]
    got = {(r.page_id, r.text, r.n_chars) for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "0 as text")).collect()}
    assert got == {(1, "", 0), (2, "", 0), (3, "", 0), (4, "", 0), (5, "1 < 2 © &unknown; A", 19), (None, " ".join(["ord"] * 20_000), 79_999)}
