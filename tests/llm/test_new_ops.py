"""Main text, hard negatives and phrases against brute force, and their edge cases."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import phrases
from strata.llm.hard_negatives import Tree, hard_negatives
from strata.llm.main_text import extract_main_text, main_text
from strata.llm.phrases import mine_phrases

# ------------------------------------------------------------------ main text
ARTICLE = "<article><h1>Title &amp; more</h1><p>One <b>two</b>three<br>four</p><p>five\n  six&nbsp;seven</article>"


@pytest.mark.parametrize(
    "page, text",
    [
        (ARTICLE, "Title & more One twothree four five six seven"),
        (f"<nav><a href=/>Home</a></nav><div class='ad'>Buy</div>{ARTICLE}<footer>&copy;</footer>", "Title & more One twothree four five six seven"),
        (f"<body class=has-sidebar><div id=page-wrap>{ARTICLE}<div class='comments'>{'<p>long reader words</p>' * 50}</div></div>",
         "Title & more One twothree four five six seven"),
        ("<article>a<script>var t='</p>'</script>b<style>p{}</style><form><p>mail</p></form><aside>x</aside></article>", "ab"),
        ("<article><header><h1>T</h1></header><p>x</p><div role=search>find</div></article><header>Site</header>", "T x"),
        ("<p>one<p>two <i>three<p>four", "one two three four"),
        ("<article><p>open <a title='a>b' href=\"x\">link</a> text<!-- no > text", "open link text"),
        ("<article><ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>d<td>e</table></article>", "a b c d e"),
        ("plain &lt;text&gt; &#x41;&#66;", "plain <text> AB"),
        ("<nav>only a menu</nav><footer>and a footer</footer>", ""),
        ("", ""), (None, ""), ("<", "<"), ("<>&", "<>&"),
    ],
)
def test_main_text(page, text):
    assert main_text(page) == text


def test_main_text_without_an_article_element():
    words = "many words of a real paragraph, so that it is dense text."
    links = "".join(f"<li><a href=/{i}>Link {i}</a>" for i in range(9))
    page = (
        f"<body><div class=header><h1>Site</h1></div><div><ul>{links}</ul></div><h1>Head</h1><div id=content><p>{words}</p><p><b>{words}<br>"
        f"<p>{words}</div><div class='notice cookie-consent'><p>{words * 9}</p></div><div id=comments><p>{words * 30}</div></body>"
    )
    assert main_text(page) == f"Head {words} {words} {words}"


def test_main_text_of_long_and_deep_pages():
    paragraph = "<p>some text " + "x" * 80 + "</p>"
    long = f"<body><article>{paragraph * 40_000}</article></body>"  # 4 MB
    assert main_text(long).count("some text") == 40_000
    assert main_text("<div>" * 50_000 + "deep" + "</div>" * 50_000) == "deep"
    assert main_text("<b><p>" * 20_000 + "x") == "x"


def test_main_text_table(spark):
    rows = [(1, "u", ARTICLE, "a", 9), (1, "u", ARTICLE, "a", 9), (None, None, None, "b", 9), (2, "v", "", "c", 9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = extract_main_text(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    want = "Title & more One twothree four five six seven"
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "u", want, len(want))] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=str)
    assert extract_main_text(pages.limit(0)).count() == 0


# -------------------------------------------------------------- hard negatives
def brute_negatives(rows, is_anchor, positives=5, negatives=10):
    good = {(i, y, tuple(int(np.floor(256 * x)) for x in v)) for i, v, y in rows
            if i is not None and y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for i, y, v in good:
        if not is_anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, z) for j, z, w in good if j != i and len(w) == len(v)]
        for s, j, _ in sorted((s, j, z) for s, j, z in scored if z == y)[:positives]:
            allowed = sorted((t, k) for t, k, z in scored if z != y and 30 * -s <= 100 * -t <= 90 * -s)
            out += [(i, j, r + 1, k, -s, -t) for r, (t, k) in enumerate(allowed[:negatives])]
    return sorted(out)


def vectors(spark, rows):
    wide = [(i, None if v is None else [None if x is None else float(x) for x in v], y, 1, 2, "x") for i, v, y in rows]
    return spark.createDataFrame(wide, "vec_id long, embedding array<double>, label int, rank int, leaf long, score string")


@pytest.mark.parametrize("settings", [{}, {"fit_rows": 60, "fanout": 4, "leaf_rows": 4, "block": 25}])
def test_hard_negatives_equal_brute_force(spark, settings):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(6, 8)) / 3
    rows = [(k, centers[k % 6] + rng.normal(size=8) * rng.choice([0.02, 0.2, 1]), int(rng.integers(0, 4))) for k in range(500)]
    hot = rows[7][1]
    rows += [(1000 + k, hot, k % 4) for k in range(200)]  # one vector holds much of the table
    rows += [rows[0], rows[0], (100, rows[9][1], 1)]  # repeated rows, and an id with two vectors
    rows += [(2000, None, 1), (2100, [0.1] * 7 + [None], 1), (2200, [float("nan")] * 8, 1), (2300, [float("inf")] * 8, 1), (2400, hot, None),
             (None, hot, 1), (2500, [0.5, 0.25], 1), (2600, [0.5, 0.5], 1), (2700, [0.25, 0.25], 2), (2800, [0.0] * 8, 3), (2900, [], 1)]
    got = hard_negatives(vectors(spark, rows), F.col("vec_id") % 20 == 0, **settings)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute_negatives(rows, lambda i: i % 20 == 0)
    assert len(want) > 1000 and sorted(map(tuple, got.collect())) == want


def test_hard_negatives_edge_tables(spark):
    empty = vectors(spark, [(1, [0.1], 1)]).limit(0)
    assert hard_negatives(empty, F.lit(True)).count() == 0
    assert hard_negatives(vectors(spark, [(0, None, 1)]), F.lit(True)).count() == 0
    few = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.0], 2), (3, [0.5, 9.0], 2), (4, [-1.0, 0.0], 2)]
    got = hard_negatives(vectors(spark, few), F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2, 65536, 32768), (0, 1, 2, 3, 65536, 32768)]
    large = [(0, [1e5] * 4, 1), (1, [1e5] * 4, 1), (2, [5e4] * 4, 2), (3, [1e300] * 4, 1)]
    got = hard_negatives(vectors(spark, large), F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2, 4 * 25_600_000**2, 2 * 25_600_000**2)]


def test_tree_passes_subtrees_by_and_misses_none():
    rng = np.random.default_rng(5)
    rows = (rng.normal(size=(20, 16)) * 200)[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 16)) * 10
    rows = np.floor(rows)
    tree = Tree.fit(rows[:800], fanout=6, leaf_rows=30)
    leaf, ranges = tree.leaves(rows), {}
    tree.ranges(rows, leaf, ranges)
    tree.measured([(*k, *v) for k, v in ranges.items()])
    anchors = rows[::50]
    scores = anchors @ rows.T
    hi = scores.max(1, keepdims=True) * 0.9
    lo = hi * 0.9
    seen = np.zeros((len(anchors), len(tree.path)), bool)
    for number, mine in tree.visits(anchors, lo, hi):
        seen[mine, number] = True
    inside = (scores >= lo) & (scores <= hi)
    i, j = np.nonzero(inside)
    assert len(i) and seen[i, leaf[j]].all()
    assert seen[:, np.unique(leaf)].mean() < 0.7


# -------------------------------------------------------------------- phrases
def brute_phrases(rows, max_words=3, min_count=10, top=2000, share=50):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, max_words + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= min_count}
    around = Counter()
    for (lang, p), a in candidates.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                around[lang, p[i : i + k]] = max(around[lang, p[i : i + k]], a)
    out = []
    for lang in {x for x, _ in candidates}:
        mine = []
        for (own, p), a in candidates.items():
            if own == lang and not ((own, p) in around and 100 * around[own, p] >= share * a):
                score, _, l, r = min((10**6 * a * a // (f[own, p[:c]] * f[own, p[c:]]), c, f[own, p[:c]], f[own, p[c:]]) for c in range(1, len(p)))
                mine.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(mine)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(t, lang, 1, 2, "x") for t, lang in rows], "text string, lang string, n int, a long, phrase string")


def noisy(seed, n=400):
    rng = np.random.default_rng(seed)
    words = ["the", "The", "of", "été", "É", "zu", "x-y", "ß", "😀", "a'b"] + [f"w{i}" for i in range(40)]
    weight = 1 / np.arange(1, len(words) + 1)
    seps = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", "\x0b"]
    out = []
    for _ in range(n):
        picked = rng.choice(words, rng.integers(0, 60), p=weight / weight.sum())
        out.append(("".join(w + rng.choice(seps) for w in picked), rng.choice(["en", "de", None, "und"], p=[0.6, 0.2, 0.1, 0.1])))
    return out + [(None, "en"), ("", None), (" .,; ", "xx"), ("once only here", "yy"), ("the of the " * 200, "en"), ("the " * 3000, "en")] + [out[0]] * 5


@pytest.mark.parametrize("settings", [{}, {"budget": 40, "chunk_bytes": 2000}, {"budget": 7, "top": 15, "min_count": 3}, {"max_words": 4, "budget": 100, "share": 80}])
def test_phrases_equal_brute_force(spark, settings):
    rows = [(t, None if lang is None else str(lang)) for t, lang in noisy(1)]
    got = mine_phrases(table(spark, rows), **settings)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    reference = {k: v for k, v in settings.items() if k in ("max_words", "min_count", "top", "share")}
    want = brute_phrases(rows, **reference)
    assert len(want) > 30 and sorted(map(tuple, got.collect())) == want


def test_phrases_edge_tables(spark):
    assert mine_phrases(table(spark, [("a", "b")]).limit(0)).count() == 0
    assert mine_phrases(table(spark, [(None, None), ("", "x"), ("a b c", "x")])).count() == 0
    same = mine_phrases(table(spark, [("p q", None)] * 10)).collect()
    assert [tuple(r) for r in same] == [("und", 1, "p q", 10, 10, 10, 20, 1_000_000)]


def test_long_texts_are_cut_at_piece_breaks_only():
    text = b"a b c. d e f\ng h i " * 200_000  # 3.8 MB
    parts = list(phrases.slices(text, 1 << 16))
    assert b"".join(parts) == text and max(map(len, parts)) <= 1 << 16 and all(p[-1:] in b".\n" for p in parts[:-1])
    assert list(phrases.slices(b"x " * 50 + b"." + b"y " * 50, 10)) == [b"x " * 50 + b".", b"y " * 50]


def test_scores_beyond_64_bits(spark):
    counts = spark.createDataFrame([([1], 3 * 10**12), ([2], 5 * 10**12), ([1, 2], 2 * 10**12)], "phrase array<long>, f long")
    vocabulary = spark.createDataFrame([("x", "p", 3 * 10**12, 1), ("x", "q", 5 * 10**12, 2)], "lang string, word string, f long, id long")
    sizes = spark.createDataFrame([("x", 9 * 10**13)], "lang string, n long")
    row = phrases._ranked(counts, vocabulary, sizes, 10, 50).first()
    assert tuple(row) == ("x", 1, "p q", 2 * 10**12, 3 * 10**12, 5 * 10**12, 9 * 10**13, 10**6 * 4 // 15)
