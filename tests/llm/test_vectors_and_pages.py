"""Embeddings and pages against plain Python and held-out layouts."""

import random

import numpy as np
import pytest

from tidegate.llm import dom, html_text, projection_forest


def test_projection_forest(spark):
    rnd = np.random.default_rng(1)
    centres = rnd.standard_normal((60, 16))
    rows = []
    for k in range(600):
        v = centres[k % 60] + (rnd.standard_normal(16) * 0.1 if k % 3 else 0)
        rows.append((k, [float(np.float32(x)) for x in v], k % 2))
    rows += [(600 + k, rows[7][1], 1) for k in range(40)]  # copies
    rows += [(700, None, 1), (701, [0.0] * 16, 1), (702, [float("nan")] * 16, 1), (703, [None] * 16, 1), (704, [], 1), (705, rows[7][1], None)]
    rows += [(706, rows[7][1][:8], 1), (None, rows[7][1], 1), (7, rows[7][1], 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, rid string")
    usable = {i: np.array(r[1], dtype=np.float32).astype(float) for i, r in enumerate(rows) if r[2] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])}
    links, group = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in usable.items():
        for j, b in usable.items():
            if i < j and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= 0.98:
                links[i] += 1
                links[j] += 1
                group[find(j)] = find(i)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    expected = []
    for i, r in enumerate(rows):
        c = least.get(find(i)) if i in usable else r[0]
        expected.append((r[0], links[i], c, r[0] is not None and r[0] == c))
    got = projection_forest.near_duplicates(df, leaf=24)
    assert sum(links) > 1000 and sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)
    assert projection_forest.near_duplicates(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def trees():
    return html_text.trained(150)


def test_held_out_layouts(trees):
    layout = html_text.Layout(99)
    main = kept = boiler = extra = 0
    for _ in range(100):
        html = layout.page()
        text = "".join(t for _, _, t in dom.Page(html).segments)
        got = html_text.texts_of([html], trees)[0]
        main, boiler = main + sum(c.isupper() for c in text), boiler + sum(c.islower() for c in text)
        kept, extra = kept + sum(c.isupper() for c in got), extra + sum(c.islower() for c in got)
    assert kept > 0.95 * main and extra < 0.03 * boiler


def test_choices_agree():
    rnd = random.Random(2)
    for _ in range(100):
        parent = [-1, *(rnd.randrange(k) for k in range(1, 9))]
        score = np.array([rnd.uniform(-2, 2) for _ in parent])
        keep = html_text.chosen(parent, score)
        assert all(keep[parent[k]] or not keep[k] for k in range(1, 9))
        best = max(
            sum(score[k] for k in range(9) if bits >> k & 1)
            for bits in range(1, 512, 2)
            if all(bits >> parent[k] & 1 or not bits >> k & 1 for k in range(1, 9))
        )
        assert score[keep].sum() == pytest.approx(best)


def test_pages(spark, trees):
    long = "Slow words in a row, and more of them. " * 20
    article = f"<html><body><nav><ul><li><a href=/a>One<li><a href=/b>Two</ul></nav><article><h1>Title &amp; all</h1><p>First\n  <b>bold</b> caf&eacute;.<p>{long}</article><div class=ad>Buy it now</div><footer>&copy; us"
    rows = [(1, "u", article, "x"), (1, "u", article, "x"), (2, None, None, "x"), (3, "u", "", "x"), (None, "u", "<<p <>&#0;", "x"), (4, "u", "<script>" + "a" * 10000, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = [tuple(r) for r in html_text.main_texts(df, trees).collect()]
    text = f"Title & all\n\nFirst bold café.\n\n{long.strip()}"
    assert got.count((1, "u", text, len(text))) == 2 and (2, None, "", 0) in got and (3, "u", "", 0) in got and (4, "u", "", 0) in got
    assert html_text.main_texts(df.limit(0), trees).count() == 0


def test_a_page_without_article_or_role_words():
    """Written by hand, with class names that say nothing."""
    notes = ["Release notes", "The new version reads files twice as fast, as measured on our own machines with the usual mix of small and large files."]
    notes += ["Long names are kept whole, also where the file system allows only short ones.", "Broken files are told apart from empty ones."]
    blocks = f"""<body><div id=x1><div class=q><a href=/a>Products</a><a href=/b>Prices</a><a href=/c>Log in</a></div><div class=z><h1>{notes[0]}</h1><div>{notes[1]}</div>
<ul><li>{notes[2]}</li><li>{notes[3]}</li></ul></div><div class=k><form action=/s><input name=q><button>Search</button> Subscribe to our letter</form></div>
<div class=c><b>anna</b> wrote: Great, thanks! <b>bob</b> wrote: me too <a href=/r>Reply</a> <a href=/r>Report</a></div></div></body>"""
    assert html_text.texts_of([blocks], html_text.trained()) == ["\n\n".join(notes)]


def test_a_very_long_page(trees):
    paragraphs = ["word " * 400 + f"number {k}." for k in range(700)]
    html = "<body><nav><a href=/>Home</a></nav><article>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</article></body>"
    assert len(html) > 1_000_000 and html_text.texts_of([html], trees) == ["\n\n".join(paragraphs)]
