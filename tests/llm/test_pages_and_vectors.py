"""Pages and vectors against hand-made expectations and brute force."""

import numpy as np
import pytest

from garimpo.llm import ann, extraction, vector_dedup

PAGES = {
    "marked": (
        '<html><head><title>t</title><style>p{}</style></head><body><nav><ul><li><a href="/a">Home</a></li></ul></nav>'
        '<div class="ad">Buy now</div><article><h1>Title &amp; more</h1><p>One <b>bo</b>ld\n line<p>Two&nbsp;&lt;b&gt;'
        '<div class="share-box">Share</div><br>Three</article><section id="comments"><p>Nice!</p></section><footer>f</footer>',
        "Title & more One bold line Two <b> Three",
    ),
    "unmarked": (
        '<body><div id="menu">Home About</div><div><p>' + "Long text of the page. " * 8 + "</p><p>Its end.</p></div>"
        '<aside>Other</aside><form>Name <input></form><div class="cookie-notice">We use cookies</div></body>',
        ("Long text of the page. " * 8).strip() + " Its end.",
    ),
    "unclosed": ("<div class=ad>Advert<article><p>Body text", "Body text"),
    "script": ("<article>a<script>if (1 < 2) { x = '</p>' }</script>b</article>", "ab"),
    "plain": ("just some words", "just some words"),
    "empty": ("", ""),
    "only markup": ("<nav><a>x</a></nav><!-- c -->", ""),
    "broken": ("<p <b>>text</p> < 3 <", None),
    "long": ("<article><p>" + "word " * 60_000 + "</p></article>", ("word " * 60_000).strip()),
    "null": (None, ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    page, expected = PAGES[name]
    got = extraction.main_text(page)
    assert got == expected if expected is not None else isinstance(got, str)


def test_pages_as_a_frame(spark):
    rows = [(i, f"u{i}" if i % 2 else None, page, "x") for i, (page, _) in enumerate(PAGES.values())] * 2 + [(None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extraction.extract(pages).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    assert extraction.extract(pages.limit(0)).count() == 0


BODY = "Long text of the page. " * 8
WHOLE = {
    "wrapper": (
        f'<div class="page has-sidebar"><div class="menu">Home</div><div class="elementor-widget"><p>{BODY}</p><p>Its end.</p></div></div>',
        BODY + "Its end.",
    ),
    "long line": (
        f'<div><p>{BODY * 40}</p></div><nav>a<br>b<br>c<br>d</nav><div><p>{BODY}</p></div><nav>a<br>b<br>c<br>d</nav><p>Foot</p>',
        BODY * 41,
    ),
    "open inline": (f'<div><p class="notice"><b>Note<p>{BODY}<p>Its end.</div>', BODY + "Its end."),
    "responses": (f'<main><p>Short text.</p><div id="comments"><p>{BODY}</p></div></main>', "Short text."),
    "comment articles": (
        f'<article><p>{BODY}</p></article><div id="comments"><article class="comment-body"><p>First!</p></article></div>'
        '<section id="comments"><article><p>Second!</p></article></section><article class="comment odd"><p>Third!</p></article>',
        BODY,
    ),
    "comments in the article": (f'<article><p>{BODY}</p><article class="comment"><p>{BODY * 2}</p></article></article>', BODY),
    "cards set apart": (
        f'<main><p>{BODY}</p></main><aside><article><h2>Card</h2><p>{BODY}</p></article></aside>'
        f'<footer><article><p>{BODY}</p></article></footer>',
        BODY,
    ),
    "body beside a card": (
        f'<div class="content"><p>{BODY}</p><p>{BODY}</p></div><section><article><a href="/x">Read this</a></article></section>',
        BODY * 2,
    ),
    "unclosed menu": (f'<div id="menu">Home<div>News</div><article><p>{BODY}</p></article>', BODY),
    "closed menu with a card": (
        f'<div id="menu"><div>Home</div><article><p>Card</p></article></div><div><p>{BODY}</p></div>', BODY,
    ),
    "short article beside an advert": (f'<div class="ad">{BODY}</div><article><h1>Title</h1><p>Few words.</p></article>', "Title Few words."),
}


@pytest.mark.parametrize("name", WHOLE)
def test_whole_text_of_unlike_pages(name):
    page, expected = WHOLE[name]
    assert extraction.main_text(page) == expected.strip()


def plain_stretches(lengths):
    """By definition: the sum of three lines from each line on; where it leaves zero, and where it is zero again."""
    sums = [sum(lengths[i : i + extraction.BLOCK]) for i in range(len(lengths))]
    out, start = [], None
    for i, x in enumerate([*sums, 0]):
        if x and start is None:
            start = i
        if not x and start is not None:
            out.append((start, i, max(sums[start:i])))
            start = None
    return out


def test_stretches_are_the_plain_distribution():
    rng = np.random.default_rng(8)
    for _ in range(300):
        n = int(rng.integers(0, 60))
        lengths = np.where(rng.random(n) < rng.random(), rng.integers(1, 200, n), 0)
        found = extraction.stretches(lengths)
        assert found == plain_stretches(lengths.tolist())
        text = sorted(x for x in lengths.tolist() if x >= extraction.TEXT_LINE)
        middling = extraction.BLOCK * text[(len(text) - 1) // 2] if text else float("inf")
        least = extraction.SURGE * min(max((t for *_, t in found), default=0), middling)
        assert extraction.surging(lengths) == [x for x in found if x[2] >= least]


def test_few_candidates_over_several_lengths(spark):
    """With fewer candidates than asked for, all of them come, whatever their lengths."""
    rng = np.random.default_rng(9)
    rows = [(i, (rng.normal(size=8) * 10.0 ** rng.integers(-6, 6)).astype("f4").tolist()) for i in range(17)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.search(df, df, 20).collect()
    assert {(r["query_id"], r["vec_id"]) for r in got} == {(i, j) for i in range(17) for j in range(17) if i != j}


VECTORS = "vec_id long, embedding array<float>, label int, node long, score double, e string"


def vectors(n=300, dim=24):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=dim).astype("f4").tolist(), int(rng.integers(3))) for i in range(n)]
    for i in range(n, n + 80):  # near copies, in chains
        base = np.array(rows[int(rng.integers(len(rows)))][1])
        rows.append((i, (base + rng.normal(size=dim) * rng.choice([0.02, 0.09])).astype("f4").tolist(), int(rng.integers(2))))
    rows += [(n + 80 + i, rows[0][1], rows[0][2]) for i in range(5)]
    return rows


ODD = [
    (900, None, 1), (901, [0.0] * 24, 1), (902, [1.0] * 23 + [None], 1), (903, [1.0] * 23 + [float("nan")], 1), (904, [float("inf")] * 24, 1),
    (905, [1.0] * 24, None), (906, [1.0] * 24, 1), (None, [1.0] * 24, 1), (906, [2.0] * 24, 1), (907, [1.0, 0.5], 1), (908, [1.0, 0.5], 1), (909, [], 1),
]


@pytest.fixture(params=["ordinary", "odd", "empty"], scope="module")
def table(request, spark):
    rows = {"ordinary": vectors(), "odd": [*vectors(40), *ODD], "empty": []}[request.param]
    return rows, spark.createDataFrame([(*r, 1, 0.5, "x") for r in rows], VECTORS).repartition(3)


def fine(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)


def cosine(a, b):
    a, b = np.array(a, float), np.array(b, float)
    return a @ b / (np.linalg.norm(a) * np.linalg.norm(b))


@pytest.mark.parametrize("part", [4096, 7])
def test_near_vectors(table, part, monkeypatch):
    rows, df = table
    monkeypatch.setattr(vector_dedup, "PART", part)
    got = vector_dedup.near_duplicates(df).collect()
    links = {i: set() for i in range(len(rows))}
    for i, (_, v, label) in enumerate(rows):
        for j in range(i):
            if fine(v) and fine(rows[j][1]) and label is not None and label == rows[j][2] and len(v) == len(rows[j][1]) and cosine(v, rows[j][1]) >= 0.98:
                links[i].add(j)
                links[j].add(i)
    expected = []
    for i, (vec_id, *_) in enumerate(rows):
        group, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - group:
                group.add(j)
                todo.append(j)
        low = min((rows[j][0] for j in group if rows[j][0] is not None), default=None)
        expected.append((vec_id, len(links[i]), low, vec_id == low))
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_neighbours(table):
    rows, df = table
    got = ann.search(df, df.where("vec_id % 20 = 0"), 10).collect()
    dim = 24
    known = [(i, v) for i, v, _ in rows if fine(v) and len(v) == dim]
    found = total = 0
    for vec_id, v in known:
        if vec_id is None or vec_id % 20:
            continue
        mine = sorted((r for r in got if r["query_id"] == vec_id), key=lambda r: r["rank"])
        best = sorted(((-float(np.dot(np.array(v, float), np.array(w, float))), i) for i, w in known if i != vec_id), key=lambda x: (x[0], x[1] is None, x[1]))[:10]
        assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1))
        assert all(r["vec_id"] != vec_id for r in mine)
        assert [r["score"] for r in mine] == sorted((r["score"] for r in mine), reverse=True)
        found += sum(r["score"] >= -best[-1][0] - 1e-9 for r in mine)
        total += len(best)
    assert found >= 0.9 * total and (total > 0 or not rows)


def test_small_leaves_and_rounds_reach_the_recall(spark, monkeypatch):
    """With leaves far smaller than the table the graph comes from the rounds and the search."""
    monkeypatch.setattr(ann, "LEAF", 40)
    monkeypatch.setattr(ann, "CELL", 200)
    rng = np.random.default_rng(9)
    data = rng.normal(size=(900, 12)).astype("f4")
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<float>")
    got = ann.search(df, df.where("vec_id % 20 = 0"), 10).collect()
    hits = 0
    for q in range(0, 900, 20):
        near = data.astype(float) @ data[q].astype(float)
        near[q] = -np.inf
        hits += len(set(np.argsort(-near)[:10].tolist()) & {r["vec_id"] for r in got if r["query_id"] == q})
    assert hits >= 0.9 * 450


@pytest.mark.parametrize("spread", ["one long", "powers of ten"])
def test_recall_with_lengths_far_apart(spark, spread, monkeypatch):
    monkeypatch.setattr(ann, "LEAF", 60)
    monkeypatch.setattr(ann, "CELL", 300)
    rng = np.random.default_rng(4)
    data = rng.normal(size=(1200, 16))
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    if spread == "one long":
        data[7] *= 1e4
    else:
        data *= 10 ** rng.uniform(-5, 1, (1200, 1))
    data = data.astype("f4")
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<float>")
    got = ann.search(df, df.where("vec_id % 40 = 0"), 10).collect()
    hits = 0
    for q in range(0, 1200, 40):
        near = data.astype(float) @ data[q].astype(float)
        near[q] = -np.inf
        hits += len(set(np.argsort(-near)[:10].tolist()) & {r["vec_id"] for r in got if r["query_id"] == q})
    assert hits >= 0.9 * 300


def test_places_within_the_radius_meet():
    """Two places within the radius meet: one of them probes the home cell of the other."""
    rng = np.random.default_rng(1)
    places = rng.normal(size=(200, 2)) * 0.3
    homes, probes = {}, {}
    for rows, cell, home in vector_dedup.reach(places, 0.15, 0.05):
        for r, c in zip(rows.tolist(), map(tuple, cell.tolist()), strict=True):
            (homes if home.any() else probes).setdefault(r, set()).add(c)
    for i in range(200):
        for j in range(i):
            if np.linalg.norm(places[i] - places[j]) <= 0.05:
                assert homes[i] == homes[j] or homes[i] & probes.get(j, set()) or homes[j] & probes.get(i, set())
