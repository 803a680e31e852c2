from __future__ import annotations

import pytest

from tillmetrics.llm import html_wrapper as H

PAGES = "page_id long, url string, html string"


def text(source):
    return H.Page(source).text(set())


CASES = {
    "": "",
    "just  text": "just text",
    "<p>a<p>b<br>c": "a\nb c",
    "<ul><li>1<li>2 <b>3</b></ul>": "1\n2 3",
    "<article><h1>T&amp;t</h1><p><b>x<br><p>y&nbsp;&eacute; z</article><footer>f</footer>": "T&t\nx\ny é z",
    "<p>1 < 2 &am</p><!-- <p>no -->": "1 < 2 &am",
    "<div class='cookie-notice'>n</div><main><header>H</header><p>a</p><form>q</form></main>x": "H\na",
    "<header>site</header><p>a</p><div class='Ad box'>n</div><div id=comments><article>c</article></div>": "a",
    "<nav><ul><li>m</ul></nav><p>a<script>var t='</p>';</script></p><style>p{}</style>": "a",
    "<aside>s</aside><div role=dialog>d</div><p title='a>b'>a</p><p hidden>h</p>": "a",
    "<table><tr><td>a<td>b<tr><td>c</table>": "a\nb\nc",
    "<p>a</p><div class='download'>kept</div>": "a\nkept",
    "<p>x</p><div class='story'><div class='story-header'><h1>t</h1></div><p>a</div><div class=ad-header>n</div>": "t\na",
    "<article><p>cut o": "cut o",
    "<p unclosed": "",
    "<script>never ends": "",
}


@pytest.mark.parametrize("source", CASES)
def test_text_of_a_page(source):
    assert text(source) == CASES[source]


@pytest.mark.parametrize(
    "around",
    [
        "<body class='right-sidebar'>{}",
        "<body class='no-sidebar comments-open'>{}",
        "<body class='has-header' id=header>{}",
        "<html class=widget><body class=sidebar>{}",
        "<div class='elementor-widget-container'>{}</div>",
        "<div class='widget'><div class='header'>{}</div></div>",
        "<header>{}</header>",
    ],
)
def test_names_of_a_layout_empty_no_article(around):
    articles = ["<article class='post category-notices'><p>a</article>", "<main class=sidebar>a</main>"]
    for article in articles:
        assert text(around.format(article)) == "a"
    if "<body" in around or "elementor" in around:
        assert text(around.format("<p>a")) == "a"
    assert text("<article>a</article><div class=widget><article>t</article></div>") == "a"
    assert text("<article>a</article><article class=comment>c</article>") == "a"


def test_matching_keeps_order_and_ancestry():
    seed, page = H.Page("<div><p>a<ul><li>b</ul><h2>c</h2></div>"), H.Page("<div><h3>n</h3><p>a<h2>c</h2><ul><li>x</ul></div>")
    paired = H.align(page.shape(), seed.shape())
    assert len(paired) == 5  # page, div, p and either ul with li, or h2
    for node, partner in paired.items():
        assert page.labels[node] == seed.labels[partner]
        if node:
            assert paired[page.parents[node]] == seed.parents[partner]
    order = sorted(paired)
    assert [paired[n] for n in order] == sorted(paired.values())
    assert H.align(seed.shape(), seed.shape()) == {i: i for i in range(len(seed.labels))}


def page(i, body):
    return f"<body><div class=top>Welcome to the site</div><div class=body>{body}</div><span>all rights</span>"


def test_constant_nodes_become_template(spark):
    rows = [(i, "http://A.example:80/x", page(i, f"<p>story {i}")) for i in range(5)]
    rows += [(10, "http://b.example/", page(10, "<p>alone"))]
    rows += [(20 + i, "http://c.example/", page(0, "<p>the same")) for i in range(5)]
    found = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert [found[i] for i in range(5)] == [f"story {i}" for i in range(5)]
    assert found[10] == "Welcome to the site\nalone\nall rights"  # nothing to compare it with
    assert {found[20 + i] for i in range(5)} == {"Welcome to the site\nthe same\nall rights"}


OTHER_NAMES = "copyright promotion promo related search share social toolbar login newsletter modal".split()


@pytest.mark.parametrize("name", OTHER_NAMES)
def test_other_names_say_nothing(name):
    for attribute in ("id", "class"):
        assert text(f"<div {attribute}={name}><h1>Search of graphs</h1><p>long text</div>") == "Search of graphs\nlong text"


def test_wrapper_decides_what_other_names_hold(spark):
    body = "<div class=related><p>Read more here</div><div class=promotion><p>story {}</div>".format
    rows = [(i, "http://a.example/", body(i)) for i in range(H.FEW + 2)]
    found = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert found == {i: f"story {i}" for i in range(H.FEW + 2)}


def test_template_inside_an_article_needs_many_pages(spark):
    body = "<article><div>Share this</div><p>story {}</article>".format
    rows = [(i, "http://wide.example/", body(i)) for i in range(H.WIDE)]
    rows += [(100 + i, "http://few.example/", body(i)) for i in range(H.FEW)]
    found = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert found[0] == "story 0" and found[100] == "Share this\nstory 0"


@pytest.mark.parametrize("first", [None, "", "<body><div class=t", "<ul><li>index", "<h1>error</h1>"])
def test_wrapper_of_all_pages(spark, first):
    rows = [(0, "http://a.example/", first)]
    rows += [(10 + i, "http://a.example/", page(i, f"<p>story {i}")) for i in range(6)]
    other = "<table class=list><tr><td>Our shop</table><h2>item {}</h2><p>Call us</p>".format
    rows += [(100 + i, "http://a.example/", other(i)) for i in range(4)]
    found = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert [found[10 + i] for i in range(6)] == [f"story {i}" for i in range(6)]
    assert [found[100 + i] for i in range(4)] == [f"item {i}" for i in range(4)]


def test_pages_without_the_article_change_nothing_in_it(spark):
    body = "<article><div>Share this</div><p>story {}</article>".format
    rows = [(i, "http://wide.example/", body(i)) for i in range(H.WIDE + 3)]
    rows += [(50, "http://wide.example/", "<ul><li>index</ul>"), (51, "http://wide.example/", "")]
    rows += [(100 + i, "http://some.example/", body(i)) for i in range(H.WIDE)]
    rows += [(150, "http://some.example/", "<article><p>story alone</article>")]
    found = {r.page_id: r.text for r in H.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert [found[i] for i in range(H.WIDE + 3)] == [f"story {i}" for i in range(H.WIDE + 3)]
    assert found[100] == "Share this\nstory 0" and found[150] == "story alone"


def test_odd_rows(spark, folder):
    rows = [(1, None, None), (2, "no url", ""), (None, "http://x.example/", "<p>a"), (3, None, "<p>b")]
    rows += [rows[3], (4, "http://x.example/", "<p>" + "long &amp; " * 50_000), (5, None, "<div>" * 3000 + "deep")]
    extra = spark.createDataFrame([(*r, "h", 1) for r in rows], PAGES + ", host string, n_chars int")
    found = H.op3_html_wrapper(spark, folder(pages=extra)).collect()
    assert len(found) == len(rows)
    texts = {(r.page_id, r.text[:9], r.n_chars) for r in found}
    assert texts == {(1, "", 0), (2, "", 0), (None, "a", 1), (3, "b", 1), (4, "long & lo", 349_999), (5, "deep", 4)}
    assert H.op3_html_wrapper(spark, folder(pages=extra.limit(0))).count() == 0


def largest(a, b):
    """Pairs of nodes of the best matching, by the definition; trees are (label, children)."""
    if a[0] != b[0]:
        return 0
    x, y = a[1], b[1]
    rows = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x)):
        for j in range(len(y)):
            rows[i + 1][j + 1] = max(rows[i][j + 1], rows[i + 1][j], rows[i][j] + largest(x[i], y[j]))
    return 1 + rows[-1][-1]


def random_tree(dice, depth):
    count = dice.randrange(5) if depth else 0
    return dice.choice("abc"), [random_tree(dice, depth - 1) for _ in range(count)]


def shape_of(tree):
    lines, waiting = [], [(tree, -1)]
    while waiting:  # nodes in the order they open
        (label, children), parent = waiting.pop()
        lines.append(f"{parent} {label}")
        waiting += [(c, len(lines) - 1) for c in reversed(children)]
    return "\n".join(lines)


def test_alignment_is_a_largest_one(dice):
    for _ in range(300):
        a, b = (("r", [random_tree(dice, 3) for _ in range(3)]) for _ in range(2))
        if dice.random() < 0.5:  # trees that have much in common
            b = ("r", [*a[1], *b[1][:1]][dice.randrange(2) :])
        shapes = [shape_of(t) for t in (a, b)]
        paired = H.align(*shapes)
        assert len(paired) == largest(a, b)
        parents = [[int(x.split()[0]) for x in s.split("\n")] for s in shapes]
        labels = [[x.split()[1] for x in s.split("\n")] for s in shapes]
        assert all(labels[0][x] == labels[1][y] for x, y in paired.items())
        assert all(x == y == 0 or paired[parents[0][x]] == parents[1][y] for x, y in paired.items())
        assert sorted(paired.values()) == [paired[x] for x in sorted(paired)]


def test_long_and_deep_pages_align():
    row = lambda n: "".join("<h2>a</h2><p>b</p>" for _ in range(n))
    seed = H.Page(f"<body><ul><li>x</li></ul>{row(5000)}</body>").shape()
    for source in (f"<body>{row(5000)}</body>", f"<body>{row(1000)}<ol><li>y</li></ol>{row(1500)}</body>"):
        shape = H.Page(source).shape()
        lists = shape.count(" ol") + shape.count(" li")
        assert len(H.align(shape, seed)) == shape.count("\n") + 1 - lists
    deep = "<div>" * 3000
    paired = H.align(H.Page(f"{deep}<p>a").shape(), H.Page(f"{deep}<h1>b").shape())
    assert len(paired) == 3001


def test_workers_need_no_package(tmp_path):
    """The functions that travel bring all they need: a bare interpreter can run them."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    held = tmp_path / "functions"
    held.write_bytes(cloudpickle.dumps([H._trees, H._aligned, H._extract(["page_id"])]))
    code = (
        "import pickle, sys, pyarrow as pa\n"
        "trees, aligned, extract = pickle.load(open(sys.argv[1], 'rb'))\n"
        "assert 'tillmetrics' not in sys.modules\n"
        "page = '<body><nav>m</nav><p>text</p></body>'\n"
        "made = list(trees(iter([pa.RecordBatch.from_pydict({'host': ['h'], 'html': [page]})])))\n"
        "row = made[0].to_pylist()[0]\n"
        "row = {k: row[k] for k in ('host', 'shape', 'nodes', 'hashes', 'articles')} | {'seed': row['shape']}\n"
        "assert list(aligned(iter([pa.RecordBatch.from_pylist([row])])))\n"
        "rows = [{'page_id': 1, 'html': page, 'seed': row['shape'], 'constant': []}]\n"
        "print(list(extract(iter([pa.RecordBatch.from_pylist(rows)])))[0].to_pylist()[0]['text'])\n"
    )
    done = subprocess.run(
        [sys.executable, "-c", code, str(held)], capture_output=True, text=True, cwd=tmp_path, env={}, timeout=60
    )
    assert done.stdout.strip() == "text", done.stderr
