from __future__ import annotations

import html
import re

import numpy as np

from tidemark.llm import html_text
from tidemark.llm.queries import QUERIES


def text_of(page):
    return html_text.read_page(page)[0]


def test_structure():
    page = (
        '<html><head><title>t</title></head><body><header><h1>Site</h1></header><nav><p>menu</nav><div id="comments"><p>hi</p></div>'
        '<main><article><header><h1>T &amp; x</h1></header><p>A&lt;b&gt; <a href="x>y">l</a>k<p>two<aside>no</aside>three&nbsp;\n four'
        '<div class="ad">buy</div><!-- <p>c</p> --><script>if(a<b)"</p>"</script><table><tr><td>c1<td>c2</table><form>f</form>'
        '<section class="reader-comments"><p>nope</section></article></main><footer>f</footer><p>out</body>'
    )
    assert text_of(page) == "T & x\n\nA<b> lk\n\ntwo\n\nthree four\n\nc1\n\nc2"


def test_odd_pages():
    assert html_text.read_page(None) == (None, []) and html_text.read_page("") == (None, [])
    assert text_of("<article><p>open <b>bold<p>next") == "open bold\n\nnext"
    assert text_of("<article><p>a<!-- never closed <p>b") == "a"
    assert text_of("<main>x<br>y<hr>z</main>") == "x y\n\nz"
    assert text_of("<article><script>never closed <p>b") is None
    assert text_of("<article>1 < 2 and <3</article>") == "1 < 2 and <3"
    assert html_text.read_page("plain &eacute; text") == (None, [(False, "plain é text")])


def brute_repeated(streams, pages, run):
    seen = {}
    for s, p in zip(streams, pages):
        for i in range(len(s) - run + 1):
            seen.setdefault(tuple(s[i : i + run]), set()).add(p)
    out = []
    for s in streams:
        marks = np.zeros(len(s), dtype=bool)
        for i in range(len(s) - run + 1):
            if len(seen[tuple(s[i : i + run])]) > 1:
                marks[i : i + run] = True
        out.append(marks.tolist())
    return out


def test_suffix_array_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(30):
        streams = [[str(t) for t in rng.integers(0, 3, rng.integers(0, 40))] for _ in range(6)]
        pages = [1, 2, 3, 3, None, 5]
        for run in (2, 4, 8):
            assert [m.tolist() for m in html_text.repeated(streams, pages, run)] == brute_repeated(streams, pages, run)


def test_pages_without_article(spark):
    menu = "Home About Contact Terms Privacy Help Jobs Press News"
    rows = [(i, f"http://a.example/{i}", f"<body><div>{menu}</div><div>own text {i} of this page</div></body>") for i in range(5)]
    rows += [(9, None, None), (9, None, None), (None, "http://b.example", "<article>x</article>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS host", "2 AS text")
    found = sorted(((r.page_id, r.text) for r in html_text.extract(pages).collect()), key=repr)
    assert found == sorted([(i, f"own text {i} of this page") for i in range(5)] + [(9, ""), (9, ""), (None, "x")], key=repr)
    assert html_text.extract(pages.limit(0)).count() == 0


def test_runs_count_over_all_shards_of_a_host(spark, monkeypatch):
    monkeypatch.setattr(html_text, "SHARD", 1)
    notice = "please note that our office stays closed on monday and on friday"
    story = "one long story that two addresses of this host show word by word"
    rows = [(i, f"http://a.example/{i}", f"<div>{notice if i in (3, 17) else ''}</div><div>own words of page number {i} and nothing else</div>") for i in range(20)]
    rows += [(100 + i, f"http://a.example/copy{i}", f"<nav>menu {i}</nav><div>{story}</div>") for i in range(3)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert found == {i: f"own words of page number {i} and nothing else" for i in range(20)} | {100 + i: story for i in range(3)}


NOTICE = "sign up now to read the best of our stories before all others do"


def article_pages():
    """Articles of which some hold the same notice, without a telling element: (rows, texts)."""
    own = {i: [f"title {i}", *(" ".join(f"w{i}x{j}x{k}" for k in range(20)) for j in range(3))] for i in range(12)}
    html_of = lambda blocks: "<article>" + "".join(f"<p>{b}</p>" for b in blocks) + "</article>"
    rows = [(i, f"http://a.example/{i}", html_of([*own[i], NOTICE] if i < 5 else own[i])) for i in range(10)]
    want = {i: "\n\n".join(own[i]) for i in range(10)}
    for i in (10, 11):  # two pages of a host quote each other; a host's notice says nothing about another host
        rows.append((i, f"http://b.example/{i}", html_of([*own[i], NOTICE])))
        want[i] = "\n\n".join([*own[i], NOTICE])
    for i in range(4):  # versions of one article, and copies of it
        blocks = [*own[0][1:], *own[1][1:], f"version {i // 2} of the same article"]
        rows.append((20 + i, f"http://c.example/{i}", html_of(blocks)))
        want[20 + i] = "\n\n".join(blocks)
    for i in range(4):
        blocks = [*own[2][1:], f"one more version {i}"]
        rows.append((30 + i, f"http://d.example/{i}", html_of(blocks)))
        want[30 + i] = "\n\n".join(blocks)
    return rows, want


def test_runs_decide_inside_articles(spark):
    rows, want = article_pages()
    found = html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(5))
    assert {r.page_id: r.text for r in found.collect()} == want


def test_many_repeated_runs_are_shuffled(spark, monkeypatch):
    rows, want = article_pages()
    rows += [(50 + i, f"http://a.example/open{i}", f"<div>{NOTICE}</div><div>open page {i}</div>") for i in range(2)]
    want |= {50 + i: f"open page {i}" for i in range(2)}
    for name, value in (("KEYS", 0), ("SHARD", 1), ("PART", 500)):
        monkeypatch.setattr(html_text, name, value)
    found = html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3))
    assert {r.page_id: r.text for r in found.collect()} == want


def test_runs_of_one_page_are_not_written(spark, monkeypatch):
    written = {}
    stored = html_text.stored
    monkeypatch.setattr(html_text, "stored", lambda df, label: written.setdefault(label, stored(df, label)))
    rows = [(i, f"http://a.example/{i}", f"<div>{' '.join(f'w{i}x{k}' for k in range(200))}</div><div>{NOTICE}</div>") for i in range(20)]
    found = html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    assert {len(r.text.split()) for r in found.collect()} == {200}
    assert written["runs"].count() <= 200  # of 4,000


def test_packed_runs():
    rng = np.random.default_rng(5)
    for n in (1, 2, 50, 5000):
        runs = rng.integers(-(2**63), 2**63 - 1, n)
        codes = np.sort(np.concatenate((html_text._codes(runs, 1), [0, (1 << 28) - 1, (1 << 28) - 1])))
        packed = html_text._pack(codes)
        assert html_text._unpack(packed, len(codes)).tolist() == codes.tolist()
        assert len(packed) <= 2.13 * len(codes) + 513


def test_long_character_numbers(spark):
    rows = [(2**60 + 1, "http://a.example", f"<p>a&#{'1' * 5000};b &#x{'0' * 50}41; &#{'0' * 5000}66;c</p>"), (None, "http://a.example/2", "<article>&#65; x</article>")]
    found = html_text.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {r.page_id: r.text for r in found} == {2**60 + 1: "a\ufffdb A Bc", None: "A x"}


def test_query_brute_force(spark, folder):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    found = QUERIES["op8_html_text"](spark, folder).collect()
    assert len(found) == len(pages)
    for r in found:
        article = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", article).replace("<br>", " "))
        want = "\n\n".join(t for t in (" ".join(html.unescape(b).split()) for b in blocks) if t)
        assert (r.text, r.n_chars) == (want, len(want))
