"""Operators on pages: extraction, address filter, archives."""

import gzip
import hashlib

import pytest

from checks.compare import compare, connect
from tenura.llm import extract, queries, url_filter, warc
from tenura.llm.labelled_pages import training_pages
from tenura.session import new_folder


@pytest.fixture(scope="module")
def model():
    return extract.train()


def text(page, model):
    return extract.extract_texts([page], model)[0]


def test_model_tells_parts_apart_on_pages_it_has_not_seen(model):
    wrong = total = 0
    for page in training_pages(60, seed=77):
        tree = extract.parse(page, labelled=True)
        said = extract.marginals(extract.forest_of([tree]), model)[0] > 0.5
        for i, run in enumerate(tree.text):
            if tree.tag[i] == "#text":
                total += 1
                wrong += bool(said[i]) != bool(tree.label[i])
    assert wrong < 0.03 * total


def test_marginals_are_those_of_all_labellings(model):
    """Sum-product against adding up every labelling of a small tree."""
    from itertools import product

    import numpy as np

    tree = extract.parse("<div class=post><p>a <b>b</b></p><nav>c</nav></div>")
    forest = extract.forest_of([tree])
    n = len(tree.tag)
    own = np.bincount(forest.node, weights=model.weights[forest.slot], minlength=n)
    total, each = 0.0, np.zeros(n)
    for labels in product((0, 1), repeat=n):
        s = sum(own[i] * labels[i] for i in range(n)) + sum(model.edges[forest.kind[i], labels[forest.parent[i]], labels[i]] for i in range(1, n))
        w = np.exp(s)
        total += w
        each += w * np.array(labels)
    assert np.allclose(extract.marginals(forest, model)[0], each / total)


def test_main_text_only(model):
    page = """<html><head><title>T</title><style>x</style></head><body><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
    <div class="cookie-notice"><p>We use cookies</p></div><article><h1>Caf&eacute; &amp; more</h1><p>One  <b>two</b>
    three</p><script>var a = "<p>no</p>";</script><!-- <p>no</p> --><ul><li>first<li>second</ul><form><label>Mail</label><input></form></article>
    <aside class="sidebar"><p>Other stories</p></aside><section class="comments"><p>Nice text</p></section><footer>&copy; 2020</footer></body></html>"""
    assert text(page, model) == "Café & more\nOne two three\nfirst\nsecond"


@pytest.mark.parametrize("page", [None, "", "<", "<<<>>>", "</p></p>", "<p" * 500, "<!--", "<div>" * 2000, "<a b='", "&#0;&bogus;", "<script>"])
def test_odd_pages_do_not_fail(model, page):
    assert isinstance(text(page or "", model), str)


@pytest.mark.parametrize("tag", ["svg", "math", "object", "canvas", "template", "select", "noscript", "iframe"])
@pytest.mark.parametrize("form", ["<{0} class=x/>", "<{0}>", "<{0} a=b><p>", "<{0}><{0}>no</{0}>", "<{0}>no<!-- </p> <{0}> --><{0}>no</{0}>no</{0}>"])
@pytest.mark.parametrize("later", ["", "<{0}>no</{0}>"])
def test_no_article_is_lost_to_elements_that_are_not_read(model, tag, form, later):
    page = "<body>{1}<article><h1>Head of all</h1><p>One two three four.</p>{1}<p>Five six seven.</p></article>{2}</body>".format(tag, form.format(tag), later.format(tag))
    assert text(page, model) == "Head of all\nOne two three four.\nFive six seven."


def test_raw_text_goes_to_its_end(model):
    assert text("<article><p>One two.</p><svg><title/><style/></svg><script>'<svg>'</script><p>Three.</p><style>no", model) == "One two.\nThree."


@pytest.mark.parametrize("value", ['"a > b"', "'a > b'", '= "a > b"', "=\n'a > \"b\"'"])
def test_tags_end_outside_quotes(model, value):
    image = f"<img alt={value.lstrip('=')} src='x'>"
    tree = extract.parse(f"<p>One {image} two.</p>")
    assert [t for t in tree.text if t] == ["One ", " two."]
    assert text(f"<article><p>One {image} two three.</p></article>", model) == "One two three."


def test_extract_on_tables(spark, model):
    page = "<body><nav><a href=x>menu</a></nav><article><p>" + "word " * 50_000 + "</p></article></body>"
    rows = [(1, "http://a", page, "mine"), (1, "http://a", page, "mine"), (None, None, None, None), (3, "", "", "x")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    out = extract.extract(df, model)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(out.collect(), key=lambda r: (r.page_id is None, r.page_id))
    assert [r.n_chars for r in got] == [249_999, 249_999, 0, 0] and got[3].text == ""
    assert extract.extract(df.limit(0), model).count() == 0


def test_op1_takes_the_article(spark, sf):
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in queries.op1_extract(spark, sf).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = [re.sub(r"<[^>]+>", "", b) for b in re.split(r"</?(?:p|h1|br)[^>]*>", inner)]
        want = "\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)
        assert (r.text, r.n_chars) == (want, len(want))


@pytest.mark.parametrize("name", ["op2_exact_dedup", "op3_url_filter", "op4_warc", "op9_line_dedup"])
def test_query_equals_sql(spark, sf, name):
    rows, problem = compare(connect(sf), queries.QUERIES[name](spark, sf), queries.SQL[name])
    assert problem is None and rows > 0


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        ("http://a.ORG/x", "a.org", "/x", "org/", "allow"), ("http://a.example.org/es/q?x", "a.example.org", "/es/q", "example.org/es/", "block"),
        ("https://example.org/en/17#f", "example.org", "/en/17", "example.org/en/1", "block"), ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
        ("http://b.com/de/", "b.com", "/de/", "com/de/", "block"), ("http://b.com/de", "b.com", "/de", None, "allow"), ("http://casino.org", "casino.org", "", None, "allow"),
        ("http://porn.org/a", "porn.org", "/a", "org/", "allow"), ("http://porn.net/a", "porn.net", "/a", None, "block"), ("http://corn.net/pornography", "corn.net", "/pornography", None, "allow"),
        ("http://cheap-pills.net/", "cheap-pills.net", "/", None, "block"), ("http://cheap-cheap.net/", "cheap-cheap.net", "/", None, "allow"),
        ("no scheme", "", "", None, "allow"), ("", "", "", None, "allow"), (None, "", "", None, "allow"), ("://?q", "", "", None, "allow"),
    ],
)
def test_addresses(spark, url, host, path, rule, verdict):
    df = spark.createDataFrame([(1, url, "mine")], "page_id bigint, url string, host string")
    r = url_filter.judge_urls(df).first()
    assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)


def test_no_addresses(spark):
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id bigint, url string")).count() == 0


LONG = "<p>" + "é" * 900 + "</p>"
PAGES = [(1, "http://b.Example.org/x?q#f", LONG), (2, "http://b.example.org/x?q", LONG), (7, None, LONG), (None, "http://a b\r\n.net/", LONG), (3, "http://c", None),
         (4, "http://c", ""), (5, "short", "tiny"), (6, "short", "tiny"), (2, "http://b.example.org/x?q", LONG), (-8, "", "x\r\n\r\ny" * 300)]


def test_archives_come_back(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 2)
    df = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").repartition(3)
    folder = new_folder(spark, "warc-test")
    heads = warc.write_index(warc.write_archives(df, folder), folder, rows_per_file=4)
    got = warc.look_up(df, folder, heads).collect()
    assert len(got) == len(PAGES)
    want = {}
    for page, _, html in PAGES:
        raw = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "").encode() == raw and p is not None]
        late = page is not None and len(raw) >= 1000 and page < max(same)
        want[page, hashlib.sha1(raw).hexdigest()] = (len(raw), "revisit" if late else "response", max(same) if late else None, b"" if late else raw)
    for r in got:
        assert (r.payload_bytes, r.record_type, r.refers_to, bytes(r.payload)) == want[r.page_id, r.payload_digest]
    found = warc.page_archive(spark, folder, heads, "http://B.example.org/x?q")
    assert sorted(r.page_id for r in found) == [1, 2, 2]
    assert warc.page_archive(spark, folder, heads, "http://nowhere/") == []
    nothing = df.limit(0)
    folder = new_folder(spark, "warc-test")
    assert warc.look_up(df, folder, warc.write_index(warc.write_archives(nothing, folder), folder)).count() == 0


def test_captures_of_one_key_come_back_once(spark):
    urls = [f"http://h/p#{k}" for k in range(5)] + ["https://H/p", "h/p", "http://h/p?q"]
    df = spark.createDataFrame([(None, u, f"<p>{u}") for u in urls] + [(4, urls[0], "a"), (4, urls[1], "a"), (4, urls[5], "b")], "page_id bigint, url string, html string")
    folder = new_folder(spark, "warc-test")
    got = warc.look_up(df, folder, warc.write_index(warc.write_archives(df.repartition(3), folder), folder)).collect()
    assert sorted(bytes(r.payload).decode() for r in got) == sorted([f"<p>{u}" for u in urls] + ["a", "a", "b"])


def test_records_follow_the_format():
    raw = warc.record(5, "http://x/a b", b"hi", hashlib.sha1(b"hi").hexdigest(), None)
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and raw.endswith(b"\r\n\r\nhi\r\n\r\n")
    parsed = warc.parse_record(gzip.decompress(gzip.compress(raw)))
    assert parsed["headers"]["warc-target-uri"] == "http://x/a%20b" and parsed["payload"] == b"hi"
    assert parsed["headers"]["warc-payload-digest"].startswith("sha1:YIVPL") or len(parsed["headers"]["warc-payload-digest"]) == 37
