"""Embeddings, pages and archives against brute force."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import pytest

from adspark.llm import archive, embeddings, pages
from adspark.llm.common import scratch


def vectors(seed, n=250, width=16):
    r = np.random.default_rng(seed)
    rows = [r.normal(size=width) for _ in range(n)]
    for k in range(0, n, 5):  # chains, copies and scaled copies
        for step in range(3):
            rows.append(rows[k] + r.normal(size=width) * .09 * (step + 1))
        rows.append(rows[k])
        rows.append(rows[k] * 3.5)
    hot = r.normal(size=width)
    rows += [hot + r.normal(size=width) * .05 for _ in range(60)]
    out = [(int(i), x.astype(np.float32).tolist()) for i, x in enumerate(rows)]
    bad = [None, [], [0.0] * width, [None] + [1.0] * (width - 1), [float("nan")] * width, [float("inf")] + [1.0] * (width - 1), [1e38] * width, [1e-40] * width]
    out += [(10_000 + k, b) for k, b in enumerate(bad)] + [(20_000, [1.0, 2.0]), (20_001, [2.0, 4.0]), (3, rows[3].astype(np.float32).tolist()), (20_002, [1.0] * (width + 1))]
    return out


def brute(rows):
    ok = [x is not None and len(x) > 0 and None not in x and bool(np.isfinite(x).all()) and any(x) for _, x in rows]
    unit = [embeddings.unit(np.array([x], float))[0] if g else None for (_, x), g in zip(rows, ok)]
    n, group = len(rows), list(range(len(rows)))
    links = [0] * n

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(n):
        for b in range(a):
            if ok[a] and ok[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= .95:
                links[a] += 1
                links[b] += 1
                group[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(rows):
        low[find(k)] = min(low.get(find(k), i), i)
    return sorted((i, links[k], low[find(k)], i == low[find(k)]) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("home,tile", [(4096, 4096), (30, 25)])
def test_embeddings(spark, monkeypatch, home, tile):
    monkeypatch.setattr(embeddings, "HOME", home)
    monkeypatch.setattr(embeddings, "TILE", tile)
    rows = vectors(home)
    df = spark.createDataFrame([(i, x, 1, "r") for i, x in rows], "vec_id long, embedding array<float>, label int, root string").repartition(3)
    got = embeddings.near_duplicates(df)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_no_embeddings(spark):
    kind = "vec_id long, embedding array<float>"
    assert embeddings.near_duplicates(spark.createDataFrame([], kind)).collect() == []
    assert [tuple(x) for x in embeddings.near_duplicates(spark.createDataFrame([(1, None)], kind)).collect()] == [(1, 0, 1, True)]


PAGE = ("<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href=a>Home</a><li><a href=b>News</a></ul></nav>"
        "<!-- ad <p>no</p> --><div class='ad'>Buy now.</div><article><h1>T &amp; t</h1><p><b>One  two,\n three.<br>four<p>Five &lt;six&gt; seven, eight.</p>{more}</article><footer>&copy; me</footer></body></html>")


def test_pages_against_the_given_article(spark):
    r = random.Random(1)
    rows = [(k, f"u{k}", PAGE.format(more="".join(f"<p>Some words, {r.random()} and more.</p>" for _ in range(r.randrange(6))))) for k in range(40)]
    rows += [(100, None, None), (101, "u", ""), (102, "u", "<p"), (None, "u", PAGE.format(more="")), (1, "again", PAGE.format(more="")), (103, "u", "<div " + "a='" * 3000)]
    df = spark.createDataFrame([(*x, "n") for x in rows], "page_id long, url string, html string, text string").repartition(3)
    got = pages.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    seen = {(x.page_id, x.url): x for x in got.collect()}
    assert len(seen) == len(rows)
    head = "T & t\n\nOne two, three. four\n\nFive <six> seven, eight."
    assert seen[None, "u"].text == head and seen[None, "u"].n_chars == len(head)
    assert all(seen[k, f"u{k}"].text.startswith(head) and "Home" not in seen[k, f"u{k}"].text and "Buy" not in seen[k, f"u{k}"].text for k in range(40))
    assert seen[100, None].text == "" and seen[101, "u"].n_chars == 0
    assert pages.extract(df.limit(0)).collect() == []


def test_pages_of_other_layouts():
    beta, pair = pages.train([pages.Page(PAGE.format(more="<p>More, and more.</p>" * k)) for k in range(20)])
    html = ("<body><div class=menu><a>Home</a> <a>About us</a></div><div class=content><p>A long text, with commas. And sentences that read well.</p>"
            "<p>Another paragraph, long enough again. Yes.</p><div class=comments><p>First! Nice one, really.</p></div></div><aside>Also read this, now.</aside>"
            "<div class='cookie notice'>We use cookies, of course.</div><form>Your name <input> please, now.</form></body>")
    text = pages.main_text(pages.Page(html), beta, pair)
    assert text == "A long text, with commas. And sentences that read well.\n\nAnother paragraph, long enough again. Yes."


def test_attribute_values_of_any_length():
    long = 'x > "' * 4000
    page = pages.Page(f"<body><aside data-x='{long}'>Also read this.</aside><script data-x='{long}'>var code;</script><div><div class=a data-x='{long}'>In.</div></div><p b=\">Open.</p></body>")
    assert page.tag[1:] == ["body", "aside", "script", "div", "div", "p"] and page.words[5] == "a"
    assert list(zip(page.node, page.text)) == [(2, "Also read this."), (5, "In."), (6, "Open.")]


def test_text_outside_all_elements():
    beta, pair = pages.train([pages.Page(PAGE.format(more="<p>More, and more.</p>" * k)) for k in range(20)])
    text = "A plain page, with sentences. And one more, that reads well."
    for model in ((beta, pair), pages.train([])):
        assert pages.main_text(pages.Page(text), *model) == text
        assert pages.main_text(pages.Page(f"<b>{text[:20]}</b>{text[20:]}<br><i>The end.</i>"), *model) == text + " The end."
    page = pages.Page(f"<html><body><p>In, here.</p></body></html>{text}")
    assert [page.tag[k] for k in page.node] == ["p", "body"] and page.text[1] == text
    assert pages.main_text(page, *pages.train([])).endswith(text)


def runs(html):
    page = pages.Page(html)
    return [t for node, t in zip(page.node, page.text) if not page.hidden[node]]


def test_formulas_drawings_and_controls_stand_in_the_line():
    assert runs("<p>Area is <math><mi>x</mi><mo>&lt;</mo></math> plus <button><div>ok</div></button> more <select><option>a<option>b</select>words</p><xmp>raw <b>&amp; text</xmp>") == [
        "Area is x< plus more words", "raw <b>&amp; text"]
    assert runs("<p>A <svg><style>p{}</style><title>mark</title><path d=''/><desc>no</desc><text>T<tspan>s</tspan></text></svg> b</p>") == ["A markTs b"]
    assert runs("<p>A <svg><path d=1>left open<p>B</p><math><mi>y<div>C</div>") == ["A", "B", "y", "C"]
    assert runs("<p>A <svg><foreignObject><div>in</div></foreignObject></svg> b") == ["A", "in", "b"]
    assert runs("<ul><li>a <b>x<li>b</ul><table><tr><td>1<td>2<tr><td>3</table>c") == ["a x", "b", "1", "2", "3", "c"]
    assert runs("<div>a<b>b<div>c</b>d</div>e</b>f</div>g") == ["ab", "cd", "ef", "g"]


@pytest.mark.parametrize("html", ["<div>" * 100_000 + "</p></b>" * 100_000, "<b><div>" + "<i>" * 50_000 + "</b>" * 100_000, "<foo>" * 50_000 + "<hr>" * 50_000,
                                  "<b>" * 50_000 + "</i>" * 50_000 + "<i><div>" + "<u>" * 50_000 + "</i>" * 50_000, "<p><svg>" * 30_000 + "</p>" * 50_000])
def test_parsing_is_linear(html):
    import time
    start = time.process_time()
    pages.Page(html)
    assert time.process_time() - start < 6  # a second or two on a quiet machine; minutes if a tag scanned the open ones


def test_marginals_are_exact():
    r = np.random.default_rng(2)
    for _ in range(20):
        n = int(r.integers(2, 9))
        parent = [-1] + [int(r.integers(0, k)) for k in range(1, n)]
        own, pair = r.normal(size=n), r.normal(size=(2, 2))
        total, on = 0.0, np.zeros(n)
        for state in range(2 ** n):
            y = [state >> k & 1 for k in range(n)]
            w = np.exp(sum(own[k] for k in range(n) if y[k]) + sum(pair[y[parent[k]]][y[k]] for k in range(1, n)))
            total += w
            on += w * np.array(y)
        assert pages.marginals(parent, own, pair) == pytest.approx(on / total)


def test_archives(spark, monkeypatch):
    monkeypatch.setattr(archive, "LINES", 7)
    monkeypatch.setattr(archive, "FILE_BYTES", 4000)
    r = random.Random(3)
    html = ["", "<p>é</p>\r\n\r\nx", "same" * 50, *("".join(r.choice("ab\r\n<é") for _ in range(r.randrange(400))) for _ in range(60))]
    rows = [(k, f"http://www.Site{k % 5}.org:80/a b/{k % 7}?q#f", html[k % len(html)]) for k in range(160)]
    rows += [(500, None, None), (501, "http://hot.org/", "same" * 50), (502, "no url\n", None)] + [(600 + k, "http://hot.org/", f"x{k}") for k in range(40)]
    df = spark.createDataFrame([(*x, "k", 1) for x in rows], "page_id long, url string, html string, key string, first int").repartition(4)
    warc, cdx = scratch(spark), scratch(spark)
    shards = archive.write_index(archive.write_archives(df, warc), cdx, 5)
    got = archive.read_pages(df, warc, cdx, shards)
    first = {}
    for i, _, h in sorted(rows):
        first.setdefault(h or "", i)
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        same = first[h or ""]
        want.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if same == i else "revisit", None if same == i else same))
    assert sorted(map(tuple, got.collect())) == sorted(want)
    index = archive.Index(cdx, shards)
    assert len(list(index.captures_of("http://hot.org/"))) == 41 and list(index.captures_of("http://hot.org/x")) == []
    assert archive.capture_key("https://u@www.b.A.org:8/x?y#z", "3") == "org,a,b)/x?y 3"


def test_archives_of_hosts_with_tabs_and_newlines(spark):
    urls = ["http://a\nb/", "http://a\tb.org/x", "http://\n.a/", "http://a.org/", "http://b\r.org/\n"]
    df = spark.createDataFrame([(k, u, f"text {k}") for k, u in enumerate(urls)], "page_id long, url string, html string")
    warc, cdx = scratch(spark), scratch(spark)
    shards = archive.write_index(archive.write_archives(df, warc), cdx, 2)
    assert sorted(x[0] for x in archive.read_pages(df, warc, cdx, shards).collect()) == [0, 1, 2, 3, 4]
    assert archive.capture_key("http://a\nb.Org/", "3") == "org,a%0Ab)/ 3"


def test_no_pages(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    warc, cdx = scratch(spark), scratch(spark)
    shards = archive.write_index(archive.write_archives(df, warc), cdx)
    assert archive.read_pages(df, warc, cdx, shards).collect() == []
