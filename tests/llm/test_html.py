"""Main text: the scan against all regions, markup traps, and held-out pages."""

from __future__ import annotations

import random
import re

from genoweave.llm import html_text as H
from genoweave.llm import queries

SF = "/root/testdata/sf0.01"
PAGE = """<!DOCTYPE html><html><head><title>Site: a title</title><style>p{content:"<p>"}</style></head><body>
<header class=top>Site name</header><nav><ul><li><a href=/>Home of all</a><li><a href="/x?a>b">More here</a></ul></nav>
<div id="cookieNotice">We use cookies, agree now</div><script>if (a < b) document.write("</p><p>x");</script>
<article><h1>The&nbsp;head &amp; line</h1><p>One <b>bo</b>ld&#33; word<br>and a <a href=#>link</a> &lt;tag&gt;.<p>Unclosed second<div class="ad box">Buy this now</div>
<ul><li>first<li>second</ul><form>Your mail <input name=q> here</form><table><tr><td>1<td>2</table><!-- <p>no</p> --><p>La<i>st</i> one.</article>
<aside>Read also these</aside><div class="comments"><p>I disagree with it</p><p>Me too</p></div><footer>&copy; Site, all rights</footer></body></html>"""
TEXT = "The head & line One bold! word and a link <tag>. Unclosed second first second 1 2 Last one."


def test_a_page():
    assert H.main_text(PAGE, {}) == TEXT
    assert H.main_text(PAGE.replace("<article>", "<div class=body-text>").replace("</article>", "</div>"), {}) == TEXT
    for page, text in ((None, ""), ("", ""), ("just words", "just words"), ("<p>a", "a"), ("<", "<"), ("a < b", "a < b"), ("<script>x", ""), ("</p></b>x", "x"), ("<nav>menu only</nav>", ""), ("<!-- a", ""), ("<p>" * 3000 + "deep", "deep")):
        assert H.main_text(page, {}) == text, page


def test_the_scan_finds_the_best_region():
    rng = random.Random(2)
    for _ in range(300):
        found = [H.Token("p", "w", rng.randint(1, 4), rng.random() < 0.4, False, False) if rng.random() < 0.5 else H.Token("div", "", 0, False, True, False) for _ in range(rng.randint(0, 25))]
        weights = {"word p": 1.0, "tag div": -1.5}
        score = lambda t: (0.0 if t.held else t.words) if t.words else -1.5
        start, end = H.region(found, weights)
        sums = [sum(map(score, found[a:b])) for a in range(len(found)) for b in range(a + 1, len(found) + 1)]
        assert abs(sum(map(score, found[start:end])) - max([0.0, *sums])) < 1e-9


def test_whole_table_and_held_out_pages(spark):
    rows = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    found = queries.op10_main_text(spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(found) == len(rows)
    weights = H.learn(spark.read.parquet(f"{SF}/pages.parquet").filter("page_id % 2 = 0"))
    for r in found:
        body = re.search("<article>(.*)</article>", rows[r.page_id].html, re.S)[1]
        assert r.n_chars == len(r.text) and r.url == rows[r.page_id].url
        assert " ".join(texts[int(re.search(r"/(\d+)", r.url)[1])].split()) in r.text
        assert all(w in body for w in re.findall(r"\w+", r.text)[:50])
        if r.page_id % 2:
            assert H.main_text(rows[r.page_id].html, weights) == r.text


def test_edges(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, PAGE, "x"), (3, PAGE, "x"), (3, PAGE, "x"), (4, "<p>" + "long words " * 200_000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, html string, n_chars string")
    df = H.extract(pages, H.learn(pages))
    assert [r.text for r in df.collect()][:5] == ["", "", TEXT, TEXT, TEXT] and df.columns == ["page_id", "html", "n_chars", "text"]
    assert H.learn(pages.limit(0)) == {} and H.extract(pages.limit(0), {}).count() == 0


def test_the_scan_decides_where_tags_name_nothing():
    """Lists of links and teasers in plain elements, without marks: what was learned from other pages makes them cost more than they
    bring, and the scan cuts them off at both ends."""
    links = lambda k: "<div>" + "".join(f"<div><a href=/{i}>link {i} to page</a></div>" for i in range(k)) + "</div>"
    body = "<p>" + "</p><p>".join(f"Sentence {i} of the story is long enough to be read." for i in range(8)) + "</p>"
    text = " ".join(f"Sentence {i} of the story is long enough to be read." for i in range(8))
    labelled = [f"<body>{links(12)}<article>{body}</article>{links(15)}</body>"] * 5
    counts = sum((H.evidence(p) for p in labelled), H.Counter())
    weights = {}
    for key in {k for k, _ in counts}:
        inside, outside = counts[key, True], counts[key, False]
        weights[key] = max(-6.0, min(3.0, H.math.log((inside + 0.5) / (outside + 0.5))))
    plain = f"<body>{links(9)}<div>{body}</div>{links(20)}</body>"
    assert H.main_text(plain, weights) == text
    assert H.main_text(plain, {}) != text and "link 3" in H.main_text(plain, {}), "without the weights the lists are taken"
    start, end = H.region(H.tokens(plain, weights), weights)
    assert 0 < start < end < len(H.tokens(plain, weights))


def test_marks_and_truncated_tags():
    import time

    assert H.main_text('<article><p>Body text here.</p><div class="related-posts">More of it</div><div class="notice-of-motion">The motion passed.</div></article>', {}) == "Body text here. The motion passed."
    page = "<p>Before it.</p><div " + " ".join(f'data-a{i}="v {i}"' for i in range(200))
    began = time.time()
    assert H.main_text(page, {}) == "Before it." and H.main_text("<p>a</p>" + "<div class='x" * 20_000, {}) == "a"
    assert time.time() - began < 5
