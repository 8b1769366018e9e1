from __future__ import annotations

import random
import re
import time
from collections import defaultdict
from html import unescape

import numpy as np
import pytest

from quaestor.llm.html_text import blocks_of, extract, main_texts, op10_html_text, repeated_runs
from quaestor.llm.tables import read_table
from tests.conftest import SF_DIR

PAGES = "page_id long, url string, html string"


def text_of(html):
    return main_texts([blocks_of(html)])[0]


@pytest.mark.parametrize("html, want", [
    (None, ""), ("", ""), ("plain &amp; text", "plain & text"), ("<p>a<p>b</p>c", "a\nb\nc"), ("<b>a</b>b <i>c</i>", "ab c"),
    ("<nav>m</nav><article><h1>T</h1><p>x\n y&nbsp;z<br>w</article><footer>f", "T\nx y z\nw"),
    ("<article><header><h1>T</h1></header><aside>s</aside><p>x</p><div class='post comments'>c<p>d</p></div>y</article>", "T\nx\ny"),
    ("<div id=sidebar>s</div><div role='banner'>b</div><p>text</p><form>f</form><!-- c <p>x</p> --><p>more", "text\nmore"),
    ("<script>var t='</p>';</script><style>p{}</style><title>t</title><p>a &lt;b&gt;</p><svg><text>q</text></svg>", "a <b>"),
    ("<p>&#55296;&#0;&#" + "9" * 5000 + ";x</p>", "\ufffd\ufffd\ufffdx"), ("<p>a</p></div></b><p>b</p><p", "a\nb"),
    ("<p title='a > b'>x</p><p hidden>no</p>", "x"), ("<p class='adventure'>kept</p><p class='ad'>no</p>", "kept")])
def test_blocks(html, want):
    assert text_of(html) == want


@pytest.mark.parametrize("html, want", [
    ("<p>Don't <b title=x'>bold</b> it's</p>", "Don't bold it's"), ("<p data-x=it's>hello</p>", "hello"), ("<a href=x title=\"oops>link</a>", "link"),
    ("<p title = 'a>b' class=ad>no</p><p data-y='class=ad'>yes</p>", "yes"), ("<p \"odd' =x>a</p>b", "a\nb"), ("<p title='a>b</p><i q=\"c>d", "b\nd"),
    ("1 < 2 and <3 <b>x</b> </ >y<!doctype x>z<? q ?>", "1 < 2 and <3 x yz"), ("<p>a</p><p title='never", "a"), ("<svg>a<b>t</b>", "at")])
def test_attributes(html, want):
    assert text_of(html) == want


@pytest.mark.parametrize("broken", ["<p title='", "<a \"", "<svg>", "<!", "<a b=\"'>", "</", "<p a='b\" c=\"d' ", "<a =", "<b x=\"> ' "])
def test_linear_in_broken_tags(broken):
    start = time.time()
    blocks_of(broken * 100000)
    blocks_of(broken * 100000 + ">")
    assert time.time() - start < 10


def test_linear_in_unclosed_elements():
    start = time.time()
    assert len(blocks_of("<div><span>x" * 100000)) == 100000
    assert len(blocks_of("<p>x" * 100000 + "</b>" * 100000)) == 100000
    assert time.time() - start < 20


def test_runs_against_all_substrings():
    rnd = random.Random(4)
    for _ in range(60):
        pages = [[rnd.randrange(3) for _ in range(rnd.randrange(14))] for _ in range(rnd.randrange(1, 5))]
        length = rnd.choice((1, 2, 3, 5, 6))
        held = defaultdict(set)
        for k, p in enumerate(pages):
            for i in range(len(p) - length + 1):
                held[tuple(p[i:i + length])].add(k)
        want = []
        for p in pages:
            row = [0] * len(p)
            for i in range(len(p) - length + 1):
                n = len(held[tuple(p[i:i + length])])
                for j in range(i, i + length):
                    row[j] = max(row[j], n if n > 1 else 0)
            want += row
        owner = np.repeat(np.arange(len(pages)), [len(p) for p in pages])
        assert repeated_runs(np.array(sum(pages, []), np.int64), owner, length).tolist() == want


def test_boilerplate_of_a_host_goes_and_copies_stay():
    rnd = random.Random(9)
    own = [" ".join(rnd.choice("abcdefghij") + str(rnd.randrange(1000)) for _ in range(30)) for _ in range(5)]
    notice = "this site sells your data to each of its many partners"
    loose = [blocks_of(f"<div>{notice}</div><div>{x}</div>") for x in own]
    assert main_texts(loose) == own
    inside = [blocks_of(f"<article><p>{x}</p><p>{notice}</p></article>") for x in own]
    assert main_texts(inside) == own
    copies = [blocks_of(f"<article><p>{own[0]}</p></article>")] * 6
    assert main_texts(copies) == [own[0]] * 6
    assert main_texts([blocks_of(f"<p>{own[0]}</p>")] * 2) == [own[0]] * 2


def test_query_against_the_articles(spark):
    got = {r.page_id: r for r in op10_html_text(spark, SF_DIR).collect()}
    rows = read_table(spark, SF_DIR, "pages").collect()
    assert len(got) == len(rows)
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        parts = [re.sub(r"\s+", " ", unescape(re.sub(r"<[^>]*>", "", x))).strip() for x in re.split(r"</?(?:p|h1|br)>", article)]
        assert got[r.page_id].text == "\n".join(filter(None, parts))
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


def test_odd_rows(spark):
    rows = [(1, None, None), (None, "http://a/", "<p>x"), (None, "http://a/", "<p>x"), (2 ** 60 + 1, "", ""), (3, None, "y" * 300000)]
    got = sorted(((r.page_id or 0, r.url, len(r.text)) for r in extract(spark.createDataFrame(rows, PAGES)).collect()), key=str)
    assert got == sorted([(1, None, 0), (0, "http://a/", 1), (0, "http://a/", 1), (2 ** 60 + 1, "", 0), (3, None, 300000)], key=str)
    assert extract(spark.createDataFrame([], PAGES)).count() == 0
    wider = spark.createDataFrame([(1, "u", "<p>x", "t", 5)], PAGES + ", text string, host int")
    assert [tuple(r) for r in extract(wider).collect()] == [(1, "u", "x")]


def test_runs_of_a_large_host_are_counted_over_all_its_pages(spark):
    n, notice = 1500, "this site sells your data to each of its many partners"
    own = [" ".join(f"w{k}x{j}" for j in range(12)) for k in range(n)]
    rows = [(k, f"http://big/{k}", f"<div>{notice}</div><div>{own[k]}</div>" if k in (3, 900) else f"<div>{own[k]}</div>") for k in range(n)]
    inside = "a line that stands on more than half of the pages"
    rows += [(n + k, f"http://art/{k}", f"<article><p>{own[k]}</p><p>{inside if k % 5 < 3 else 'other'}</p></article>") for k in range(600)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert len(got) == len(rows) and all(got[k] == own[k] for k in range(n))
    assert all(got[n + k] == (own[k] if k % 5 < 3 else own[k] + "\nother") for k in range(600))
    assert main_texts([blocks_of(h) for _, _, h in rows[:n]]) == own
