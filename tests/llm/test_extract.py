from __future__ import annotations

import random

import numpy as np
import pytest

from tickwise.llm.extract import covered_blocks, extract, main_text, read_page, repeated

PAGES = "page_id bigint, url string, html string, host string, text string, part int"


def text_of(page, others=()):
    read = [read_page(p) for p in (page, *others)]
    shares = covered_blocks([s for _, s in read])
    return main_text(read[0][0], shares[0])[0]


@pytest.mark.parametrize("seed", range(6))
def test_repeats_are_those_of_all_pairs(seed):
    rng = random.Random(seed)
    run = rng.choice([1, 2, 3, 5, 8])
    shared = [[rng.randrange(4) for _ in range(rng.randrange(1, 12))] for _ in range(3)]
    pages = [sum((rng.choice(shared) if rng.random() < 0.5 else [rng.randrange(6)] for _ in range(8)), []) for _ in range(5)]
    tokens, page_of = [], []
    for p, page in enumerate(pages):
        tokens += [*page, 100 + p]
        page_of += [p] * (len(page) + 1)
    at: dict[tuple, set] = {}
    for i in range(len(tokens) - run + 1):
        at.setdefault(tuple(tokens[i : i + run]), set()).add(page_of[i])
    want = [False] * len(tokens)
    for i in range(len(tokens) - run + 1):
        if len(at[tuple(tokens[i : i + run])]) > 1:
            want[i : i + run] = [True] * run
    assert repeated(np.array(tokens), np.array(page_of), run).tolist() == want


def test_one_page_and_none():
    assert repeated(np.zeros(0, dtype=int), np.zeros(0, dtype=int)).tolist() == []
    assert not repeated(np.array([1] * 50 + [2]), np.zeros(51, dtype=int)).any()
    assert covered_blocks([]) == []


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body>"
    "<nav><ul><li><a href='/x'>Home</a></li></ul></nav><div class='cookie-notice'>We use cookies</div>"
    "<article><header><h1>Big &amp; bold</h1></header><p>One <b>two</b>\n three<br>four.<p>Five &lt;six&gt;"
    "<form><input><p>Mail</p></form><aside>Side</aside><div class='ad'>Buy</div><table><tr><td>a</td><td>b</td></tr></table>"
    "<section id='comments'><p>First!</p></section></article><footer>&copy; me</footer></body></html>"
)


def test_declared_article():
    assert text_of(PAGE) == "Big & bold\nOne two three four.\nFive <six>\na\nb"
    assert text_of(PAGE, [PAGE, PAGE]) == text_of(PAGE)  # an article that repeats stays


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""), ("plain words", "plain words"), ("<p>a<p>b</p>c", "a\nb\nc"), ("<p>cut off &am", "cut off &am"), ("<p>x</p><!-- never closed <p>y</p>", "x"),
        ("<p>x</p><script>if (a<b) '<p>'", "x"), ("<p>a</p></div></x><p>b", "a\nb"), ("<p title='a>b'>c</p>", "c"), ("a < b and c", "a < b and c"),
        ("<p>un<b>cl<i>osed", "unclosed"), ("<p>&#233;&nbsp;&eacute;</p>", "é é"), ("<p> </p>\n<p>\t</p>", ""), ("<P CLASS=Sidebar>no</P><P>yes</P>", "yes"),
        ("<div hidden>no</div><div role=navigation>no</div>yes", "yes"), ("<p>a<span class='ad'>buy</span>b</p>", "a\nb"), ("<head><p>lost", ""),
        ("<body><article></article><p>open</p>", "open"), ("<main><p>m</p></main><p>open</p>", "m"), ("<![CDATA[x]]><p>y", "y"), ("<", "<"), ("<p", ""),
    ],
)
def test_awkward_pages(page, text):
    assert text_of(page) == text


def test_repeats_decide_where_nothing_is_declared():
    menu = "<div><p>home news sport weather travel shop about us contact</p></div>"
    pages = [f"<html><body>{menu}<p>only {i} words of page number {i} that no other page has at all {i}</p></body></html>" for i in range(3)]
    for i, page in enumerate(pages):
        got = text_of(page, [p for p in pages if p != page])
        assert got == f"only {i} words of page number {i} that no other page has at all {i}"


def test_long_and_deep_pages_end():
    assert text_of("<div>" * 50_000 + "x" + "</span></p></b>" * 50_000) == "x"
    assert text_of("<p>" + "word " * 300_000).count("word") == 300_000
    assert text_of("<" * 100_000 + "<!--" * 10 + "'\"" * 50_000) == "<" * 100_000


def test_table(spark):
    rows = [(i, f"http://h{i % 3}.net/p", PAGE.replace("Five", f"Five{i}")) for i in range(40)]
    rows += [(100, None, None), (101, "no host", ""), (None, "http://h1.net/", "<p>x"), (0, "http://h0.net/p", rows[0][2]), (0, "http://h0.net/p", rows[0][2])]
    pages = spark.createDataFrame([(*r, "clash", "clash", 9) for r in rows], PAGES)
    for group_bytes in (1 << 20, 2000):
        got = extract(pages, group_bytes=group_bytes).collect()
        assert len(got) == len(rows)
        by = {r.page_id: r for r in got}
        assert all(by[i].text == text_of(h) and by[i].url == u for i, u, h in rows[:40])
        assert by[100].text == "" and by[101].text == "" and by[None].text == "x" and by[100].url is None
    assert extract(spark.createDataFrame([], PAGES)).count() == 0


def test_copies_do_not_cover_each_other(spark):
    page = "<p>one page of plain words that is stored under two different addresses of one host</p>"
    rows = [(1, "http://m.net/a", page), (2, "http://m.net/b", page), (3, "http://other.net/", page)]
    got = extract(spark.createDataFrame([(*r, "h", "t", 0) for r in rows], PAGES)).collect()
    assert [r.text for r in got] == [page[3:-4]] * 3 and not any(r.n_covered for r in got)


def test_repeats_are_those_of_the_whole_host_whatever_the_groups(spark):
    menu = "<div>news of sport and weather and travel in our own section</div>"
    rows = []
    for i in range(60):
        own = " ".join(f"own{i}x{j}" for j in range(30))
        rows.append((i, f"http://{'ab'[i % 2]}.net/{i}", f"{menu if i % 20 < 2 else ''}<p>{own}</p>"))
    pages = spark.createDataFrame([(*r, "h", "t", 0) for r in rows], PAGES).repartition(3).localCheckpoint()
    want = {(i, h[h.index("<p>") + 3 : -4], int(h.startswith("<div>"))) for i, _, h in rows}
    for group_bytes in (1, 3000, 4 << 20):
        got = extract(pages, group_bytes=group_bytes).collect()
        assert {(r.page_id, r.text, r.n_covered) for r in got} == want and len(got) == 60



@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<div class="page has-sidebar"><article><p>a</p></article></div>', "a"),
        ('<div class="sidebar"><article><p>a</p><div class="ad">buy</div></article></div>', "a"),
        ('<form id="aspnetForm"><div>menu</div><article><p>a</p><form><p>mail</p></form></article></form>', "a"),
        ('<article><div class="article-header"><h1>a</h1></div><section id="related-work"><p>b</p></section></article>', "a\nb"),
        ('<article><p class="social-policy">a</p><div class="header"><h2>b</h2></div></article>', "a\nb"),
        ('<article><p>a</p><section id="comments"><article>first</article></section></article>', "a"),
        ('<article><p>a</p></article><div class="comment-list"><article>first</article></div>', "a"),
        ('<div class="widget"><article><p>a</p></article><div class="comments"><article>first</article></div></div>', "a"),
        ('<aside><article>teaser</article></aside><p>a</p>', "a"),
        ('<article><p>a</p><div class="cookie-banner">b</div><div id="site-footer2">c</div><p class="ad-300x250">d</p></article>', "a"),
    ],
)
def test_containers_of_declared_parts(page, text):
    assert text_of(page) == text


def test_rows_that_share_id_and_url_are_split(spark):
    from tickwise.llm.extract import dealt

    rows = [(None, None, "x" * 1000, "h", "t", 0)] * 100
    pages = spark.createDataFrame(rows, PAGES).repartition(2)
    placed, _ = dealt(pages, "page_id", "url", "html", 5000)
    sizes = [r["count"] for r in placed.groupBy("key").count().collect()]
    assert sum(sizes) == 100 and len(sizes) > 10 and max(sizes) <= 20
    assert [r.text for r in extract(pages, group_bytes=5000).collect()] == ["x" * 1000] * 100


def template(i, n):
    menu = "<div>home news sport weather travel shop about us contact</div>"
    quote = "<p>so said the minister to the press on monday about all this</p>" if i < 2 else ""
    return (i, f"http://one.net/{i}", f"{menu}{quote}<p>{' '.join(f'own{i}x{j}' for j in range(12))}</p>")


def test_undeclared_pages_lose_the_template_and_keep_a_quoted_passage(spark):
    rows = [template(i, 30) for i in range(30)]
    pages = spark.createDataFrame([(*r, "h", "t", 0) for r in rows], PAGES)
    for group_bytes in (1, 2000, 4 << 20):
        for r in extract(pages, group_bytes=group_bytes).collect():
            want = ["so said the minister to the press on monday about all this"] * (r.page_id < 2)
            assert r.text.split("\n")[:-1] == want and r.n_covered == 1, r.page_id


@pytest.mark.parametrize("seed", range(2))
def test_runs_of_large_hosts_are_counted_over_all_their_groups(spark, seed):
    rng = random.Random(seed)
    shared = [" ".join(f"s{k}w{j}" for j in range(rng.randrange(8, 14))) for k in range(8)]
    rows = []
    for i in range(300):
        blocks = [s for k, s in enumerate(shared) if rng.random() < (0.005, 0.015, 0.02, 0.022, 0.03, 0.05, 0.3, 0.9)[k]]
        own = " ".join(f"own{i}x{j}" for j in range(rng.randrange(1, 20)))
        rows.append((i, f"http://h{i % 10 // 9}.net/{i}", "".join(f"<p>{b}</p>" for b in [*blocks, own])))
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(100)]  # copies count once
    html = {r[0]: r[2] for r in rows}
    seen = {}
    for i, url, page in rows:
        for k, s in enumerate(shared):
            if f"<p>{s}</p>" in page:
                seen.setdefault((url[:11], k), set()).add(page)
    hosts = {u[:11]: len({p for _, v, p in rows if v[:11] == u[:11]}) for _, u, _ in rows}
    gone = {(h, shared[k]) for (h, k), p in seen.items() if len(p) >= max(3, 0.02 * hosts[h])}
    pages = spark.createDataFrame([(*r, "h", "t", 0) for r in rows], PAGES).repartition(3)
    for group_bytes in (3000, 20_000, 4 << 20):
        got = extract(pages, group_bytes=group_bytes).collect()
        assert len(got) == len(rows)
        for r in got:
            want = [b for b in html[r.page_id][3:-4].split("</p><p>") if (r.url[:11], b) not in gone]
            assert r.text == "\n".join(want)


def test_packed_pages_come_back():
    from tickwise.llm.extract import Group, blocks_of, pack_page

    pages = [read_page(x) for x in (PAGE, "", "<p>x", "<br>", "< \x85 a\x1cb \u2028 c", "<x\ny>z", "<p>a b<p>a")]
    packed = [pack_page(blocks, stream) for blocks, stream in pages]
    for (blocks, _), x in zip(pages, packed, strict=True):
        assert [(b.text, b.zone) for b in blocks_of(x)] == [(b.text, b.zone) for b in blocks]
    group = Group(packed)
    want, in_block, names = [], [], {}
    for p, (_, stream) in enumerate(pages):
        for item in stream:
            is_block = isinstance(item, list)
            want += [(is_block, w) for w in (item if is_block else [item])]
            in_block += [is_block] * (len(item) if is_block else 1)
        want.append(p)
        in_block.append(False)
    # equal numbers just where tokens are equal
    assert len(want) == len(group.tokens) and [x >= 0 for x in group.block] == in_block
    assert all(names.setdefault(t, n) == n for t, n in zip(want, group.tokens.tolist(), strict=True))
    assert len(set(names.values())) == len(names)
    assert group.per_page.tolist() == [len(blocks) for blocks, _ in pages]
    assert Group([]).places(8).tolist() == [] and Group([b""]).tokens.tolist() == [0]
