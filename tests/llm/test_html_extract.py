"""Main text of pages: broken markup, site templates, what is no content."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from cadenza.llm import html_extract
from cadenza.llm.html_extract import BOX, MENU, PAGE, PROSE, parse

SCHEMA = "page_id long, url string, html string"


@pytest.mark.parametrize(("source", "text"), [
    ("", ""),
    ("plain & simple", "plain & simple"),
    ("<p>a<p>b", "a\n\nb"),
    ("<article><h1>T</h1><p><b>one<br>two</b> &amp;&#65;&eacute;&nbsp;x</p></article><p>out", "T\n\none two &Aé x"),
    ("<p>a</p><script>if (a<b) '</p>'</script><style>p{}</style><p>b</p><!-- c > d --><p>e", "a\n\nb\n\ne"),
    ("<nav>menu</nav><main>in<aside>no</aside>side</main><footer>f</footer>", "in\n\nside"),
    ("<div class='post-body'>x</div><div class=\"ad\">buy</div><div id=comments><p>hi</div><div>y</div>", "x\n\ny"),
    ("<article>a<form>q<input><p>r</form><div class='cookie-notice'>c</div>b</article>", "a\n\nb"),
    ("<ul><li>a<li>b</ul>tail", "a\n\nb\n\ntail"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n\n2\n\n3"),
    ("1 < 2 and &am &amp &copy; <p", "1 < 2 and &am & ©"),
    ("a <a href='x>y'>link</a> b<button>no</button> c", "a link b c"),
    ("<p>a</div></span></p>b", "a\n\nb"),
    ("<p title=\"open>a</p><p>b</p>", "a\n\nb"),
    ("<header><h1>Site</h1>x</header><p>y", "Site\n\ny"),
    ("<div hidden>no</div><div role=main>yes</div><p>no", "yes"),
    ("<title>no</title><textarea><p>no</textarea>yes", "yes"),
    ("<script>never closed <p>x", ""),
    ("<P>A</P><DIV>B</DIV>", "A\n\nB"),
    ("x<![CDATA[no]]><?php no ?>y", "xy"),
])
def test_main_text(source, text):
    assert parse(source).main_text() == text


def test_deep_and_long_pages():
    assert parse("<div>" * 20_000 + "x").main_text() == "x"
    assert len(parse("<p>" + "word " * 300_000).main_text()) == 5 * 300_000 - 1
    assert parse("<" * 100_000).main_text() == "<" * 100_000
    assert parse("<a " * 50_000).main_text() == ""
    assert parse('<p x="' * 20_000).main_text() == ""


def site(host, i, shared):
    return (
        f"<body><div>{shared}<ul><li>home<li>about {host}</ul></div><div><p>Story {i} of {host}.</p><p>Said so.</p></div>"
        f"<div><p>Page made for {host}</p></div></body>"
    )


def pages(session, rows, extra=("key", "host", "body", "hash", "of", "text", "n_chars", "recurring", "page")):
    return session.createDataFrame(rows, SCHEMA).selectExpr("*", *[f"'x' AS {c}" for c in extra])


def test_templates_of_a_host_go(session):
    rows = [(i, f"https://A.example.com:80/{i}?q", site("A", i, "Welcome")) for i in range(6)]
    rows += [(10 + i, f"http://b.example.com/{i}", site("B", i, "Welcome")) for i in range(3)]
    # The same page again and again is no template.
    rows += [(20 + i, "http://c.example.com/", "<body><div><p>One story.</p></div></body>") for i in range(8)]
    # An article keeps what it shares with others.
    rows += [(40 + i, f"http://d.example.com/{i}", f"<div>top</div><article><p>Quoted.</p><p>{i}</p><div>Share this</div></article>") for i in range(8)]
    got = {r.page_id: r for r in html_extract.extract(pages(session, rows)).collect()}
    assert got[0].text == "Story 0 of A.\n\nSaid so."
    assert got[10].text == "Welcome\n\nhome\n\nabout B\n\nStory 0 of B.\n\nSaid so.\n\nPage made for B"
    assert got[20].text == "One story."
    assert got[40].text == "Quoted.\n\n0"
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_edge_rows(session):
    big = 2**62 + 1
    rows = [(big, None, None), (None, "u", "<p>x"), (2, "u", ""), (3, "u", "<p>😀é"), (3, "u", "<p>😀é"), (4, None, "<p>" + "long " * 100_000)]
    got = html_extract.extract(pages(session, rows))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = sorted(((r.page_id or 0, r.url, r.text[:5], r.n_chars) for r in got.collect()), key=str)
    assert found == sorted([(big, None, "", 0), (0, "u", "x", 1), (2, "u", "", 0), (3, "u", "😀é", 2), (3, "u", "😀é", 2), (4, None, "long ", 499_999)], key=str)
    assert html_extract.extract(pages(session, [])).count() == 0


def test_templates_are_a_share_of_the_pages(session):
    rows = [(i, f"https://a.example.com/{i}", site("A", i, "Welcome")) for i in range(6)]
    for i in range(200):
        quoted = "<p>Quoted on six pages.</p><div><p>Boxed on six pages.</p></div>" if i < 6 else ""
        rows.append((100 + i, f"http://hot.example.com/{i}", f"<body><div><ul><li>home</ul></div><p>Story {i}.</p>{quoted}<p>All rights reserved.</p></body>"))
    got = {r.page_id: r.text for r in html_extract.extract(pages(session, rows)).collect()}
    assert [got[i] for i in range(6)] == [f"Story {i} of A.\n\nSaid so." for i in range(6)]
    assert [got[100 + i] for i in range(200)] == [f"Story {i}." + "\n\nQuoted on six pages.\n\nBoxed on six pages." * (i < 6) for i in range(200)]


def test_recurring_items_of_lists_and_tables_stay(session):
    # Ten of forty recipes share an ingredient and a cell, five of a hundred pages a boxed quotation.
    rows = [(i, f"https://r.example.com/{i}", (
        f"<body><h1>Dish {i}</h1><ul><li>{i} eggs</li>{'<li>1 tsp salt</li>' * (i < 10)}</ul>"
        f"<table><tr><td>fat {i}</td>{'<td>low</td>' * (i < 10)}</tr></table><p>Cook {i}.</p></body>"
    )) for i in range(40)]
    rows += [(100 + i, f"https://q.example.com/{i}", f"<body><p>Page {i}.</p>{'<div><p>Well said.</p></div>' * (i < 5)}</body>") for i in range(100)]
    got = {r.page_id: r.text for r in html_extract.extract(pages(session, rows)).collect()}
    for i in range(40):
        lines = [f"Dish {i}", f"{i} eggs", *["1 tsp salt"] * (i < 10), f"fat {i}", *["low"] * (i < 10), f"Cook {i}."]
        assert got[i] == "\n\n".join(lines)
    assert [got[100 + i] for i in range(100)] == [f"Page {i}." + "\n\nWell said." * (i < 5) for i in range(100)]


def test_menus_go_wherever_they_are(session):
    menu = "<ul><li><a href='/'>Home</a><li><a href='/n'>News</a></ul>"
    rows = [(i, f"https://m.example.com/{i}", f"<main>{menu * (i < 10)}<p>Text {i}</p><ul><li>Home<li>News</ul></main>") for i in range(100)]
    got = {r.page_id: r.text for r in html_extract.extract(pages(session, rows)).collect()}
    assert [got[i] for i in range(100)] == [f"Text {i}\n\nHome\n\nNews" for i in range(100)]
    # Four pages are too few; links among prose are no menu.
    few = [(i, f"https://m.example.com/{i}", f"<main>{menu}<p>Text {i}</p></main>") for i in range(4)]
    few += [(10 + i, f"https://p.example.com/{i}", f"<div>{'See <a>this</a> for more. ' * (i < 6)}</div><p>{i}</p>") for i in range(50)]
    got = {r.page_id: r.text for r in html_extract.extract(pages(session, few)).collect()}
    assert [got[i] for i in range(4)] == [f"Home\n\nNews\n\nText {i}" for i in range(4)]
    assert got[10] == "See this for more.\n\n0" and got[59] == "49"


def made_pages(seed):
    """Pages of three hosts: with an article, without, and some of each."""
    rng = random.Random(seed)
    rows = []
    for host, n, marked in (("a", 30, 1.0), ("b", 60, 0.0), ("c", 45, 0.5)):
        menus = [f"<div><ul>{''.join(f'<li><a href=#>{host}{m}{k}</a>' for k in range(3))}</ul></div>" for m in range(4)]
        notes = [f"<div><p>note {host}{m}</p></div>" for m in range(3)]
        for i in range(n):
            said = "".join(f"<p>said {rng.randrange(4)}</p>" for _ in range(2))
            body = f"<h1>{host} {i}</h1>{said}<ul><li>item {rng.randrange(3)}<li>own {i}</ul>{rng.choice(menus) * (rng.random() < 0.3)}"
            body = f"<article>{body}</article>" if rng.random() < marked else f"<div>{body}</div>"
            rows.append((len(rows), f"http://{host}.example.com/{i}", rng.choice(menus) + body + notes[0] + rng.choice(notes[1:])))
    return rows + rows[:5]


def test_counts_equal_a_direct_count(session):
    rows = made_pages(3)
    got = sorted((r.page_id, r.text) for r in html_extract.extract(pages(session, rows)).collect())
    parsed = [(i, url.split("/")[2], parse(source)) for i, url, source in rows]
    holders = Counter()
    for host, _, kind, h in {(host, tuple(page.texts), kind, h) for _, host, page in parsed for h, kind in [(0, PAGE), *((s[0], s[3]) for s in page.subtrees)]}:
        holders[host, kind, h] += 1
    want, plain = [], []
    for i, host, page in parsed:
        recurring = {
            h for h, _, _, kind in page.subtrees
            if holders[host, kind, h] >= max(html_extract.LEAST[kind][0], html_extract.LEAST[kind][1] * holders[host, PAGE, 0])
        }
        want.append((i, page.main_text(recurring)))
        plain.append((i, page.main_text()))
    assert got == sorted(want)
    assert {kind for _, _, page in parsed for *_, kind in page.subtrees} == {MENU, BOX, PROSE}
    # The template step matters: it changes more than a third of the texts.
    assert sum(a != b for a, b in zip(want, plain, strict=True)) > len(rows) / 3
