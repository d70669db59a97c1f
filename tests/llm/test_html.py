from corpuslens.llm import html

ARTICLE = "<h1>A heading &amp; more</h1><p>First  paragraph\n with <a href='/x'>a link</a> and <b>bold<br>text</p><p>Short.</p><p>Last paragraph of the article, long enough to weigh something &mdash; really."
WANT = ["A heading & more", "First paragraph with a link and bold text", "Short.", "Last paragraph of the article, long enough to weigh something — really."]
NAV = "<ul>" + "".join(f"<li><a href='/{n}'>Menu entry {n}</a></li>" for n in range(12)) + "</ul>"


def page(body):
    return f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var x='</p><p>no';</script></head><body>{body}</body></html>"


def test_article_element():
    body = f"<nav>{NAV}</nav><!-- no --><div class='ad'>Buy things now, buy more.</div><article>{ARTICLE}</article><footer>&copy; x</footer>"
    assert html.content(page(body)) == WANT
    assert html.content(page(body)[: page(body).index("&copy;") + 3]) == WANT  # cut in the footer


def test_boxes_without_names():
    body = (
        f"<div>{NAV}</div><div class='wrap'><div class='body-text'>{ARTICLE}</p></div>"
        "<div id='comments'><p>I disagree with all of this, says a reader at some length.</p></div></div>"
        "<aside><p>Side story with a fairly long text that is not the article.</p></aside>"
        "<form><p>Your mail address here, please, for more letters.</p><input></form>"
        "<div class='cookie-notice'><p>We use cookies for this and that, as everybody does.</p></div>"
        f"<div role='navigation'>{NAV}</div><header><p>Site header words</p></header><noscript><p>enable it</p></noscript>"
    )
    assert html.content(page(body)) == WANT


def test_menu_inside_the_article_goes_and_lists_stay():
    body = f"<article>{ARTICLE}</p><ul><li>One item</li><li>Another item</li></ul>{NAV}</article>"
    assert html.content(page(body)) == [*WANT, "One item", "Another item"]


def test_sections_stay_together():
    text = "<p>" + "words of a section that is long enough to count here " * 4 + "</p>"
    body = f"<div>{NAV}</div><div class='story'><h1>Top</h1><section><h2>S1</h2>{text}{text}{text}</section><section><h2>S2</h2>{text}</section></div>"
    found = html.content(page(body))
    assert found[:2] == ["Top", "S1"] and "S2" in found and len(found) == 7


def test_names_of_boxes_around_the_article():
    body = f"<div class='no-sidebar related'>{ARTICLE}</p><div class='comments'><article class='comment'><p>I was first to say so.</p></article></div></div><div class='sidebar'><p>Other stories of the day.</p></div>"
    assert html.content(page(body)) == WANT


def test_broken_markup():
    for text in ("", "<", "<p", "plain words", "<a b='", "</div></p>", "<table><tr><td>x", "<script>never closed", "&amp", "<p a=\"1>2\">q</p>"):
        assert isinstance(html.content(text), list)
    assert html.content("plain words") == ["plain words"]
    assert html.content("<p a=\"1>2\">q</p>") == ["q"]
    assert html.content("<div>" * 5000 + "deep" + "</div>" * 5000) == ["deep"]


def test_one_row_per_page(spark):
    rows = [(1, "u", page(f"<article>{ARTICLE}</article>"), "x"), (1, "u", page(f"<article>{ARTICLE}</article>"), "x"), (2, None, None, "x"), (None, "v", "", None), (3, "w", "<p>é漢</p>" , "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = html.extract(pages)
    got = sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in out.collect())
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert got == [(0, "", 0), (1, "\n\n".join(WANT), len("\n\n".join(WANT))), (1, "\n\n".join(WANT), len("\n\n".join(WANT))), (2, "", 0), (3, "é漢", 2)]
    assert html.extract(pages.limit(0)).count() == 0


LONG = "<p>" + "A sentence of plain text that goes on for a while, as articles do. " * 6 + "</p>"


def test_ambiguous_names_do_not_delete_the_article():
    for attrs in ("class='legal'", "id='search-results'", "class='social-history'", "class='copyright-case'"):
        for tag in ("div", "section"):
            found = html.content(page(f"<{tag} {attrs}><h2>Top</h2>{LONG}{LONG}</{tag}><div>short</div>"))
            assert found[0] == "Top" and len(found) == 3, (tag, attrs)
    kept = html.content(page(f"<div><h2>Top</h2>{LONG}{LONG}</div><div class='legal'><p>All rights reserved by us.</p></div>"))
    assert len(kept) == 3
    assert html.content(page(f"<div class='comments'>{LONG}</div>")) == []


def test_an_article_in_boxes_beside_each_other():
    text = lambda n: "<p>" + "x" * 300 + f"{n}</p>"
    body = f"<div>{NAV}</div><div>{text(1)}</div><div>{''.join(text(n) for n in range(2, 7))}</div><div>{text(7)}</div><div>no paragraph</div>"
    assert [b[-1] for b in html.content(page(body))] == list("1234567")


def test_hostile_pages_take_linear_time():
    import time

    count = 1_000_000
    for text in (
        "<b>" * (count // 6) + "<p>" * (count // 6), "<b>" * (count // 7) + "</i>" * (count // 7), "<div>" * (count // 5), "<p><b>" * (count // 6),
        "<ul><li>x" * (count // 9), "<a b=\"" * (count // 6), "<" * count, "&" * count, "<div class='legal'>x" * (count // 20), "<!--" * (count // 4),
    ):
        started = time.process_time()
        html.content(text)
        assert time.process_time() - started < 10, text[:30]


def test_density_decides_without_named_boxes(monkeypatch):
    teasers = "<div>" + "".join(f"<div><p>Seen in the town today <a href='/{n}'>story number {n} to click on</a></p></div>" for n in range(40)) + "</div>"
    body = f"{teasers}<div><h2>Top</h2>{LONG}{LONG}</div>"
    found = html.content(page(body))
    assert found[0] == "Top" and len(found) == 3
    monkeypatch.setattr(html, "composite", lambda node, share: float(node.chars))
    assert html.content(page(body)) != found


def test_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "u", f"<article>{LONG}</article>", 7, "t")], "page_id long, url string, html string, n_chars long, text string")
    assert html.extract(pages).columns == ["page_id", "url", "text", "n_chars"] and html.extract(pages).first()["n_chars"] > 100
