from staylens.llm import html_blocks as H

WORDS = "plain words of the main text that go on for a while so that the line is long enough to count"


def page(body, head="<title>Not this</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


def test_article_without_the_rest():
    html = page(
        '<header><h1>Site</h1></header><nav><ul><li><a href="/a">Home</a></li></ul></nav><!-- ad <p>x</p> -->'
        '<div class="cookie-notice">We use cookies and a long explanation of them that nobody ever reads to the end.</div>'
        f"<div class='ad'>{WORDS} {WORDS}</div><article><h1>Head &amp; tail</h1><p><b>{WORDS}.<br><p>Short.</p>"
        f"<p>a  b\n c&nbsp;d &lt;p&gt; &quot;q&quot; &#233;&#x41;</p><script>var t = '</p>' + 1 < 2;</script><style>p{{}}</style>"
        f"<form><p>Sign up</p><input value='x'><button>Go</button></form><p>End</p></article>"
        f"<aside><p>{WORDS}</p></aside><section id=comments><p>{WORDS} {WORDS}</p></section><footer>&copy; me</footer>"
    )
    want = ["Head & tail", f"{WORDS}.", "Short.", 'a b c d <p> "q" éA', "End"]
    assert H.main_text(html) == "\n\n".join(want)


def test_main_text_without_semantic_elements():
    menu = "".join(f'<li><a href="/{i}">A menu entry of several words {i}</a></li>' for i in range(30))
    html = page(
        f'<div id="top"><ul>{menu}</ul></div><div class="content"><h2>Title</h2><p>{WORDS}</p><p>tiny</p><p>{WORDS}</p></div>'
        f'<div class="sidebar">{WORDS}</div><div><div></div><div></div><p>All rights reserved</p></div>'
    )
    assert H.main_text(html) == "\n\n".join(["Title", WORDS, "tiny", WORDS])


def test_inline_markup_links_and_cells():
    html = page(f'<article><p>{WORDS} <a href="x">li</a>nk<i>ed</i></p><table><tr><td>a</td><td>b</td></tr></table></article>')
    assert H.main_text(html) == f"{WORDS} linked\n\na b"


def test_broken_markup():
    assert H.main_text(f"<body><nav><li>x<article><p>{WORDS}<p>next &amp") == f"{WORDS}\n\nnext &"
    assert H.main_text(f"<article><p class=\"open>{WORDS}</p><p>then</p></article>")
    assert H.main_text("<article><p>As.</p></article><footer>a much longer footer line than that</footer>") == "As."
    assert H.main_text("no markup at all") == "no markup at all"
    assert H.main_text("<script>never closed <p>x</p>") == ""
    for empty in (None, "", "<p></p>", "   ", "<nav>only</nav>"):
        assert H.main_text(empty) == ""


def test_given_pages_give_their_article(spark):
    """On the test pages the text is that of the article element, paragraph by paragraph."""
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r["page_id"]: r for r in H.extract(pages).collect()}
    for r in pages.collect():
        article = r["html"].split("<article>")[1].split("</article>")[0]
        parts = re.split(r"</?(?:p|h1|br)>", article.replace("<b>", "").replace("</b>", ""))
        want = "\n\n".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)
        assert got[r["page_id"]]["text"] == want
        assert got[r["page_id"]]["n_chars"] == len(want)


def test_core_is_the_heaviest_stretch():
    assert H.core([0, 0, 0, 0, 200, 0, 5, 300, 0, 0, 0, 0, 90, 0]) == (4, 7)
    assert H.core([0, 3, 0, 0, 0, 0]) == (1, 1)
    assert H.core([0, 0]) is None and H.core([]) is None


def test_odd_rows_and_no_rows(spark):
    rows = [(1, None, None, "old"), (1, "u", "", "old"), (None, "u", f"<p>{'x ' * 60_000}</p>", None), (2, "u", "<p>a</p>", "o")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = H.extract(pages).collect()
    assert sorted(r["n_chars"] for r in out) == [0, 0, 1, 119_999]
    assert H.extract(pages.limit(0)).count() == 0


def test_words_in_attribute_values_are_not_attributes():
    tags = [
        '<p title="a hidden valley">', "<p title='the hidden role=menu'>", '<p data-hidden="false">', '<p data-id="nav">',
        '<p data-href="?id=ads&class=footer">', "<p data-x=?id=nav>", '<p aria-label="style=display:none">', '<p id="x" id="nav">',
    ]
    for tag in tags:
        assert H.main_text(f"<article><p>{WORDS}</p>{tag}kept</p></article>") == f"{WORDS}\n\nkept", tag
    link = f'<article><p>{WORDS} <a href="/hidden-gems">gems</a> and <a href="?id=ads">more</a></p></article>'
    assert H.main_text(link) == f"{WORDS} gems and more"
    for tag in ["<p hidden>", "<p title='x' HIDDEN=''>", '<p title="a>b" class="nav">', "<p id=ads>", "<p data-x=1 role = 'menu'>"]:
        assert H.main_text(f"<article><p>{WORDS}</p>{tag}gone</p></article>") == WORDS, tag


def test_sections_without_article():
    menu = "<ul>" + "".join(f'<li><a href="/{i}">A menu entry of several words {i}</a></li>' for i in range(30)) + "</ul>"
    parts = [[f"Part {i}", f"{i} {WORDS}", f"{WORDS} {i}"] for i in range(4)]
    gaps = ["", "<div></div><div></div><hr><p></p><p></p>", "<aside>Not this, however long it is, because it stands aside.</aside>"]
    for start, end in (("<div>", "</div>"), ("<section><div><div>", "</div></div></section>"), ("<article>", "</article>")):
        for gap in gaps:
            given = [*parts, ["Last", "A short one."]] if not gap else parts
            body = gap.join(start + f"<h2>{h}</h2>" + "".join(f"<p>{x}</p>" for x in rest) + end for h, *rest in given)
            want = "\n\n".join(x for part in given for x in part)
            assert H.main_text(page(menu + body)) == want, (start, gap)
            assert H.main_text(page(f"<div>{menu}</div><div class='with-header has-sidebar'>{body}</div>")) == want, (start, gap)


def test_a_main_element_stands_before_articles_outside():
    html = page(f"<article><p>{WORDS}</p></article><main><p>{WORDS} {WORDS}</p></main><article><p>{WORDS}</p></article>")
    assert H.main_text(html) == f"{WORDS} {WORDS}"
