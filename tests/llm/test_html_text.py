import html
import random
import re
import time

from tripmart.llm.html_text import main_text, page_texts, smoothed, two_clusters

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x}</style><script>var t="</p>";</script></head><body>
<header><a href=/>Site</a></header><nav><ul><li><a href="/a">A</a></li></ul></nav><!-- ad > 1 --><div class="ad">Buy now, a very long
advert text that goes on and on for quite a while</div><div class="cookie-notice">We use cookies</div>
<article><header><h1>Title &amp; more</h1><span>by someone</span></header><p>First   paragraph with <b>bold</b>
text&nbsp;and more words<br>here.<p>Short.</p><aside>Related</aside><form><input><label>Name</label></form>
<div id="comments"><p>A reader's comment that is long enough to be text</p></div><ul><li>Point one</li><li>Point two</li></ul></article>
<div class="sidebar">Side</div><footer>&copy; x</footer></body></html>"""


def test_article_without_the_rest():
    want = "Title & more\nFirst paragraph with bold text and more words here.\nShort.\nPoint one\nPoint two"
    assert main_text(PAGE) == want


def test_pages_without_article():
    long = "Words of the main text that run on for a good while. " * 4
    page = f"<body><div class=menu><a>x</a></div><div><p>{long}</p><p>Tiny.</p><p>{long}</p></div><div><a>l</a><a>m</a></div></body>"
    assert main_text(page).split("\n") == [long.strip(), "Tiny.", long.strip()]
    assert main_text("plain text &lt;only&gt;") == "plain text <only>"


def test_cut_off_and_odd_pages():
    odd = {"<p>a<b": "a", "<!-- x > y": "", "<script>x": "", "<article>a<style>b": "a", "<article>x &am": "x &am", None: "", "": "",
           "<p>1 < 2": "1 < 2", "</p></div>a": "a", "<div><article><div>x</article>y</div>": "x", "&#x41;&#66;&bogus;": "AB&bogus;"}
    assert {k: main_text(k) for k in odd} == odd
    assert len(main_text("<article>" + "<p>word</p>" * 20_000)) == 5 * 20_000 - 1


def test_smoothing_and_clusters():
    assert smoothed([1.0] * 5) == [1.0] * 5 and 5 < smoothed([0, 0, 20, 0, 0])[2] < 10
    assert two_clusters([1, 2, 1, 90, 100]) > 2 and two_clusters([3, 3]) == 3


def test_rows(spark):
    rows = [(1, "u", "<p>é</p>", "t"), (1, "u", "<p>é</p>", "t"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(tuple, page_texts(df).collect()), key=repr)
    assert got == [(1, "u", "é", 1), (1, "u", "é", 1), (None, None, "", 0)]
    assert page_texts(df.limit(0)).collect() == []


def block(n, word="Words"):
    return " ".join([f"{word} of the main text that run on for a while."] * n)


def test_pages_without_article_keep_all_content():
    menu = "<div><a href=/a>Home</a><a href=/b>News</a></div>"
    parts = [block(4, "Intro"), block(3, "Item"), block(3, "Other")]
    listed = f"<div><p>{parts[0]}</p><ul><li>{parts[1]}</li><li>{parts[2]}</li></ul></div>"
    table = f"<div><p>{parts[0]}</p><table><tr><td>{parts[1]}<td>{parts[2]}</table></div>"
    sections = f"<div><section><p>{parts[0]}</p></section><section><p>{parts[1]}</p><p>Short.</p></section><section>{parts[2]}</section></div>"
    for body, want in (
        (listed, parts), (table, parts), (sections, [*parts[:2], "Short.", parts[2]]),
        (f"<h1>Title</h1><div>by <a>someone</a></div>{listed}", ["Title", *parts]),
    ):
        got = main_text(f"<body>{menu}{body}{menu}</body>").split("\n")
        assert [x for x in got if not x.startswith("by ")] == want
    siblings = "".join(f"<article><p>{x}</p></article>" for x in parts)
    assert main_text(f"<body>{menu}<main><h1>All</h1>{siblings}</main></body>").split("\n") == ["All", *parts]


def test_names_that_are_not_boilerplate():
    text = block(4)
    for attrs in ("class='content with-sidebar'", "class='no-comments'", "id=content-sidebar", "class='sidebar'"):
        assert main_text(f"<body><div><a>x</a></div><div {attrs}><p>{text}</p><p>Tiny.</p></div>").split("\n") == [text, "Tiny."]
    page = (f"<article><div class='post-header'><h1>T</h1></div><h2 id='related-work'>Related</h2><p>{text}</p><h2 id=header-format>F</h2>"
            f"<section id='search-methods'><h3 class=header id=search>S</h3><p id=notice-1>{text}</p></section>"
            "<p class=share>Share it<p>Last.<div class='share-buttons'>Tell</div><div id=commentList>c</div><p class=ad>Buy</p></article>")
    assert main_text(page).split("\n") == ["T", "Related", text, "F", "S", text, "Last."]


def test_adverts_and_comments_go_under_any_name():
    text = block(2)
    names = ("user-comments comment-body comment-thread commentlist ad-slot promo-card breadcrumb-trail ad_300x250 reader-comments"
             " comments-area td-comment-list sidebarRight newsletter-optin").split()
    for name in names:
        for noise in (f"<section class='{name}'><p>{block(1, 'Noise')}</p></section>", f"<div class='x {name}'>{block(9, 'Noise')}</div>"):
            assert main_text(f"<article><p>{text}</p>{noise}<p>End.</p></article>") == f"{text}\nEnd.", (name, noise)
            assert main_text(f"<article><p>{text}</p><p>End.</p></article>{noise}") == f"{text}\nEnd.", (name, noise)
            if "comment" in name:
                assert main_text(f"<div class=content><p>{text}</p><p>End.</p></div>{noise}") == f"{text}\nEnd.", (name, noise)
    for name in names[:8]:
        assert main_text(f"<article><p>{text}</p><div id='{name}'><p>Noise</p></div><p>End.</p></article>") == f"{text}\nEnd.", name
    for name in ("comments-on-the-text", "navigation-of-ships", "cookie-recipes", "advertising-in-print", "nocomment"):
        page = f"<article><p>{text}</p><section id='{name}'><p>Stays.</p></section></article>"
        assert main_text(page) == f"{text}\nStays.", name


def test_time_is_linear():
    for html, n in (("<div>a", 100_000), ("<p class=ad>a", 50_000), ("<div class=ad>a", 50_000), ("<header>a", 50_000)):
        start = time.process_time()
        main_text(html * n)
        assert time.process_time() - start < 15, html
    assert main_text("<article>" + "<div>" * 60_000 + "</span></p>" * 60_000 + "<p>x") == "x"


def random_page(rng):
    """(html, blocks of the article) built side by side."""
    word = lambda: rng.choice(["alpha", "be", "gamma&amp;x", "d&eacute;lta", "x", "<b>bold</b>", "<i>it</i>"])
    plain = lambda s: html.unescape(re.sub("<[^>]*>", "", s))
    blocks = []

    def text(n):
        words = [word() for _ in range(rng.randint(1, n))]
        blocks.append(plain(" ".join(words)))
        return rng.choice([" ", "  ", "\n"]).join(words)

    noise = lambda: rng.choice([
        "", "", "<nav><ul><li><a href=/x>home</a></li></ul></nav>", "<div class='ad-slot'>buy <p>now</p></div>", "<script>var a='<p>';</script>",
        "<aside><p>related</p></aside>", "<form><label>mail</label><input></form>", "<div class='share-buttons'><a>t</a></div>",
        "<!-- <p>no</p> -->", "<section class='reader-comments'><article><p>I say</p></article></section>", "<p class=advert>Buy"])

    def inside(depth):
        out = []
        for _ in range(rng.randint(1, 4)):
            kind = rng.randrange(6 if depth else 3)
            if kind == 0:
                out.append(f"<p>{text(40)}</p>")
            elif kind == 1:
                out.append(f"<h2 id='search-ads'>{text(4)}</h2>")
            elif kind == 2:
                out.append("<ul>" + "".join(f"<li>{text(8)}" for _ in range(rng.randint(1, 3))) + "</ul>")
            elif kind == 3:
                out.append(f"<div class='no-comments'>{inside(depth - 1)}</div>")
            elif kind == 4:
                out.append(f"<section>{inside(depth - 1)}</section>")
            else:
                out.append(f"<table><tr><td>{text(6)}<td>{text(6)}</table>")
            out.append(noise())
        return "".join(out)

    title = text(5)
    body = f"<article><header><h1>{title}</h1><span>by x</span></header>{inside(3)}</article>"
    page = f"<html><head><title>t</title></head><body><header>Site</header>{noise()}{body}{noise()}<footer>f</footer></body></html>"
    return page, blocks


def test_random_pages_equal_what_they_were_built_from():
    rng = random.Random(9)
    for _ in range(400):
        page, blocks = random_page(rng)
        assert main_text(page) == "\n".join(blocks), page
