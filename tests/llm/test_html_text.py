import random

from lexiloom.llm import html_text

MENU = "<nav class=top><ul><li><a href=/a>Home</a></li><li><a href=/b>All the news of the day and of the night</a></li></ul></nav>"
JUNK = [
    MENU, "<header><p>The name of a paper that nobody reads any more</p></header>", "<footer>&copy; someone, all of the years, somewhere</footer>",
    "<aside><p>Other articles that you may like to read instead of this one</p></aside>", "<script>var a='<p>no</p>';</script>",
    "<div class='cookie-notice'>We use cookies to make this page worse for you and better for us</div>", "<style>p{margin:0}</style>",
    "<div id=\"sidebar\"><p>Weather and lottery numbers of this week and of the last</p></div>", "<!-- a comment <p>x</p> -->",
    "<form><p>Write your name and your address into this field</p><input name=q><button>Go</button></form>",
    "<div class=\"ad banner\">Buy one and get another one that you do not need</div>",
    "<section class='comments'><p>First! This is what a reader has to say about all of this</p></section>",
]


def page(rng, close=True):
    words = lambda n: " ".join(rng.choice("some words of an article with é and 😀 in it".split()) for _ in range(n))
    blocks = [words(rng.randrange(1, 60)) for _ in range(rng.randrange(1, 9))]
    html = [f"<h1>{blocks[0]}</h1>"]
    for block in blocks[1:]:
        first, _, rest = block.partition(" ")
        html.append(f"<p><b>{first}</b>\n\t {rest} &amp;&lt;x&gt; &eacute;</p>" if rng.random() < 0.7 else f"<p>{first} <a href=#>{rest}</a> &amp;&lt;x&gt; &eacute;")
    junk = rng.sample(JUNK, rng.randrange(2, len(JUNK)))
    at = rng.randrange(len(junk))
    inside = [*html, rng.choice(["", JUNK[10], JUNK[4], JUNK[8]])]
    whole = "".join(junk[:at]) + "<article>" + "".join(inside) + "</article>" + "".join(junk[at:])
    want = [blocks[0]] + [" ".join(f"{b} &<x> é".split()) for b in blocks[1:]]
    return f"<!DOCTYPE html><html><head><title>no</title></head><body>{whole}" + ("</body></html>" if close else ""), "\n".join(want)


def test_planted_articles():
    rng = random.Random(3)
    for n in range(300):
        html, want = page(rng, n % 3 > 0)
        assert html_text.main_text(html) == want, html


def test_region_without_an_article_element():
    text = "A sentence of the text that is long enough to count as one. " * 4
    html = f"<body><div>{MENU}<div class=x><h2>Head</h2><p>{text}</p><p>Short.</p><p>{text}</p></div><div><a href=1>one</a> <a href=2>two</a></div></div>"
    assert html_text.main_text(html) == f"Head\n{text.strip()}\nShort.\n{text.strip()}"


def test_text_beside_the_dominant_container():
    text = lambda n: ("A sentence of the text. " * (n // 24 + 1)).strip()
    intro, long, end = text(200), text(3_000), "The end of the text, which is short."
    links = "<ul><li><a href=1>one</a></li> <li><a href=2>two</a> | <a href=3>three</a></li></ul>"
    for inner in ("section", "blockquote", "div", "center"):
        around = f"<p>{intro}</p><{inner}><p>{long}</p></{inner}><p>{end}</p>"
        assert html_text.main_text(f"<body>{MENU}<div>{around}</div>{links}</body>") == f"{intro}\n{long}\n{end}"
    body = f"<div><p>{intro}</p><div>" + f"<p>{text(900)}</p>" * 4 + f"</div><p>{end}</p></div>"
    assert html_text.main_text(f"<body>{body}{JUNK[5]}</body>") == "\n".join([intro, *[text(900)] * 4, end])
    assert html_text.main_text(f"<p>{end}</p><div><p>{long}</p></div><p>{end}") == f"{end}\n{long}\n{end}"


def test_the_cluster_decides_without_an_article(monkeypatch):
    """Unmarked boilerplate in containers of its own falls, short lines beside and between the content stay."""
    long = ("A sentence of the text that is long enough to count as one. " * 8).strip()
    before = "<div><p>Our paper since 1950</p><p>All about us and you</p></div><div><span>Monday</span></div>"
    after = "<div><p>Printed in our own house</p></div><div><p>Call us on any day</p><p>Imprint and terms</p></div>"
    middle = f"<div><h2>Head</h2><p>{long}</p><p>Short.</p><div><p>Shorter.</p></div><p>{long}</p><p>{long}</p><p>The end.</p></div>"
    html = f"<body>{before}{middle}{after}</body>"
    want = "\n".join(["Head", long, "Short.", "Shorter.", long, long, "The end."])
    assert html_text.main_text(html) == want
    monkeypatch.setattr(html_text, "_content", lambda ratios: ratios > -1)
    assert "Our paper" in html_text.main_text(html) and "Imprint" in html_text.main_text(html)


def test_class_words_rule_out_small_blocks_only():
    text = ("A sentence of the text. " * 20).strip()
    article = f"<article><p>{text}</p></article>"
    for html in (
        f'<div class="site has-sidebar">{MENU}{article}</div>',
        f'<div class="long-form">{article}</div>',
        f"<nav><ul><li><a href=/>Home</a></ul>{article}",
        f"<body><div class=share><a href=/>Share</a>{article}</div></body>",
        f'<div class="sidebar"><p>{text}</p></div><p>Few words.</p>'.replace("<p>Few words.</p>", ""),
        f'<div class="page header"><main><p>{text}</p></main></div>',
    ):
        assert html_text.main_text(html) == text, html
    comments = "<section class=comments>" + f"<article class=comment><p>{text} {text}</p></article>" * 3 + "</section>"
    assert html_text.main_text(f"<body>{article}{comments}</body>") == text
    assert html_text.main_text(f"<body><main><p>{text}</p></main><div id=comments>{comments}</div></body>") == text
    assert html_text.main_text(f"<aside><article><p>{text}</p></article></aside><main><p>The text.</p></main>") == "The text."


def test_words_of_classes():
    for value in ("sidebar", "cookie-notice", "x site_header", "ad", "AD banner", "widget-2", "post-comments"):
        assert html_text.marks(value), value
    for value in ("has-sidebar", "long-form", "content", "advice", "comment-free zone", "two-column-header-image", ""):
        assert not html_text.marks(value), value


def test_odd_pages(spark):
    long = "<p>" + "long text " * 50_000
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<p"), (4, None, "&am"), (5, "u", "</p></div>plain &amp"), (6, "u", long), (None, "u", "<nav>x</nav>"), (2, "u", "")]
    pages = spark.createDataFrame([(*r, "clash", 3) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    found = html_text.extract(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = {r.page_id: (r.text, r.n_chars) for r in found.collect()}
    assert got[1] == got[2] == got[None] == ("", 0)
    assert got[4] == ("&am", 3) and got[5] == ("plain &", 7) and got[6][1] == 499_999
    assert found.count() == len(rows)
    assert html_text.extract(pages.limit(0)).count() == 0
