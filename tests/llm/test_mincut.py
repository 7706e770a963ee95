"""Main text by minimum cut: pages with known text, and the cut against brute force."""

import html
import itertools
import random
import re

from tests.llm.helpers import clash
from tresoria.llm import mincut

SF = "/root/testdata/sf0.001"


def article_text(page):
    """The article of a given page, cut out by its own tags."""
    inner = re.search(r"<article>(.*?)(</article>|<footer>|\Z)", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner))
    parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in parts]
    return "\n".join(x for x in parts if x)


def test_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    source = {r.page_id: r for r in pages.collect()}
    rows = mincut.extract(clash(pages)).collect()
    assert len(rows) == len(source)
    for r in rows:
        assert (r.url, r.text, r.n_chars) == (source[r.page_id].url, article_text(source[r.page_id].html), len(r.text))


def test_boilerplate_of_many_kinds():
    body = "The first paragraph of the article says a few plain things, and it ends here."
    more = "A second one &amp; its <i>inline</i> parts&nbsp;keep<br>to one   line &#8212; always."
    page = f"""<html><head><title>No</title><style>p{{}}</style></head><body class="has-sidebar">
    <header><a href=/>Site</a> <p>A slogan that is a whole sentence, too.</p></header>
    <div class="cookie-notice"><p>We use cookies to make this site better for you, dear reader.</p></div>
    <nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>
    <main><article><header><h1>A <em>title</em></h1></header><p>{body}<p>{more}
    <div class="advert"><p>Buy this now, it is the best offer that you will ever see.</p></div>
    <form><label>Mail</label><input value="x"><button>Send it to us now.</button></form>
    <aside><p>A side remark that is long enough to look like a paragraph of text.</p></aside>
    <script>document.write("<p>not text</p>")</script><!-- <p>nor this</p> -->
    <blockquote>He said: "yes."</blockquote></article>
    <section id="comments"><div><p>Great article, I liked it a lot and will come back.</p></div></section></main>
    <div id="sidebar"><p>Read these other articles, they are just as good as this.</p></div>
    <footer><p>&copy; 2020 by us, all of it, and nobody else.</p></footer></body>"""
    assert mincut.main_text(page).split("\n") == [
        "A title", body, "A second one & its inline parts keep to one line — always.", 'He said: "yes."']


def test_page_without_article_tag():
    para = ["Some plain prose that fills a paragraph, as articles do; it goes on for a while and ends.",
            "Short one.", "More prose after it, again with enough words to look like a part of the text."]
    menu = "".join(f"<li><a href=/{i}>Item {i}</a></li>" for i in range(6))
    page = f"<body><ul>{menu}</ul><div><h2>Heading</h2>{''.join(f'<p>{p}</p>' for p in para)}</div><ul>{menu}</ul>"
    assert mincut.main_text(page).split("\n") == ["Heading", *para]


PROSE = ["Some plain prose that fills a paragraph, as articles do; it goes on for a while and ends.",
         "More prose after it, again with enough words to look like a part of the text."]
PARAS = "".join(f"<p>{p}</p>" for p in PROSE)
ASIDE = "Read these other articles too, they are just as good as this one is, or better."


def test_head_without_its_end_tag():
    for start in ("<body>", "", "<article>", "<template><p>not shown</template><body>"):
        page = f"<html><head><title>No</title><meta charset=utf-8><style>p{{}}</style>\n{start}{PARAS}"
        assert mincut.main_text(page).split("\n") == PROSE
    assert mincut.main_text(f"<head><title>No</title>{PROSE[0]}") == PROSE[0]
    assert mincut.main_text(f"<head><template><p>{ASIDE}</template></head><body>{PARAS}").split("\n") == PROSE


def test_layout_around_the_content_is_no_boilerplate():
    side = f'<div id="sidebar"><p>{ASIDE}</p></div><div id="comments"><article><p>{ASIDE}</p></article></div>'
    for name in ("layout has-sidebar", "no-comments", "with-header", "layout hasSidebar", "sidebar-left", "widget"):
        for tag in ("article", "main", "div"):
            page = f'<body><div class="{name}"><{tag}>{PARAS}</{tag}>{side if tag != "div" else side.replace("article", "div")}</div>'
            assert mincut.main_text(page).split("\n") == PROSE, (name, tag)
    # a marked part beside the content stays out, an article in it too
    for part in (side, f'<div class="comment-list"><article class="comment"><p>{ASIDE}</p></article></div>'):
        for tag in ("article", "main", "div"):
            assert mincut.main_text(f"<body><{tag}>{PARAS}</{tag}>{part}").split("\n") == PROSE, (part, tag)
    assert mincut.main_text(f'<body><div class="cookie-notice"><p>{ASIDE}</p></div>') == ""


def test_marks_on_all_of_the_content():
    nav = "<nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>"
    side = f'<div id="sidebar"><p>{ASIDE}</p></div>'
    for page in (f"<form id=aspnetForm>{nav}<div>{PARAS}</div></form>", f"<form id=aspnetForm><article>{PARAS}</article>{side}</form>",
                 f"<form><div class=content>{PARAS}</div></form>", f'<article><section class="story-related-bridge">{PARAS}</section></article>{side}',
                 f'{nav}<div class="social"><div class="post">{PARAS}</div></div>'):
        assert mincut.main_text(f"<body>{page}").split("\n") == PROSE, page
    # a form, a discussion, a teaser or a marked part beside unmarked prose stays out, whatever it holds
    for part in (f"<form><p>{ASIDE}</p></form>", f"<div id=discussion><div class=post><p>{ASIDE}</p></div></div>", f"<div class=teaser><p>{ASIDE}</p></div>",
                 f'<div id=comments><div class="comment-content">{PARAS * 5}</div></div>'):
        for tag in ("article", "div"):
            assert mincut.main_text(f"<body><{tag}>{PARAS}</{tag}>{part}").split("\n") == PROSE, part
    assert mincut.main_text(f'<body><div id=comments><div class="text">{PARAS}</div></div>') == ""


def test_the_cut_decides_where_the_classifier_is_wrong():
    link = "<p><a href=/a>See also this</a></p>"
    page = f"<body><ul><li><a href=/>Home page</a><li><a href=/b>All of them</a></ul><div><p>{PROSE[0]}</p>{link}<p>{PROSE[1]}</p></div>"
    blocks = mincut.blocks_of(page)
    by_sign, by_cut = [mincut.score(b) > 0 for b in blocks], mincut.label(blocks)
    assert by_sign == [False, False, True, False, True] and by_cut == [False, False, True, True, True]


def test_deep_and_long_pages_in_linear_time():
    import time
    took = []
    for n in (10_000, 40_000):
        start = time.process_time()
        assert mincut.main_text("<div class=x>words of it " * n).count("\n") == n - 1
        took.append(time.process_time() - start)
    assert took[1] < 10 * took[0] + 1


def test_broken_html_never_fails():
    rng = random.Random(4)
    parts = ["<p>", "</p>", "<div class='x", "\"", "'", "<", ">", "<!--", "-->", "<script>", "</script", "&amp", "&#0;", "<a href=",
             "text. ", "</", "<br/>", "<table><tr><td>", "<li>", "</ul>", "<![CDATA[", "é🙂", "<p hidden>", "\n"]
    for _ in range(400):
        mincut.main_text("".join(rng.choice(parts) for _ in range(rng.randint(0, 40))))
    assert mincut.main_text(None) == mincut.main_text("") == mincut.main_text("<p></p>") == ""
    mincut.main_text("<a '" * 20_000)
    assert len(mincut.main_text("<article>" + "<p>Words of prose, and more.</p>" * 3000).split("\n")) == 3000


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, None), (None, "u", ""), (1, "u", "<p>x"), (1, "u", "<p>x")],
                               "page_id long, url string, html string")
    got = sorted((str(r.page_id), str(r.url), r.text) for r in mincut.extract(df).collect())
    assert got == sorted([("1", "None", ""), ("None", "u", "")] + [("1", "u", mincut.main_text("<p>x"))] * 2)
    assert mincut.extract(df).count() == 4 and mincut.extract(df.limit(0)).count() == 0


def test_cut_is_the_cheapest_labelling():
    rng = random.Random(8)
    for _ in range(150):
        n = rng.randint(1, 8)
        src, snk = ([rng.choice([0.0, rng.random() * 3]) for _ in range(n)] for _ in range(2))
        edges = [(a, b, rng.random() * 2) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.4]

        def cost(side):
            return (sum(snk[i] if s else src[i] for i, s in enumerate(side))
                    + sum(c for a, b, c in edges if side[a] != side[b]))
        best = min(cost(x) for x in itertools.product([True, False], repeat=n))
        assert abs(cost(mincut.max_flow_side(n, src, snk, edges)) - best) < 1e-9
