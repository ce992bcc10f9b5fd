import re
import time

from coffer.llm import htmltext
from coffer.llm.htmltext import main_blocks

PROSE = "This is the story of a house that stood on the hill for so many years, and it was the oldest of all the houses in the land. "


def test_article_alone_stays():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head>
    <body class="nav-open"><header>Site</header><nav><ul><li><a href=x>Home</a></li></ul></nav><div class="ad">Buy it now, it is the best of all.</div>
    <article><header><h1>A  Title</h1></header><p><b>{PROSE}&amp; more&nbsp;<br>here<p>Short.</p><aside>See also the other story of the hill.</aside>
    <div class=cookie-notice>We use cookies.</div><form><p>Name</p><input></form><p hidden>unseen</p><pre>1 &lt; 2</pre>
    <section id="comments"><p>{PROSE}</p></section></article>
    <aside>{PROSE}</aside><footer>&copy; all</footer>"""
    assert main_blocks(page) == ["A Title", f"{PROSE}& more here", "Short.", "1 < 2"]


def test_rules_without_article_element():
    page = f"<div><a href=1>One</a> <a href=2>Two</a></div><h1>Title</h1><p>{PROSE}</p><p>Tiny.</p><p>{PROSE}</p><div>{'zxq wvu ' * 30}</div><p>End</p>"
    assert main_blocks(page) == ["Title", PROSE.strip(), "Tiny.", PROSE.strip()]


def test_odd_pages():
    assert main_blocks("") == [] and main_blocks("<script>never closed <p>x") == [] and main_blocks("<!-- x") == []
    assert main_blocks(f"<article><p>{PROSE}<p>1 < 2 and a > b</article></article></div>")[1] == "1 < 2 and a > b"
    long = " ".join([PROSE.strip()] * 3000)
    assert main_blocks(f"<main><p>{long}</p></main>") == [long]


def test_rows(spark):
    df = spark.createDataFrame(
        [(1, "u", None, "t"), (2, None, "", "t"), (None, "v", f"<article><p>{PROSE}</p></article>", "t")] * 2,
        "page_id long, url string, html string, text string",
    )
    rows = htmltext.extract(df).collect()
    assert sorted(r["text"] for r in rows) == [""] * 4 + [PROSE.strip()] * 2
    assert htmltext.extract(df.limit(0)).collect() == []


def test_pages_give_their_article(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in htmltext.extract(pages).collect():
        article = re.search(r"<article>(.*?)</article>", html[r["page_id"]], re.S)[1]
        plain = re.sub(r"\s+", "", htmltext.unescape(re.sub(r"<[^>]*>", "", article)))
        assert re.sub(r"\s+", "", r["text"]) == plain


def test_legal_pages_lose_nothing():
    body = f"<article><p>{PROSE}</p><p>Second.</p></article>"
    plain = [PROSE.strip(), "Second."]
    assert main_blocks(f"<html><head><title>T</title><meta charset=x><body>{body}") == plain
    assert main_blocks(f"<svg/>{body}") == plain and main_blocks(f"<svg class=x />{body}<svg>{body}") == plain * 2
    for name in ("container responsive", "has-sidebar", "no-header row", "main-content", "sidebar-wrap"):
        assert main_blocks(f'<div class="{name}">{body}</div>') == plain
    assert main_blocks(f"<article><p title=it's>{PROSE}</p><p>It's here.</p></article>") == [PROSE.strip(), "It's here."]
    table = f'<article><p>{PROSE}</p><div class="table-responsive"><table><tr><td>One</td><td>Two</td></tr></table></div></article>'
    assert main_blocks(table) == [PROSE.strip(), "One", "Two"]
    assert main_blocks(f'<article><p>{PROSE}</p><p><a href="x">All of this is a link, in the text</a></p></article>')[1:] == ["All of this is a link, in the text"]
    assert main_blocks("<h1>Menu of the day</h1><p>Soup.</p><p>Bread.</p>") == ["Menu of the day", "Soup.", "Bread."]
    polish = "Dawno temu w odległym lesie mieszkała stara kobieta, która codziennie zbierała grzyby oraz jagody dla dzieci. "
    assert main_blocks(f"<div><a href=1>Start</a></div><p>{polish}</p><p>{polish * 2}</p><p>Koniec</p>")[:2] == [polish.strip(), (polish * 2).strip()]
    comments = f'<section id="comments"><article class="comment"><p>{PROSE}</p></article></section>'
    assert main_blocks(body + comments) == plain
    assert main_blocks('<p>1 <b and more') == ["1 <b and more"]


def test_hostile_pages_take_linear_time():
    started = time.time()
    for piece in ("<a '", '<a b=">"', '<a b="', "<svg>", "<", "</", "<!", "<a =", "<p title=it's>", "<div class='x", "&amp", "<script", "<title"):
        main_blocks(piece * 60_000)
        main_blocks(piece * 60_000 + ">")
    assert time.time() - started < 30


def test_pages_without_article_element(spark):
    """The same pages with plain elements: all of the article is found, and next to nothing else."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    missed = more = whole = 0
    for r in pages:
        article = "\n\n".join(main_blocks(r["html"])).split("\n\n")
        found = main_blocks(re.sub(r"<(/?)article\b", r"<\1div", r["html"]))
        missed += sum(len(b) for b in article if b not in found)
        more += sum(len(b) for b in found if b not in article)
        whole += sum(map(len, article))
    assert missed <= 0.01 * whole and more <= 0.02 * whole
