import html
import re
import time

import pytest

from loanfold.llm import htmltext

PAGES = "page_id long, url string, html string, text string, n_chars string"
LONG = ("The house that was built on the hill is one of the oldest in the town and it has been the home of many who came there to "
        "work in the mines. It was sold to the city after the war, and for a time there were plans to make it a museum. ")


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], PAGES)


@pytest.mark.parametrize("page,text", [
    ("", ""),
    ("plain", ""),
    (f"<p>{LONG}</p>", LONG.strip()),
    (f"<body><div>Menu</div><h1>Old house</h1><p>{LONG}</p><p>Quite so.</p><p>{LONG}</p><div><a href=x>Next</a> | <a>Up</a></div></body>",
     f"Old house\n{LONG.strip()}\nQuite so.\n{LONG.strip()}"),
    ("<nav><ul><li>Home<li>News</ul></nav><article><h1>A &amp; B</h1><p>Of.</p></article><footer>&copy; x</footer>", "A & B\nOf."),
    (f"<article><p>One<br>two\n three</p><aside>{LONG}</aside><div class='comments'><p>{LONG}</p></div><p>End &lt;p&gt;</article>",
     "One two three\nEnd <p>"),
    (f'<script>var a="<p>{LONG}</p>"</script><style>p{{}}</style><!-- <p>{LONG}</p> --><p class="cookie-notice">{LONG}</p><p>{LONG}',
     LONG.strip()),
    (f"<form><p>{LONG}</p></form><article><p>In <b>bold <i>and</b> more</i> &eacute; &#8364;</p><form>Say<textarea><p>x</textarea></form></article>",
     "In bold and more é €"),
    (f"<div id=sidebar><p>{LONG}</p></div><main><p title='a > b'>Kept</p></main>", "Kept"),
    ("<article>" + "<p>word word</p>" * 3 + "</article><p>word</p>", "word word\nword word\nword word"),
    (f"<!-- open <p>{LONG}</p>", ""),
    (f"<p>{LONG}</p><script>never closed <p>{LONG}</p>", LONG.strip()),
    (f"<div class='site-header'><p>{LONG}</p></div><div class='post-content'><div class=entry-header><h2>Title</h2></div><p>Short.</p>"
     f"<div id='reader-comments'><p>{LONG}</p></div></div><div class='ad-slot'>{LONG}</div>", "Title\nShort."),
    ("<article><p>One</p><button>Share</button><P>Two<BR/>three</P></article>", "One\nTwo three"),
    (f"<article><p>{LONG}</p><p>5 < 6 and 7 > 3</p></article>", f"{LONG.strip()}\n5 < 6 and 7 > 3"),
])
def test_pages(page, text):
    assert htmltext.main_text(page) == text


ITALIAN = ("La casa costruita sulla collina è tra le più antiche della città e vi abitarono molti che vennero a lavorare nelle miniere. "
           "Dopo la guerra fu venduta al comune, che per qualche tempo pensava di farne un museo dedicato alla storia dei minatori. ")
CHINESE = "山上的那座房子是镇上最古老的房子之一，许多来矿山工作的人都曾住在那里。战争结束后，它被卖给了市政府，有一段时间人们计划把它改成博物馆，展示矿工的历史。" * 2
SHORTER = "The house on the hill was sold to the city after the war, and for a time there were plans to make it into a museum for all of us to see."
MENU = "<div><a href=a>Home</a> <a href=b>News</a> <a href=c>About us</a> <a href=d>All our other pages and sites in one list</a></div>"


@pytest.mark.parametrize("page,text", [
    (f"<body>{MENU}<div>{ITALIAN}</div><div>{ITALIAN}</div>{MENU}</body>", f"{ITALIAN.strip()}\n{ITALIAN.strip()}"),
    (f"<body>{MENU}<div>{CHINESE}</div><div>{CHINESE}</div>{MENU}</body>", f"{CHINESE}\n{CHINESE}"),
    (f"<body><div>{SHORTER}</div></body>", SHORTER),
    (f"<body>{MENU}<div>{SHORTER}</div>{MENU}</body>", SHORTER),
    (f"<article><p class='social-history'>{LONG}</p><section id='privacy'><h2>Privacy</h2><p>{LONG}</p></section>"
     "<li class='notice'>Of note.</li><div class='menu-of-the-day'>Soup and bread.</div></article>",
     f"{LONG.strip()}\nPrivacy\n{LONG.strip()}\nOf note.\nSoup and bread."),
    (f"<article><p>{LONG}</p><div class='social-share'>Share this</div><section class='comments-section'><p>{LONG}</p></section>"
     f"<div class='newsletter-signup'>Our letter</div><div class='related-posts'><p>{LONG}</p></div><p>End.</p></article>", f"{LONG.strip()}\nEnd."),
    (f"<div><p>{LONG}</p><p>See <a href=m>the old map</a>.</p><p>{LONG}</p></div>", f"{LONG.strip()}\nSee the old map.\n{LONG.strip()}"),
    (f"<div><p>{LONG}</p><pre>" + "x = f(y)\n" * 40 + f"</pre><p>{LONG}</p></div>", f"{LONG.strip()}\n{'x = f(y) ' * 39}x = f(y)\n{LONG.strip()}"),
])
def test_articles_are_kept_whole(page, text):
    assert htmltext.main_text(page) == text


@pytest.mark.parametrize("page", [
    "<div>" * 50_000 + "</p>" * 50_000, "<div>" * 50_000 + "</div>" * 50_000, "<!" * 100_000, "<a " * 50_000, '<a "' * 20_000, "<a '\"" * 20_000 + ">",
    "<!--" * 50_000, "<script " * 50_000, "</" * 100_000, "<p>" * 50_000, "&" * 200_000, "<li>" * 50_000 + "</ul>" * 50_000, "<a b=c " * 30_000 + ">",
], ids=range(13))
def test_linear_time(page):
    start = time.perf_counter()
    htmltext.main_text(page)
    assert time.perf_counter() - start < 3


def test_given_pages_give_their_articles(spark):
    """The given pages have one article each, which the rules must find whole without being told its place."""
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r for r in htmltext.extract(df).collect()}
    rows = df.collect()
    assert len(found) == len(rows)
    for r in rows:
        inner = r.html[r.html.index("<article>"):r.html.index("</article>")]
        parts = re.split("</?(?:p|h1|article)>", inner.replace("<br>", " "))
        lines = [" ".join(html.unescape(re.sub("</?[a-z][^>]*>", "", x)).split()) for x in parts]
        assert found[r.page_id].text == "\n".join(x for x in lines if x)
        assert found[r.page_id].n_chars == len(found[r.page_id].text) and found[r.page_id].url == r.url


def test_rules_do_without_article_elements(spark):
    """With plain div elements for article, nav and footer, stop words and links still find most of the text."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    share = []
    for r in rows:
        plain = re.sub(r"<(/?)(?:article|nav|footer)>", r"<\1div>", r.html)
        whole, mine = htmltext.main_text(r.html).split("\n"), htmltext.main_text(plain).split("\n")
        if sum(map(len, whole)) > 600:
            share.append(sum(len(x) for x in mine if x in whole) / sum(map(len, whole)))
    assert sum(share) / len(share) > 0.8


def test_odd_rows(spark):
    long = f"<article><p>{LONG * 5000}</p></article>"
    rows = [(1, "u", None), (1, "u", ""), (None, None, f"<p>{LONG}"), (2, "v", long), (3, "w", "<a " * 20_000), (4, "w", "<" * 20_000)]
    found = sorted(((r.page_id, r.url, r.text) for r in htmltext.extract(pages(spark, rows)).collect()), key=repr)
    assert found[:2] == [(1, "u", ""), (1, "u", "")] and (None, None, LONG.strip()) in found and len(found) == 6
    assert (2, "v", " ".join((LONG * 5000).split())) in found
    assert htmltext.extract(pages(spark, rows).filter("false")).collect() == []
