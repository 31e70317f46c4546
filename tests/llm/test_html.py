import re
from html import unescape

import pytest
from pyspark.sql import functions as F

from rollcall.llm import html, queries
from tests.conftest import rows
from tests.llm.conftest import SMALL


def page(body):
    return html.Page(body)


def own(body):
    return html.page_text(body)


BODY = "<p>First paragraph, long enough to be the article of this page.</p><p>Second &amp; last one, also of some length.</p>"
TEXT = "First paragraph, long enough to be the article of this page.\nSecond & last one, also of some length."


@pytest.mark.parametrize(
    "around",
    [
        "<html><head><title>T</title><style>p{{}}</style></head><body><nav><a href=/>Home</a></nav><article>{}</article></body></html>",
        "<body><header><h1>Site</h1></header><main><div class=ad>Buy it</div>{}<aside>More</aside></main><footer>&copy; us",
        "<div id='menu'><ul><li>A<li>B</ul></div><div class=\"post\">{}<form><input>Your mail</form></div><div class='comments'><p>First! I am a reader with a rather long opinion on it.</p></div>",
        "<script>var a='</p><p>no';</script><div>{}<!-- <p>hidden</p> --><script>x<y</script></div><noscript>on</noscript>",
        "<table><tr><td><a href=x>one</a></td><td>{}</td></tr></table>",
    ],
)
def test_the_article_and_nothing_else(around):
    assert own(around.format(BODY)) == TEXT


def test_white_space_references_and_inline_markup():
    assert own("<article><p>a \n\t b&nbsp;c <b>bo</b>ld<br>x &lt;y&gt; &#8364;&#x41;</p></article>") == "a b c bold x <y> €A"
    assert own("<article><h1>T</h1><p>open<p>next<ul><li>one<li>two</ul>tail</article>") == "T\nopen\nnext\none\ntwo\ntail"


def test_broken_markup_ends_somewhere():
    for bad in ("", "<", "<p", "<a href='x", "<p>a</div></p></span>b", "<!-- open", "<script>open", "<b><i><p>x", "&#xZZ; &bogus;", "</p>" * 50):
        assert isinstance(own(bad) or "", str)
    assert own("<div>" * 400 + "deep text here" + "</div>" * 400) == "deep text here"


INTRO, MAIN = "An opening that says what is to come. " * 8, "The text itself, sentence after sentence. " * 18
POST = f"<body><div class=top>Some site</div><div class=post><h1>Headline</h1><div class=intro>{INTRO}</div><div class=text>{MAIN}</div></div></body>"


def test_an_article_in_several_containers(spark):
    want = f"Headline\n{INTRO.strip()}\n{MAIN.strip()}"
    assert own(POST) == want
    # side by side in the body: both paths are voted for, and a page whose opening is short follows its host
    pair = "<body><div class=lead>{}</div><div class=rest>{}</div><div class=end>Bye</div></body>"
    pages = [(i, "http://h.org/", pair.format(INTRO, MAIN)) for i in range(4)] + [(9, "http://h.org/", pair.format("Short.", MAIN))]
    pages += [(20 + i, "http://p.org/", POST) for i in range(3)]
    df = spark.createDataFrame(pages, "page_id int, url string, html string")
    found = {r["host"]: (r["paths"], r["votes"], r["pages"]) for r in html.host_paths(df).collect()}
    assert found == {"h.org": ([">body>div.lead", ">body>div.rest"], 5, 5), "p.org": ([">body>div.post"], 3, 3)}
    got = dict(rows(html.extract(df), "page_id", "main_text"))
    assert got[0] == f"{INTRO.strip()}\n{MAIN.strip()}" and got[9] == f"Short.\n{MAIN.strip()}" and got[20] == want


def test_climbing_stops_at_menus_and_small_print():
    links = "<a href=x>one link</a> <a href=y>another link</a> " * 9
    assert own(f"<body><div class=page><div class=x>{links}</div><div class=text>{MAIN}</div><div class=y>(c) 2024</div></div>") == MAIN.strip()
    assert own(f"<table><tr><td class=left>{INTRO}</td><td class=mid>{MAIN}</td></tr></table>") == MAIN.strip()


@pytest.mark.parametrize(
    "kept",
    ["<header><h1>Headline</h1></header>", "<math><mi>x</mi><mo>=</mo><mn>2</mn></math>", "<svg><text>axis</text></svg>",
     "<div class='share-price'>42 up</div>", "<fieldset><legend>Box</legend>in it</fieldset>", "<label>A label</label>",
     "<div id=cookie-recipe>Flour and sugar</div>"],
)
def test_parts_of_an_article_stay(kept):
    text = " ".join(re.sub("<[^>]*>", " ", kept).split())
    assert own(f"<body><article>{kept}{BODY}</article></body>").replace("\n", " ").replace(" ", "") == (text + TEXT).replace("\n", " ").replace(" ", "")


@pytest.mark.parametrize(
    "gone",
    ["<header>Site</header>", "<div class=share>Share it</div>", "<div class='share-buttons'>Share it</div>",
     "<div class='share-this-story'><a href=x>Share this story</a></div>", "<div id=comments><p>I agree.</p></div>",
     "<section class=comment-list><p>I agree with all of it.</p></section>", "<div role=search>Find</div>", "<select><option>a</select>"],
)
def test_what_is_no_article_goes(gone):
    assert own(f"<body>{gone}<div class=story>{BODY}{gone if 'header' not in gone else ''}</div></body>") == TEXT


@pytest.mark.parametrize(
    "part", ["<script ", '<a "', "<a b='", "<div>", "<b><div></div>", "</p>", "<!-", "<li><b>", "<td>", "<", "<div class=x><p>word</p>", "<p x=\"y"]
)
def test_time_follows_length(part):
    """64 KB take a fraction of a second whatever they hold, and four times as much about four times as long."""
    import time

    def seconds(n):
        started = time.perf_counter()
        own(part * (n // len(part)))
        return time.perf_counter() - started

    seconds(1 << 14)
    short, long = min(seconds(1 << 16) for _ in range(3)), min(seconds(1 << 18) for _ in range(2))
    assert short < 0.2 and long < 9 * short + 0.05


def test_quotes():
    assert own("<article><p title=it's>a<p title='x > y'>b<p title=\"q>c</article>") == "a\nb\nc"
    assert own("<article><p a = 'x>y' b=\"<p>\">a</p></article>") == "a"
    assert own(f"<article><p title='{'w > ' * 300}'>a</p></article>") == "a"


def by_hand(source):
    article = re.search(r"<article>(.*?)</article>", source, re.S)[1]
    blocks = (" ".join(unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
    return "\n".join(b for b in blocks if b)


def test_whole_table(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    got = {r["page_id"]: r for r in queries.op4_html_text(spark, SMALL).collect()}
    assert set(got) == set(pages)
    for key, source in pages.items():
        assert got[key]["text"] == by_hand(source) and got[key]["n_chars"] == len(got[key]["text"])


def test_a_host_outvotes_its_odd_page(spark):
    normal = "<body><div class='box{}'><p>{}</p></div><div class='extra'><p>{}</p></div></body>"
    long, short = "This is the article itself and it goes on for a while. " * 3, "A short side text."
    rows_in = [(i, "http://h.org/x", normal.format(i, long, short)) for i in range(5)]
    rows_in.append((9, "https://user@H.org:80/y", normal.format(9, "Brief news.", long)))
    rows_in.append((10, "http://other.org/", f"<body><section><p>{long}</p></section></body>"))
    df = spark.createDataFrame(rows_in, "page_id int, url string, html string")
    paths = {r["host"]: r["paths"] for r in html.host_paths(df).collect()}
    assert paths == {"h.org": [">body>div.box#"], "other.org": [">body>section"]}
    for few, hot in ((200_000, 10_000), (0, 10_000), (0, 2), (0, 1)):
        got = dict(rows(html.extract(df, broadcast_rows=few, hot_share=hot), "page_id", "main_text"))
        assert got[9] == "Brief news." and got[10] == long.strip() and len(got) == 7


def test_odd_rows(spark):
    odd = [(1, None, None), (1, None, None), (2, "", ""), (3, "not a url", "<p>text of it</p>"), (None, "http://a.b/", "plain words"),
           (4, "http://a.b/", "<div>" + "<p>word word</p>" * 20_000)]
    df = spark.createDataFrame(odd, "page_id int, url string, html string").withColumns(
        {c: F.lit(1) for c in ("page_host", "host", "path", "main_text", "page_salt")}
    )
    got = html.extract(df)
    assert sorted(got.columns) == sorted(df.columns)
    texts = sorted(rows(got, "page_id", "main_text"), key=lambda r: (str(r[0]), len(r[1])))
    assert [t for _, t in texts[:3]] == ["", "", ""] and texts[3][1] == "text of it" and texts[4][1].count("\n") == 19_999
    assert texts[5][1] == "plain words"
    assert rows(html.extract(df.limit(0))) == []
