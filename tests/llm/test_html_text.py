import html
import re

from riskmart.llm.html_text import extract, main_text

PARA = "A long paragraph of real article prose, with enough words to be dense, that goes on for a while."


def page(body, head="<title>T</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


def test_boilerplate_goes():
    got = main_text(page(
        f"<header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div class='cookie-notice'>{PARA}</div><div id=main><h1>Title</h1><p>{PARA}</p>"
        f"<form><p>{PARA}</p></form><p>{PARA} &amp; more&nbsp;&lt;b&gt;</p><script>if (a < b) '</p>'</script><aside>{PARA}</aside></div>"
        f"<section id='comments'><p>{PARA} {PARA}</p></section><div class='sidebar widget'>{PARA}</div><footer>{PARA} {PARA}</footer>"
    ))
    assert got == f"Title {PARA} {PARA} & more <b>"


def test_white_space_blocks_and_links():
    assert main_text(page("<article><p>a\n  b<b>c</b>\td</p><p>  </p><p>e<br>f</p></article>")) == "a bc d e f"
    links = "".join(f"<li><a href='/{i}'>Some other story number {i}</a></li>" for i in range(20))
    assert main_text(page(f"<div><ul>{links}</ul></div><div><p>{PARA}</p><p>{PARA}</p></div>")) == f"{PARA} {PARA}"


def test_broken_markup():
    assert main_text(f"<body><article><p>{PARA}<p>{PARA}<a hre") == f"{PARA} {PARA}"
    assert main_text(f"<body><p>{PARA}</div></span> tail<!-- open {PARA}") == f"{PARA} tail"
    assert main_text("<div>" * 20_000 + PARA) == PARA
    assert main_text("<p title=\"" + "x" * 50_000 + f"><p>{PARA}") is not None
    assert [main_text(x) for x in (None, "", "<html>", "   ", "<script>x")] == [""] * 5
    assert main_text("just text") == "just text"
    assert len(main_text(page("<article>" + f"<p>{PARA}</p>" * 5000 + "</article>"))) == 5000 * (len(PARA) + 1) - 1


def test_query_rows(spark):
    rows = [(1, None, None, "x"), (2, "u", "", "x"), (3, "u", page(f"<p>{PARA}</p>"), "x"), (3, "u", page(f"<p>{PARA}</p>"), "x"), (None, "u", page("<p>é</p>"), "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((tuple(r) for r in extract(df).collect()), key=str)
    assert got == sorted([(1, None, "", 0), (2, "u", "", 0), *[(3, "u", PARA, len(PARA))] * 2, (None, "u", "é", 1)], key=str)
    assert extract(df.where("false")).count() == 0


def test_article_of_every_given_page(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for source, got in zip(pages.toPandas().itertuples(), extract(pages).toPandas().itertuples(), strict=True):
        inner = re.search(r"<article>(.*?)(</article>|<footer>|$)", source.html, re.S)[1]
        inner = re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", inner))
        assert got.text == " ".join(html.unescape(inner).split()) and got.n_chars == len(got.text)


def test_names_that_look_like_boilerplate_do_not_empty_a_page():
    body = "<h1>A title</h1><p>" + "Some long text of the article here. " * 8 + "</p><p>" + "More text there. " * 9 + "</p>"
    want = " ".join(("A title " + "Some long text of the article here. " * 8 + "More text there. " * 9).split())
    names = ("class='content has-sidebar'", "class='post with-comments'", "class='no-nav layout'", "class='social-science'", "id='search-history-of-rome'", 'data-id="search"')
    around = "<html><body><nav><a href=x>Home</a> <a href=y>About</a></nav>{}<div class=sidebar><a href=q>one</a> two</div><footer>Imprint</footer></body></html>"
    for name in names:
        assert main_text(around.format(f"<div {name}>{body}</div>")) == want, name
        untitled = body.replace("<h1>A title</h1>", "")
        assert main_text(around.format(f"<div {name}>{untitled}</div>")) == want.removeprefix("A title "), name
    assert main_text(f"<html><body><form>{body}</form></body></html>") == want
    assert "hidden" in main_text(f'<html><body><div><p title="the hidden cost of x">{"what is hidden " * 20}</p></div></body></html>')
    # Comments go though they are as long as the article, and a hidden part always goes.
    comments = "<div class='comments'><p>" + "I do not agree with this at all. " * 10 + "</p></div>"
    assert main_text(around.format(f"<article>{body}</article>{comments}<div hidden>{body}</div>")) == want
