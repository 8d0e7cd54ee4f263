"""URL filter and HTML extraction."""

import html as entities
import re

import pytest

from compare import difference
from lakepnl.llm import queries, templates, url_filter
from lakepnl.llm.templates import hash_subtrees, main_text, nodes, parse
from lakepnl.llm.url_filter import DEFAULT, Rule, apply_rules, automaton, count_terms, host_path, score_urls


@pytest.mark.parametrize("name", ["op1_url_filter", "op4_decontamination", "op5_line_dedup"])
def test_query_against_sql(spark, sf, name):
    rows, problem = difference(spark, sf, queries.QUERIES[name], queries.ORACLES[name])
    assert not problem and rows > 0


def test_terms_need_boundaries():
    terms = automaton(DEFAULT)
    assert count_terms("https://my-CASINO.example/", terms) == (1, 0, 1, 0)
    assert count_terms("https://mycasino.example/casinoroyal/écasino", terms) == (0, 0, 0, 0)
    assert count_terms("http://a/free/free_bets", terms) == (0, 3, 0, 2)
    assert count_terms("", terms) == (0, 0, 0, 0)


def test_urls_and_rules(spark):
    rules = [Rule("com/", "allow"), Rule("example.com/en/", "block"), Rule("www.example.com/en/", "allow")]
    rows = [
        ("http://www.Example.com/en/x?y", "www.example.com", "/en/x", "www.example.com/en/"),
        ("http://a.example.com/en/x#y/z", "a.example.com", "/en/x", "example.com/en/"),
        ("http://notexample.com/en/", "notexample.com", "/en/", "com/"),
        ("http://example.com", "example.com", "", None),
        ("http://com/a", "com", "/a", "com/"),
        ("http://x.com:80/a", "x.com:80", "/a", None),
        ("x.com/http://y.com/z", "y.com", "/z", "com/"),
        ("no scheme", "", "", None),
        (None, "", "", None),
    ]
    df = spark.createDataFrame([(r[0], r[1:], "clash") for r in rows], "url string, want struct<h:string,p:string,r:string>, n_soft string")
    host, path = host_path()
    got = apply_rules(score_urls(df).withColumn("host", host).withColumn("path", path), rules).collect()
    assert [(r["host"], r["path"], r["rule"]) for r in got] == [tuple(r["want"]) for r in got]
    assert got[-1]["url_verdict"] == "allow" and got[-1]["n_soft"] == 0
    assert score_urls(df.where("false")).count() == 0


def test_blocks_and_marked_elements():
    page = (
        "<!doctype html><title>t</title><header>H</header><div class='side sidebar'>x</div><article><h1>A &lt; B&nbsp; c</h1>"
        "<p>one <b>two</b><br>three<p>four <i>five<p>six</i><ul><li>a<li>b</ul><form>f</form><script>if (a</p>b)</script>"
        "<style>p{}</style><!-- no <p>comment</p> --><table><tr><td>x<td>y</table><aside>z</aside>1 < 2 &amp 3"
        "<section id='comments'><p>reader</p></section></article><footer>F</footer>"
    )
    want = "A < B c\none two three\nfour five\nsix\na\nb\nx\ny\n1 < 2 & 3"
    assert main_text(parse(page)) == want
    assert main_text(parse("<body><nav>n</nav><p>only body</p><div class=ad>ad</div>")) == "only body"
    assert main_text(parse("<main>m<p>n</main>after")) == "m\nn"
    assert [main_text(parse(x)) for x in ("", "<", "<p", "<!-- open <p>x", "<script>x", "</p></div>")] == ["", "<", "", "", "", ""]
    assert main_text(parse("<p title='a>b' class=x>in</p>")) == "in"
    assert main_text(parse("<div>" * 20_000 + "deep")) == "deep"
    assert main_text(parse("<a href=\"" * 2_000)) == ""


def text_of(page):
    root = parse(page)
    hash_subtrees(root)
    return main_text(root)


def test_comments_and_wrappers():
    article = "<article><h1>T</h1><p>the text of the article is long enough here</p>{}</article>"
    want = "T\nthe text of the article is long enough here"
    nested = "<section id=comments><h2>2 comments</h2><article><p>first!</p></article></section>"
    assert text_of(article.format(nested)) == want
    assert text_of(article.format("") + nested) == want
    assert text_of("<div class='page has-sidebar'>" + article.format("") + "</div>") == want
    wrapped = "<div class='page no-sidebar'><h1>T</h1><p>the text of the article is long enough here</p><div class=sidebar>s</div></div>"
    assert text_of("<body>" + wrapped) == want
    assert text_of("<article><div class='entry share-ready'><p>body of the text</p></div></article>") == "body of the text"
    assert text_of("<article>a</article><div class=ad><article>b</article></div><article>c</article>") == "a\nc"
    assert text_of("<form><article>whole page in a form</article></form>") == "whole page in a form"


def test_equal_subtrees_have_equal_keys():
    root = parse("<div><p>a  b</p></div><div><p>a\nb</p></div><div><p>a c</p></div><div> </div>")
    hash_subtrees(root)
    keys = [n.key for n in nodes(root) if n.tag == "div"]
    assert keys[0] == keys[1] != keys[2] and keys[3] == 0


def page(k, body, host="h.example", extra=""):
    return (k, f"http://{host}/{k}", f"<title>title {k}</title><body><div>{extra}</div><div><p>{body}</p></div>")


def test_site_templates_go_and_copies_stay(spark):
    rows = [page(k, f"own text {k}", extra="<span>Join our club</span>") for k in range(20)]
    rows += [(100 + k, "http://copies.example/x", "<title>same</title><body><p>copied text</p>") for k in range(20)]
    rows += [(200, None, None), (201, "http://h.example/e", ""), page(300, "other host", "o.example", "Join our club")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in templates.extract(df).collect()}
    assert all(got[k] == (f"own text {k}", len(f"own text {k}")) for k in range(20))
    assert all(got[100 + k][0] == "copied text" for k in range(20))
    assert got[200] == ("", 0) and got[201] == ("", 0) and got[300][0] == "Join our club\nother host"
    assert templates.extract(df.where("false")).count() == 0


def test_templates_of_a_section_and_of_pages_with_one_title(spark):
    """A block on 10 of 100 pages of a host, and on pages that all have the site's name as title."""
    rows = [page(k, f"own text {k}", extra="<span>Section notice</span>" if k < 10 else "") for k in range(100)]
    rows += [(k, f"http://one.example/{k}", f"<title>site</title><body><div>Menu of all</div><p>own text {k}</p>") for k in range(200, 212)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in templates.extract(df).collect()}
    assert got == {r[0]: f"own text {r[0]}" for r in rows}


def test_article_text_is_never_a_template(spark):
    """Sentences, items, quotes and cells that many articles of a host share are text of each of them."""
    shared = "<p>See you soon.</p><ul><li>one</li></ul><blockquote>q</blockquote><div><p>in a box</p></div><table><tr><td>c</table>"
    want = "See you soon.\none\nq\nin a box\nc"
    rows = [(k, f"http://a.example/{k}", f"<nav>Menu</nav><article><h1>Title {k}</h1>{shared}</article>") for k in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in templates.extract(df).collect()}
    assert got == {k: f"Title {k}\n{want}" for k in range(40)}


def test_notices_of_a_site_inside_articles_go(spark):
    """What stands outside articles too, or is no block of an article, at one place of 8 pages; not on 7."""
    notice, bare = "<p>All rights with the site</p>", "<div class=box>Join our <b>club</b></div>"
    rows = []
    for k in range(30):
        outside = notice if k < 10 else ""
        inside = notice if k >= 20 else ""
        rows.append((k, f"http://b.example/{k}", f"<div>{outside}</div><article><p>own {k}</p>{bare}{inside}</article>"))
    rows += [(100 + k, f"http://c.example/{k}", f"<article><p>own {k}</p>{bare}</article>") for k in range(7)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in templates.extract(df).collect()}
    assert all(got[k] == f"own {k}" for k in range(30))
    assert all(got[100 + k] == f"own {k}\nJoin our club" for k in range(7))


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_extraction_of_the_table(spark, sf):
    """Against a plain reading of the article element."""
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = queries.QUERIES["op3_html_extraction"](spark, sf).collect()
    assert len(got) == len(pages)
    for row in got:
        found = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[row["page_id"]] or "", re.S)
        blocks = re.split(r"</?(?:p|h1)>", found[1]) if found else []
        lines = [" ".join(entities.unescape(re.sub(r"<[^>]*(?:>|\Z)", " ", x)).split()) for x in blocks]
        assert row["text"] == "\n".join(x for x in lines if x)
        assert row["n_chars"] == len(row["text"])


def test_vocabulary_is_disjoint():
    assert not set(DEFAULT.strict) & set(DEFAULT.soft) and url_filter.DEFAULT.min_soft == 2
