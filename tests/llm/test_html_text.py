import html
import re

import pytest
from pyspark.sql import functions as F

from swathmatch.llm import html_text
from swathmatch.llm.queries import QUERIES
from swathmatch.llm.shared import ship

SCHEMA = "page_id long, url string, html string"


@pytest.mark.parametrize(("page", "text"), [
    ("", ""), ("plain &amp; text", "plain & text"), ("<p>a<p>b<br>c</p> d", "a\nb c\nd"), ("<div>a<b> b\n </b>c<div>d</div>e</div>", "a b c\nd\ne"),
    ("<title>t</title><body><h1>H</h1><script>if (a < b) {'</p>'}</script>x<style>p{}</style>", "H\nx"), ("<p>a<!-- <p>no --> b<!-- open", "a b"),
    ("<ul><li>1<li>2<ul><li>3</ul></ul>4", "1\n2\n3\n4"), ("<table><tr><td>a<td>b<tr><td>c</table>d", "a\nb\nc\nd"), ("a < b &lt;c&gt; &#233;&eacute", "a < b <c> éé"),
    ("<nav>m</nav><header>h</header><main><p>yes</p><aside>no</aside></main><footer>f</footer>", "yes"),
    ("<div class='with-sidebar'><div id=cookie-notice>c</div><article><header><h1>T</h1></header><p>a</p><div class='comments'><p>no</p></div>"
     "<form>f</form></article><article class=comment>no</article></div>", "T\na"),
    ("<p>a</p></div></span><p>b</i>", "a\nb"), ("<article><p>one</article><div class=ad>x</div>", "one"), ("<p hidden>a<p style='display: none'>b<p>c", "c"),
    ("<p>x</p><div class=\"ad\" title=\"a>b\">no</div>", "x"), ("<textarea>t", ""), ("<article><b>bold<p>para</b></p></article>", "bold\npara"),
])
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def rows_of():
    rows = []
    for i in range(30):
        rows.append((i, f"https://a.example/{i}", f"<body><div class=c1>Always the same line</div><div class=c2><p>Text {i} of its own</p><p>More {i}</p></div></body>"))
        rows.append((100 + i, f"http://copies.example/{i}", "<body><div class=c1>Only line</div><div class=c2><p>Only text</p></div></body>"))
        rows.append((200 + i, f"http://copies.example.org/{i}", f"<nav>n{i}</nav><article><p>Only text</p></article>"))
    rows += [(300, "https://few.example/", "<div class=c1>Always the same line</div><p>x</p>"), (301, None, "<p>a</p>"), (302, "odd url", None),
             (None, "https://b.example/", ""), (303, "https://b.example/x", "<p>t</p>"), (303, "https://b.example/x", "<p>t</p>"),
             (304, "https://b.example/y", "<article><p>" + "long word " * 50_000 + "</p></article>")]
    return rows


def test_branches_which_a_site_repeats_go(spark):
    ship(spark)
    rows = rows_of()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("host", F.lit("clash")).withColumn("low", F.lit(1))
    got = html_text.extract(df).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r.text for r in got}
    assert all(by[i] == f"Text {i} of its own\nMore {i}" for i in range(30))
    assert all(by[100 + i] == "Only line\nOnly text" and by[200 + i] == "Only text" for i in range(30))
    assert by[300] == "Always the same line\nx" and by[301] == "a" and by[302] == "" and by[None] == "" and by[303] == "t"
    assert by[304] == ("long word " * 50_000).strip()


def test_empty_table(spark):
    ship(spark)
    assert html_text.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_returns_the_articles(spark):
    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    for r in QUERIES["op10_html"](spark, folder).collect():
        article = pages[r.page_id].html.partition("<article>")[2].partition("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.url == pages[r.page_id].url
