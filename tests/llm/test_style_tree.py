import pytest

from fulltime.llm import style_tree as S
from tests.llm import helpers as H

PAGE = "page_id long, url string, html string"


@pytest.mark.parametrize("html, text", [
    ("<p>a <b>b</b>c<p>d<br>e", ["a bc", "d", "e"]),
    ("<ul><li>x<li>y</ul>z &amp; &#233;&nbsp;&lt;b&gt;", ["x", "y", "z & é <b>"]),
    ("<script>var t='</p><p>no';</script><style>p{}</style><p>yes", ["yes"]),
    ("<nav><ul><li><a href='#'>menu</a></ul></nav><article><h1>T</h1><p>body</p></article><footer>f</footer>", ["T", "body"]),
    ("<div class='side sidebar'>s</div><div id=comments><p>c</p></div><p>main", ["main"]),
    ("<header>h</header><main><header>title</header><p>t</p><aside>x</aside></main>out", ["title", "t"]),
    ("<p title='a>b'>one</p><!-- <p>gone</p> --><!doctype x><p>two</p><P>three</P", ["one", "two", "three"]),
    ("a < b and 1<2 <p>c <!-- open", ["a < b and 1<2", "c"]),
    ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]),
    ("<p>cut off &am", ["cut off &am"]), ("<scr", []), ("<title>t</title>", []), ("</p></div>x", ["x"]),
    ("<textarea>no</textarea><svg><text>drawn</text></svg>t", ["t"]), ("<p>x<script>unclosed", ["x"]),
])
def test_blocks(html, text):
    assert S.Page(html).kept() == text


@pytest.mark.parametrize("html, text", [
    ("<p>x</p><article class='post no-comments'><h1>T</h1><p>body</p></article>", ["T", "body"]),
    ("<h1>T</h1><div class='content has-sidebar'><p>the long text of the page</p></div><div class=sidebar><p>s</p></div>", ["T", "the long text of the page"]),
    ("<div id=page class='layout-sidebar-right'><div class=sidebar>side</div><article><p>body</p></article></div>", ["body"]),
    ("<main><p>a longer introduction</p><div class='search-result'><article><p>body</p></article></div></main>", ["a longer introduction", "body"]),
    ("<div class='social-issues'><h1>T</h1></div><div class='share-price'><h1>U</h1></div><p>the other text", ["T", "U", "the other text"]),
    ("<article><p>a long body text</p><div id=comments><article class=comment>me too</article></div></article>", ["a long body text"]),
    ("<article><p>a long body text</p></article><div class=related><article>teaser</article></div>", ["a long body text"]),
    ("<div role=main class='has-sidebar'><p>body</p></div><p>out", ["body"]),
])
def test_a_noise_word_alone_does_not_remove_the_text(html, text):
    assert S.Page(html).kept() == text


def site(spark):
    rows, want = [], {}
    for i in range(40):  # a host whose menu and notice have no telling names
        body = [H.prose(i * 7 + k, 12).replace("\n", " ") for k in range(3)]
        rows.append((i, f"https://Plain.example.com/{i}", "<div class=top><span>Home</span> <span>News</span></div><div class=box><p>We value you"
                     f"</p></div><div class=x>{''.join(f'<p>{p}</p>' for p in body)}</div>"))
        want[i] = " ".join(" ".join(p.split()) for p in body)
    rows += [(100, None, "<p>no url</p>"), (101, "nonsense", "<p>x &lt; y</p>"), (102, "https://e.org", None), (103, "https://e.org", ""), (None, "http://e.org", "<p>n")]
    want |= {100: "no url", 101: "x < y", 102: "", 103: "", None: "n"}
    return spark.createDataFrame(rows + rows[:2], PAGE), want


def test_low_branches_go_and_texts_stay(spark):
    pages, want = site(spark)
    low = {r["host"]: r["low"] for r in S.low_branches(S.site_nodes(pages)).collect()}
    assert set(low) == {"plain.example.com"} and set(low["plain.example.com"]) >= {"div.top", "div.box"}
    out = S.main_text(H.clashing(pages, "host", "path"), keep=["page_id", "url"]).collect()
    assert len(out) == len(want) + 2
    for r in out:
        assert r["text"] == want[r["page_id"]] and r["n_chars"] == len(r["text"])


@pytest.mark.parametrize("marked", [False, True])
def test_one_article_under_many_menus_stays(spark, marked):
    """Nine pages in ten carry one article; each has another menu. All keep their article, and the menu's notice goes."""
    tag = "article" if marked else "section"
    body = [" ".join(H.prose(i, 60).split()) for i in range(10)]
    rows = [(i, "http://copies.org/x", f"<div class=box><p>We value you</p></div><div class=top>menu {i}</div><{tag}><p>{body[i % 10 if i % 10 and i < 10 else 0]}</p></{tag}>")
            for i in range(100)]
    for r in S.main_text(spark.createDataFrame(rows, PAGE)).collect():
        i = r["page_id"]
        assert body[i % 10 if i % 10 and i < 10 else 0] in r["text"] and "We value you" not in r["text"], i


def test_shuffle_join_gives_the_same(spark, monkeypatch):
    pages, want = site(spark)
    monkeypatch.setattr(S, "BROADCAST", -1)
    assert {r["page_id"]: r["text"] for r in S.main_text(pages).collect()} == want


def test_article_pages_of_the_table(spark):
    """Pages of the test table mark their article, so its text is known."""
    import html
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in S.main_text(pages, keep=["page_id"]).join(pages, "page_id").collect():
        m = re.search(r"<article>(.*?)(</article>|\Z)", r["html"], re.S)
        parts = re.split(r"</?(?:p|h1|br)>", re.sub(r"<[^>]*\Z", "", m[1] if m else ""))
        assert r["text"] == " ".join(" ".join(html.unescape(re.sub(r"</?b>", "", p)) for p in parts).split())


def test_no_rows(spark):
    assert S.main_text(spark.createDataFrame([], PAGE)).count() == 0
