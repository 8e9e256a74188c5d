import re

import pytest

from shelfmark.llm import html_crf as h
from tests.llm.samples import sentences

SF_DIR = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def pages(spark):
    return [r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").orderBy("page_id").collect()]


@pytest.fixture(scope="module")
def field(pages):
    return h.train(pages[:300])


def article(html):
    return "\n".join(b.text for b in h.leaf_blocks(html) if "article" in b.marks)


def test_pages_that_were_not_trained_on(pages, field):
    held = pages[300:1300]
    right = [a == article(p) for a, p in zip(h.main_texts(field, held), held)]
    assert sum(right) / len(right) > 0.99


def test_other_layouts(field):
    body = "".join(f"<p>{sentences(40, k)}.</p>" for k in range(6))
    page = (
        "<html><head><title>t</title></head><body><header><a href='/'>Home</a></header>"
        "<div class='menu'><ul><li><a href='#'>One</a><li><a href='#'>Two</a></ul></div>"
        f"<div class='content'><h1>{sentences(6)}</h1>{body}</div>"
        "<div class='sidebar'><p>Also read</p></div>"
        "<section class='comments'><div class='comment'><p>I like it very much.</p></div></section>"
        "<form><label>Mail</label><button>Send</button></form><footer>© 2024</footer></body></html>"
    )
    want = "\n".join([sentences(6), *[sentences(40, k) + "." for k in range(6)]])
    assert h.main_texts(field, [page]) == [want]


def texts(html):
    return [b.text for b in h.leaf_blocks(html)]


def test_blocks():
    assert texts("<p>a  b\n\t<b>c</b><br>d<p>e &amp; f &eacute;&#39;&nbsp;x") == ["a b c d", "e & f é' x"]
    assert texts("<ul><li>1<li>2</ul>tail<div>x<div>y</div>z</div>") == ["1", "2", "tail", "x", "y", "z"]
    assert texts("<script>var a='<p>no</p>';</script><style>p{}</style><!-- no --><p>yes") == ["yes"]
    assert texts("<head><title>no</title></head><body>yes</body>") == ["yes"]
    assert texts("<p>cut off <b") in (["cut off"], ["cut off <b"])
    assert texts("") == texts(None) == texts("<p> \n </p>") == []


def test_ancestors_survive_unclosed_inline_tags():
    blocks = h.leaf_blocks("<article><p><b>a<br><p>b</p></article><footer>c</footer>")
    assert [("article" in b.marks, b.text) for b in blocks] == [(True, "a"), (True, "b"), (False, "c")]


def test_links_are_counted():
    assert [b.linked for b in h.leaf_blocks("<p><a href=x>abc</a> de</p>")] == [3]


def test_query_rows(spark):
    rows = [(1, "u", f"<article><p>{sentences(50)}</p></article><footer>© x</footer>")] * 2
    rows += [(None, None, None), (2, "u", ""), (3, "u", "<p>" + "w " * 100_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = h.extract(df.selectExpr("*", "1 AS text", "2 AS prediction")).collect()
    assert sorted((r.page_id or 0, r.text[:5]) for r in got)[:2] == [(0, ""), (1, sentences(50)[:5])]
    assert len(got) == 5 and all(not re.search(r"\s\s|^\s|\s$", r.text) for r in got)


def test_no_pages(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert h.extract(df).count() == 0


def test_rare_labels_are_all_sampled(spark):
    plain = [(k, f"u{k}", f"<p>page {k} without the element") for k in range(3000)]
    empty = [(k, f"e{k}", f"<!-- <article>{k} --><p>no") for k in range(100)]
    marked = [(k, f"m{k}", f"<ARTICLE><p>{sentences(30, k)}</p></ARTICLE><footer>x</footer>") for k in range(8)]
    copies = [(k, f"c{k}", marked[0][2]) for k in range(500)]
    df = spark.createDataFrame(plain + empty + marked + copies, "page_id long, url string, html string")
    assert sorted(h.training_sample(df, 20)) == sorted(m[2] for m in marked)
    assert len(set(h.training_sample(df, 5))) == 5


def test_heads_without_an_end():
    article = "<article><p>yes</article>"
    for head in ("<head><title>t</title>", "<head><meta charset=x><title>t</title><script>a</script><style>b</style>",
                 "<html><head><noscript><img src=x></noscript><title>t</title></head><body>", "<head><title>t<body>"):
        assert texts(head + article) == ["yes"]
    assert texts("<head><title>t</title>some <b>text</b>") == ["some text"]


def test_text_of_other_elements_is_kept():
    page = "<article><p>a</p>{}<p>z</p></article>"
    for tag in ("noscript", "object", "svg", "select"):
        assert texts(page.format(f"<{tag}><p>b</p></{tag}>")) == ["a", "b", "z"]
    assert texts("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be") == ["Let x=1 be"]
