"""Main text of pages: the whole small table against its template, and odd pages."""

import html
import re

import pytest

from ledgerspark.llm import html_text


def template_text(page):
    """Text of the article of a page of the given table, block by block."""
    m = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)
    blocks = []
    for part in re.split(r"</?(?:p|h1|br|article)>", m[1]) if m else ():
        part = re.sub(r"<[^>]*\Z", "", re.sub(r"</?b>", "", part))
        blocks.append(re.sub(r"\s+", " ", html.unescape(part)).strip())
    return "\n".join(b for b in blocks if b)


def test_whole_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    want = {r["page_id"]: (r["url"], template_text(r["html"])) for r in pages.collect()}
    got = html_text.extracted(pages).collect()
    assert {r["page_id"]: (r["url"], r["text"]) for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got) and len(got) == len(want)


PROSE = "A long sentence of an article, which has many words and no link at all, goes on and on. " * 4

CASES = {
    "": "",
    "   ": "",
    "just text": "just text",
    "<p>one<p>two  \n lines<br>three": "one\ntwo lines\nthree",
    "<ul><li>a<li>b</ul>": "a\nb",
    "&lt;b&gt; &amp;amp; &eacute; &#233; &#x41; &nope; x&nbsp;y": "<b> &amp; é é A &nope; x y",
    "<p>a <!-- <p>no</p> --> b</p>": "a b",
    "<p>a</p><script>if (a < b) document.write('<p>no</p>')</script><p>b</p>": "a\nb",
    "<style>p{}</style><p>a": "a",
    "<p title='a > b'>x</p>": "x",
    "<p>a <b>bold</b><i>er</i> end</p>": "a bolder end",
    "<p>never closed <b>bold": "never closed bold",
    "</div></p>stray": "stray",
    "<p>5 < 6 and 7 > 2</p>": "5 < 6 and 7 > 2",
    "<p>cut <a href='x": "cut",
    f"<body><nav><a>menu</a></nav><div id=content><h1>Title</h1><div><p>{PROSE}</p><p>{PROSE}</p></div></div><div class='sidebar'>side</div></body>": f"Title\n{PROSE.strip()}\n{PROSE.strip()}",
    f"<main><p>{PROSE}</p><section class='user-comments'><p>{PROSE}</p></section><aside>x</aside><form>y</form></main>": PROSE.strip(),
    f"<div><a>one</a> <a>two</a> <a>three</a> <a>four</a></div><div><p>{PROSE}</p><p>{PROSE}</p></div>": f"{PROSE.strip()}\n{PROSE.strip()}",
    "<article><h1>Short</h1><p>Tiny.</p></article><footer>&copy; x</footer>": "Short\nTiny.",
    "<ARTICLE><P>Upper</P></ARTICLE><DIV CLASS=\"AD\">no</DIV>": "Upper",
}


@pytest.mark.parametrize("page", CASES)
def test_page(page):
    assert html_text.main_text(page) == CASES[page]


ITEMS = "".join(f"<li>Item {i} of a list, which has about forty signs" for i in range(10))
BODY = f"<div><p>{PROSE}</p><p>{PROSE}</p><p>{PROSE}</p></div>"
WHOLE = {
    f"<body>Bare {PROSE}<br>{BODY}</body>": 4,
    f"<body>Bare <b>bold</b> {PROSE}<br>{BODY}</body>": 4,
    f"<body>{BODY}<ul>{ITEMS}</ul></body>": 13,
    f"<body>{BODY}<section><div>{PROSE}</div></section></body>": 4,
    f"<body><div class='no-sidebar'>{BODY}</div></body>": 3,
    f"<body><h1>News</h1><article><p>{PROSE}</p></article><article><p>{PROSE}</p><p>{PROSE}</p></article></body>": 4,
}


@pytest.mark.parametrize("page", WHOLE)
def test_all_text_of_pages_without_one_article(page):
    assert len(html_text.main_text(page).split("\n")) == WHOLE[page]


TALK = f"<div class='comment'><p>{PROSE}</p><p>{PROSE}</p></div>" * 3
ONLY = PROSE.strip()
COMMENTED = {
    f"<body><div class=post><p>{ONLY}</p></div>{TALK}</body>": ONLY,
    f"<body><main><p>{ONLY}</p><section id=comments>{TALK}</section></main></body>": ONLY,
    f"<body><h1>T</h1><p>{ONLY}</p><section id='user-comments'>{TALK}</section></body>": f"T\n{ONLY}",
    f"<article><header><p>by x</p><h1>Title</h1></header><p>{ONLY}</p><footer>f</footer></article>": f"Title\n{ONLY}",
    f"<body><header><h1>Site</h1></header><article><p>{ONLY}</p></article></body>": ONLY,
    f"<body><div>stray</div><article><p>{ONLY}</p></article><article class=related><p>Teaser {ONLY}</p></article></body>": ONLY,
}


@pytest.mark.parametrize("page", COMMENTED)
def test_comments_go_and_titles_stay(page):
    assert html_text.main_text(page) == COMMENTED[page]


@pytest.mark.parametrize("name", "social-studies side-effects share-price comment-on-law article-notice recommended-reading adverb no-sidebar".split())
def test_names_that_only_contain_a_listed_word_stay(name):
    page = f"<article><p>{ONLY}</p><div class='{name}'><p>Inside.</p></div></article>"
    assert html_text.main_text(page) == f"{ONLY}\nInside."


@pytest.mark.parametrize("name", "comments user-comments CommentList site-footer left-sidebar cookie-notice ad share-buttons related-posts mainNav".split())
def test_names_made_of_listed_words_go(name):
    page = f"<article><p>{ONLY}</p><div class='x {name}'><p>Inside.</p></div></article>"
    assert html_text.main_text(page) == ONLY


def test_density_alone_finds_the_articles_of_the_table(spark, sf_dir):
    pages = [r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    for page in pages:
        plain = re.sub(r"<(/?)article>", r"<\1div>", page)
        assert html_text.main_text(plain) == template_text(page)


def test_the_chosen_subtree_has_the_largest_density_sum(spark, sf_dir):
    """Against the definitions, computed for each node by walking its whole subtree."""

    def walk(node):
        yield node
        for x in node.items:
            if isinstance(x, html_text.Node):
                yield from walk(x)

    def size(node):
        return sum(len("".join(x.split())) for n in walk(node) for x in n.items if isinstance(x, str))

    def density(node, root):
        chars, tags = size(node), max(1, sum(1 for _ in walk(node)) - 1)
        tops = [n for n in walk(node) if n.tag == "a"]
        link_chars, link_tags = sum(map(size, tops)), len(tops)
        ratio = sum(size(n) for n in walk(root) if n.tag == "a") / max(1, size(root))
        return html_text._density(chars, tags, link_chars, link_tags, ratio)

    for page in [r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").limit(15).collect()]:
        root = html_text.parse(re.sub(r"<(/?)article>", r"<\1div>", page))
        html_text.measure(root)
        for node in walk(root):
            assert node.density == pytest.approx(density(node, root))
        assert root.best.total == max(n.total for n in walk(root))


def test_many_nested_marked_nodes_take_no_square():
    page = "<div class=sidebar>" * 4000 + f"<article><p>{ONLY}</p></article>" + "</div>" * 4000
    assert html_text.main_text(page) == ONLY


def test_deep_and_long_pages_end():
    deep = "<div>" * 20_000 + "text" + "</div>" * 20_000
    assert html_text.main_text(deep) == "text"
    assert html_text.main_text("<p>word</p>" * 20_000).count("\n") == 19_999
    assert html_text.main_text("<" * 50_000 + "<p>a</p>" + "<!--" * 5_000).endswith("a")


def test_odd_rows(spark):
    rows = [(1, None, None, 1), (None, "u", "<p>x", 2), (3, "u", "", 3), (3, "u", "", 3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    assert sorted(map(tuple, html_text.extracted(df).collect()), key=str) == [(1, None, "", 0), (3, "u", "", 0), (3, "u", "", 0), (None, "u", "x", 1)]
    assert html_text.extracted(df.limit(0)).count() == 0
