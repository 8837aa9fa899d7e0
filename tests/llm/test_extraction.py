import html
import re
import time

from ledgerloom.llm import extraction

SF = "/root/testdata/sf0.01"


def text_of(page):
    return extraction.main_texts([page], extraction.trained())[0]


def test_test_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in extraction.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.DOTALL)[1]
        bare = re.sub(r"<[^>]*(>|\Z)", "", re.sub(r"</?(p|h1|br)>", " ", article))
        assert got[r.page_id].text == " ".join(html.unescape(bare).split())
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


def test_furniture_goes():
    page = """<html><head><title>T</title></head><body class="has-sidebar"><header><h1>Site</h1></header>
    <div id="cookie-notice">We use cookies on this site to make it work for you.</div><div role="navigation"><a href=x>Home</a></div>
    <main><article><header><h2>Head &amp; line</h2></header><p>First para<b>graph</b> of <a href="/x">some</a> words.</p><br>
    <div class="advert">Buy now a lot of things that are cheap and good</div><p>No.</p>
    <form><label>Name</label><input></form><script>if (a < b) "<p>x</p>"</script><!-- <p>hidden</p> --><p hidden>Unseen</p>
    <ul><li>Item one<li>Item two</ul><section id="comments"><p>Reader says a long thing about all this text here.</p></section></article></main>
    <aside>Related</aside><footer>&copy; 2020</footer></body></html>"""
    assert text_of(page) == "Head & line First paragraph of some words. No. Item one Item two"


def test_without_marks():
    para = "This is a paragraph of plain running words without any links that goes on for quite a while indeed. "
    page = f"<body><div><a href=1>A</a> <a href=2>B</a></div><div>{para * 2}</div><p>{para}<p>{para}</div><div><a href=3>C</a></div>"
    assert text_of(page) == " ".join([para.strip()] * 4)


def test_odd_pages(spark):
    pages = [None, "", "<", "<p", "<p>", "plain words", "<!-- open", "<script>x", "</p></div>", "<a b='c>d</a>", "&am &amp &#x41; &nbsp;", "<p>" * 3000 + "deep"]
    df = spark.createDataFrame([(k, "u", p, "t", 1) for k, p in enumerate(pages)], "page_id long, url string, html string, text string, n_chars int")
    got = {r.page_id: r.text for r in extraction.extract(df).collect()}
    assert len(got) == len(pages) and got[0] == got[1] == got[6] == got[7] == "" and got[5] == "plain words" and got[10] == "&am & A"
    assert got[11] == "deep"
    assert extraction.extract(df.limit(0)).count() == 0


def test_article_parts_with_words_of_furniture_stay():
    page = """<article><p>A b c d.</p><div class="legal-history">Law of old</div><p><math><mi>x</mi> = 2</math></p>
    <ul><li><a href=1>Ref one</a><li><a href=2>Ref two</a><li><a href=3>Ref three</a></ul>
    <div class="site-notice">We say</div><div class="share">Tell all</div><div class="cookie-bar x">Yes</div></article>"""
    assert text_of(page) == "A b c d. Law of old x = 2 Ref one Ref two Ref three"


def plain_tree(tree, row):
    while not isinstance(tree, int):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree == 1


def test_tree_against_a_walk_for_each_block(spark):
    tree = extraction.trained()
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        found = extraction.blocks(r.html)
        kept = [b[0] for b, row in zip(found, extraction.rows(found), strict=True) if plain_tree(tree, row)]
        assert extraction.main_texts([r.html], tree)[0] == " ".join(kept)
    table = extraction.TRAINING
    assert sum(plain_tree(tree, row[:-1]) == (row[-1] == 1) for row in table) >= 0.95 * len(table)


def test_time_grows_with_length_however_tags_nest():
    n = 20_000
    for page in ("<div>x" * n + "</section>" * n, "<span class=ad>" * n + "<div></div></b></em>" * n, "<a><div>" + "<span class=ad>" * n + "</a>" * n):
        started = time.process_time()
        extraction.blocks(page)
        assert time.process_time() - started < 5


def test_an_end_tag_closes_only_its_own():
    assert [b[0] for b in extraction.blocks("<em class=ad></p>x</em><p>y")] == ["x", "y"]
    assert [b[4] for b in extraction.blocks("<em class=ad></p>x</em><p>y")] == [1, 0]
    assert text_of("<article><p>One two <span class=ad>buy now</span> three.</p></article>") == "One two three."
