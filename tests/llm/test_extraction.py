import random
import time
from itertools import product

from wardbook.llm.extraction import CutRules, blocks_of, extracted, main_text, minimum_cut, named_boilerplate

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p><p>x";</script></head>
<body class="has-sidebar with-comments"><header><h1>Site name</h1><nav><ul><li><a href=/>Home</a></li><li><a href="/a">A</a></li></ul></nav></header>
<div id="cookieNotice">We use cookies to make this site better. Read our policy.</div><div class="ad">Buy this now, it is the best you can get.</div>
<article><h1>The &amp; title</h1><p>First   paragraph,<br>on two lines &lt;here&gt;.<p>Unclosed <b>second paragraph</p><ul><li>one</li><li>two</li></ul>
<!-- <p>no</p> --><form><label>Mail</label><textarea>say</textarea><button>Send</button></form>
<section class="comments"><h2>Comments</h2><p>A long comment by a reader, which is no part of the article itself.</p></section></article>
<aside><p>Something else that is long enough to look like text of the article.</p></aside><footer>&copy; someone</footer></body></html>"""
TEXT = "The & title\nFirst paragraph, on two lines <here>.\nUnclosed second paragraph\none\ntwo"


def test_the_article_without_what_surrounds_it():
    assert main_text(PAGE) == TEXT


def test_pages_without_article_element():
    body = "".join(f"<p>Sentence number {i} of the text, which goes on for a while.</p>" for i in range(4))
    page = f'<div class="menu"><a href=/>Home</a> <a href=/x>More</a></div><div class="content"><h2>Head</h2>{body}<p>Short</p></div><div class="related-links"><a href=/y>Other</a></div>'
    assert main_text(page).split("\n")[0] == "Head" and main_text(page).split("\n")[-1] == "Short"
    assert len(main_text(page).split("\n")) == 6


def test_neighbours_decide_for_a_doubtful_block():
    doubtful = "<div>1999</div>"
    long = "<div>A sentence that is long enough, and then some more words after it.</div>"
    assert "1999" in main_text("<body>" + long + doubtful + long + "</body>")
    assert main_text("<body>" + doubtful + "</body>") == ""


def test_edge_cases():
    assert [main_text(x) for x in (None, "", " ", "<", "<p", "<!-- x", "<script>x", "<p></p>", "&nbsp;")] == [""] * 9
    assert main_text("<article>a &#233;&eacute; &unknown; <b>b</b>c</article>") == "a éé &unknown; bc"
    assert main_text('<article><p data-x="a>b">x</p><img alt="1 > 0">y</article>') == "x\ny"
    assert len(main_text("<article>" + "<p>word.</p>" * 20_000 + "</article>").split("\n")) == 20_000
    assert main_text("<div>" * 5_000 + "<article>deep</article>") == "deep"
    assert main_text('<article><a title="' + "x" * 100_000) == ""


def test_attribute_values_of_any_length_and_stray_quotes():
    for quote in "\"'":
        value = quote + "data:,<b>" + "x" * 10_240 + quote
        blocks = blocks_of(f"<article><p>one<img src={value}> <b>two</b><div data-props={value}>three</div>four</article>")
        assert [(b.text, b.element.tag) for b in blocks] == [("one two", "p"), ("three", "div"), ("four", "article")]
    for value in ('"5" screen"', '"5', "'5", "it's", '"a"b"', 'x"'):
        blocks = blocks_of(f'<p><a title={value}>one</a> two</p><p class="a" id=\'b\'>three</p>')
        assert [(b.text, b.linked) for b in blocks] == [("one two", 3), ("three", 0)], value
    assert main_text("<article>if a<b, c<d then <b title=\"a>b\"class='x'>y</b></article>") == "if a<b, c<d then y"


def test_only_raw_elements_are_dropped():
    cases = {
        '<p>one</p><p><svg class="i"/> two</p><p>three</p>': "one|two|three",
        '<p>one<svg data-x="a>b"><text>no</text></svg> two</p><svg-icon>three</svg-icon>': "one two|three",
        "<p>one <svg><path d=x><p>two</p><svg><p>three": "one|two|three",
        "<p>let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be <math/> it</p>": "let x=1 be it",
        "<noscript><p>one</p></noscript><object data=x><p>two</p></object><canvas>three</canvas>": "one|two|three",
        '<SCRIPT>"<p>no</script >one<style/>no</style><template><p>no</p></template><textarea>no</textarea><script>no': "one",
    }
    assert {page: "|".join(b.text for b in blocks_of(page)) for page in cases} == cases


def test_names_tell_by_all_their_words():
    told = {
        "ad": 1, "site-footer": 1, "cookieNotice": 1, "related-links": 1, "comment-12": 1, "sidebar-left": 1, "ads-box": 1,
        "share-price": 0.5, "side-by-side": 0.5, "hidden-gems": 0.5, "has-sidebar": 0, "no-comments": 0,
        "article-header": 0, "header": 1, "site-header": 1, "price": 0, "": 0, "42": 0,
    }
    assert {name: named_boilerplate(name) for name in told} == told
    text = "A sentence of the article, which goes on for some words."
    assert main_text(f"<article><p>{text}</p><p class='share-price'>It rose by five.</p></article>") == f"{text}\nIt rose by five."
    assert main_text(f"<main><p>{text}</p><div class='side-by-side'>Two columns of text.</div><p>{text}</p></main>").count("\n") == 2
    assert main_text(f"<article><p>{text}</p><div class='related-posts'><p>{text}</p></div></article>") == text
    assert main_text(f"<div class='article-header'><h1>Head</h1></div><article><p>{text}</p></article>").startswith("Head\n")


def test_controls_are_inline():
    text = "A sentence of the article, which goes on for some words."
    assert main_text("<article><p>Press <button>x</button> now</p></article>") == "Press x now"
    assert main_text(f"<article><p>{text}</p><div><button>Share</button> <button><b>Save</b> it</button></div></article>") == text
    assert main_text("<article><p>one <select><option>a<option>b</select>two <iframe src=x>no</iframe>three.</p></article>") == "one two three."
    for tag in ("button", "select", "iframe", "svg", "datalist"):
        assert main_text(f"<article><p>{text} <{tag}> and more</p><p>{text}</p></article>") == f"{text} and more\n{text}", tag


def test_unmatched_tags_take_linear_time():
    for page in ("<div>" * 8_000 + "</p>" * 8_000, "<div>" * 8_000 + "</div>" * 16_000, "<button>" * 20_000 + "</button>", "<p><td>" * 8_000):
        begun = time.monotonic()
        main_text(page)
        assert time.monotonic() - begun < 1
    assert [(b.text, b.element.tag) for b in blocks_of("<div><p>a</section>b</div>c</div>d")] == [("a", "p"), ("b", "p"), ("c", "#page"), ("d", "#page")]


def test_tags_that_never_end_take_linear_time():
    begun = time.monotonic()
    for part in ('<a title="', "<a b='<a b=\"", '<a b="x" ', " b=\"<a c='\"", '<p ="', "><svg"):
        main_text("<a" + part * 100_000)
    assert time.monotonic() - begun < 30


def test_blocks_and_links():
    blocks = blocks_of("<p>a <a href=x>b c</a> d</p>e<td>f<tr><td>g")
    assert [(b.text, b.element.tag, b.linked) for b in blocks] == [("a b c d", "p", 3), ("e", "#page", 0), ("f", "td", 0), ("g", "td", 0)]


def test_minimum_cut_is_the_cheapest_labelling():
    chance = random.Random(1)
    for _ in range(300):
        n = chance.randrange(1, 9)
        odds = [chance.uniform(-2, 2) for _ in range(n)]
        edges = [(a, b, chance.uniform(0, 1.5)) for a in range(n) for b in range(a + 1, n) if chance.random() < 0.4]

        def cost(labels):
            own = sum(o if o > 0 and not x else -o if o < 0 and x else 0 for o, x in zip(odds, labels, strict=True))
            return own + sum(w for a, b, w in edges if labels[a] != labels[b])

        assert abs(cost(minimum_cut(odds, edges)) - min(cost(x) for x in product([False, True], repeat=n))) < 1e-6


def test_on_spark(spark):
    rows = [(1, "u", PAGE, "x"), (2, None, None, "x"), (2, None, None, "x"), (None, "v", "", None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars string")
    out = extracted(frame, CutRules())
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in out.collect()) == [(0, "", 0), (1, TEXT, len(TEXT)), (2, "", 0), (2, "", 0)]
    assert extracted(frame.limit(0)).count() == 0
