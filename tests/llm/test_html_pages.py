"""Hand-made pages of many structures with their main texts."""

import pytest

from tabforge.llm import html

LONG = "This is a sentence of the story that goes on for some words. And here comes another one, a little longer than the first."
SECOND = "The second paragraph tells more about the same matter. It is as long as paragraphs usually are on such pages."
NAV = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/b'>About us</a></li></ul></nav>"
P = f"<p>{LONG}</p><p>{SECOND}</p>"
BOTH = [LONG, SECOND]

PAGES = [
    (f"<article><h1>Title</h1>{P}</article>", ["Title", *BOTH]),
    (f"<main><h1>Head line</h1><p>{LONG}</p><ul><li>Item one of list</li></ul></main>", ["Head line", LONG, "Item one of list"]),
    (f"<main>{NAV}<h1>Head line</h1>{P}</main>", ["Head line", *BOTH]),
    (f"<main><div class='sidebar'><p>Other stories of the week</p></div>{P}</main>", BOTH),
    (f"<main>{P}<div class='comments'><p>A reader says that this is all wrong, and he says it at some length.</p></div></main>", BOTH),
    (f"<div class='cookie notice'><p>We use cookies to make this site better.</p></div><article>{P}</article>", BOTH),
    (f"<article>{P}<aside><p>Read also what others wrote about it last year.</p></aside></article>", BOTH),
    (f"<article><form><p>Enter your address to get our letter.</p></form>{P}</article>", BOTH),
    (f'<article><p title="a > b">{LONG}</p></article>', [LONG]),
    (f"<article><p title='a > b' data-x=\"it's > that\">{LONG}</p></article>", [LONG]),
    (f"<article><p title=it's>{LONG}</p><p>{SECOND} It's done.</p></article>", [LONG, SECOND + " It's done."]),
    (f"<div><div>{LONG}</div><div>{SECOND}</div></div>", BOTH),
    (f"<section><h2>Story</h2>{P}</section>", ["Story", *BOTH]),
    (f"<body>{NAV}<div id='content'><h1>Title</h1>{P}</div><footer>&copy; 2020 All of us</footer></body>", ["Title", *BOTH]),
    (f"<header><p>Site name and claim</p></header><article><header><h1>Title</h1></header>{P}</article>", ["Title", *BOTH]),
    (f"<html><head><title>T</title><style>p{{x}}</style></head><body><article>{P}</article></body></html>", BOTH),
    (f"<article><blockquote>{LONG}</blockquote><p>{SECOND}</p></article>", BOTH),
    (f"<article><p>{LONG}</p><pre>{SECOND}</pre></article>", BOTH),
    (f"<main><table><tr><td>{LONG}</td><td>{SECOND}</td></tr></table></main>", BOTH),
    (f"<article><p>One<br>two &amp; three &eacute;</p>{P}</article>", ["One two & three é", *BOTH]),
    (f"<article>{P}<div class='share'><p>Share this with your friends</p></div><div class='related'><p>Related matter</p></div></article>", BOTH),
    (f"<article>{P}</article><section id='comments'><article><p>I do not think that this is right at all.</p></article></section>", BOTH),
    (f"<div role='navigation'><p>Way to all the parts</p></div><main>{P}</main>", BOTH),
    (f"<article>{P}<script>if (a > b) {{ document.write('<p>x</p>') }}</script></article>", BOTH),
    (f"<body class='with-sidebar'><main class='has-sidebar'>{P}</main></body>", BOTH),
    (f"<div class='banner'>Buy two for the price of one today</div><article>{P}</article><div class='ad'>Buy now and here</div>", BOTH),
    (f"<article><h1>Title</h1><h2>Sub title</h2><p>{LONG}</p><h3>Next part</h3><p>{SECOND}</p></article>", ["Title", "Sub title", LONG, "Next part", SECOND]),
    (f"<article><dl><dt>Term</dt><dd>{LONG}</dd></dl></article>", ["Term", LONG]),
    (f"<article><figure><figcaption>What the picture shows</figcaption></figure><p>{LONG}</p></article>", ["What the picture shows", LONG]),
    (f"<main><section><h2>A</h2><p>{LONG}</p></section><section><h2>B</h2><p>{SECOND}</p></section></main>", ["A", LONG, "B", SECOND]),
    (f"<div class='menu'><ul><li>First</li><li>Second</li></ul></div><article>{P}</article><div class='newsletter'><p>Get our letter</p></div>", BOTH),
    (f"<article>{P}<dialog><p>Do you want to log in?</p></dialog><button>Press</button></article>", BOTH),
    ("<nav><a href='/'>Home</a></nav><footer><p>Nothing else here</p></footer>", []),
]


@pytest.fixture(scope="module")
def labeller(spark):
    return html.fit_labeller(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def test_hand_made_pages(spark, labeller):
    frame = spark.createDataFrame([(i, page) for i, (page, _) in enumerate(PAGES)], "page_id long, html string")
    got = {r["page_id"]: r["text"] for r in html.extract_text(frame, labeller).collect()}
    wrong = [(page, got[i]) for i, (page, want) in enumerate(PAGES) if got[i] != "\n".join(want)]
    assert not wrong, wrong


def test_labels_follow_the_landmarks():
    for markup, want in PAGES:
        page = html.read_page(markup)
        assert [t for t, y in zip(page.texts, html.page_labels(page)) if y] == want, markup


def test_an_unclosed_quote_hides_nothing():
    assert html.read_page('<p title="open>one</p><p>two</p>').texts == ["one", "two"]
    assert html.read_page("<p a=b c='d'>one</p>").texts == ["one"]
