import pytest

from reelscope.llm.html_text import extract_main_text, main_text, measure, parse
from tests.llm.cases import table

SCHEMA = "page_id bigint, url string, html string, text string, n_chars int"
ARTICLE = "".join(f"<p>Paragraph {i} of the article has a good number of words in it.</p>" for i in range(6))
LINES = "\n".join(f"Paragraph {i} of the article has a good number of words in it." for i in range(6))
MENU = "<ul>" + "".join(f'<li><a href="/{i}">Menu entry {i}</a></li>' for i in range(8)) + "</ul>"


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>T</title></head><body><nav>{MENU}</nav><article>{ARTICLE}</article><footer>foot</footer></body></html>",
        f"<body><div class='menu'>{MENU}</div><div id='content'>{ARTICLE}</div><div class='sidebar'><p>Side text of some length here.</p></div></body>",
        f"<body>{MENU}<div>{ARTICLE}</div>{MENU}</body>",
        f"<body><div><div><div>{ARTICLE}</div></div></div><div role='complementary'><p>{'noise ' * 40}</p></div>",
        f"<body><article>{ARTICLE}<section class='comments'><p>{'I think so. ' * 30}</p></section></article>",
        f"<body><article>{ARTICLE}<div class='ad'>buy {'now ' * 50}</div><form><p>{'sign up ' * 30}</p></form></article>",
        f"<body><div class='cookie-notice'>{'We use cookies. ' * 20}</div><main>{ARTICLE}</main><aside>{'see also ' * 30}</aside>",
        f"<article>{ARTICLE}<script>var p='</p><p>no</p>';</script><style>p{{}}</style><!-- <p>no</p> --><noscript>no</noscript>",
        f"<BODY><ARTICLE>{ARTICLE.upper().replace('PARAGRAPH', 'Paragraph')}</ARTICLE><FOOTER>F</FOOTER>".replace(
            " OF THE ARTICLE HAS A GOOD NUMBER OF WORDS IN IT.", " of the article has a good number of words in it."
        ),
        f"<body><header><h1>Site name</h1>{MENU}</header><article>{ARTICLE}</article>",
        f"<body><article><section>{ARTICLE[: len(ARTICLE) // 2]}</section><section>{ARTICLE[len(ARTICLE) // 2 :]}</section></article>",
        f"<article>{ARTICLE.replace('</p>', '')}",
        f"<article>{ARTICLE}<p class='x",
        f"<article>{ARTICLE}<div style='display: none'>hidden</div><p hidden>hidden</p>",
    ],
)
def test_article_without_boilerplate(page):
    assert main_text(page) == LINES


def test_blocks_white_space_and_references():
    page = (
        "<article><h1>Title &amp; more&copy</h1><p>a\n  b&nbsp;&nbsp;c<br>d <b>e</b><i>f</i></p>\n"
        "<ul><li>one<li>two &lt;p&gt;</ul><table><tr><td>x<td>y</table><p>  </p><p>&#233;&#x1F600;</p></article>"
    )
    assert main_text(page).split("\n") == ["Title & more©", "a b c d ef", "one", "two <p>", "x", "y", "é😀"]


def test_short_blocks_stay_and_sections_elsewhere_count():
    dense = "<p>" + "A long and dense paragraph of the text goes on. " * 8 + "</p>"
    page = f"<body><div>{dense}<p>Yes.</p><p>No.</p>{dense}</div><div>{dense}{dense}</div>{MENU}</body>"
    lines = main_text(page).split("\n")
    assert len(lines) == 6 and lines[1:3] == ["Yes.", "No."]


@pytest.mark.parametrize(
    "part, text",
    [
        ('<section id="discussion"><h2>Discussion</h2><p>What follows from it.</p></section>', "Discussion\nWhat follows from it."),
        ('<p class="related work">Others did it before.</p>', "Others did it before."),
        ('<p class="responses">They answered late.</p>', "They answered late."),
        ('<section class="social history"><p>Of the town.</p></section>', "Of the town."),
        ('<section id="advertising"><p>How firms advertise.</p></section>', "How firms advertise."),
        ('<p>See <a href="/a">Alpha paper of the first group</a> and <a href="/b">Beta paper</a>.</p>', "See Alpha paper of the first group and Beta paper."),
        ('<ol><li><a href="/a">First reference</a>, <a href="/b">copy</a></li></ol>', "First reference, copy"),
        ("bare words between blocks", "bare words between blocks"),
    ],
)
@pytest.mark.parametrize("place", ["<body><article>{}</article></body>", "<main><div>{}</div></main>"])
def test_nothing_of_an_article_is_lost_for_its_names_or_links(place, part, text):
    menu = f"<nav>{MENU}</nav>"
    page = place.format(ARTICLE + part + ARTICLE)
    assert main_text(menu + page) == f"{LINES}\n{text}\n{LINES}"


@pytest.mark.parametrize(
    "part",
    [
        f"<div class='related'><h3>More</h3>{MENU}</div>",
        f"<div class='social'>{MENU}</div>",
        "<div class='share'><a href='/f'>on one site</a> <a href='/t'>on another</a></div>",
        "<section id='discussion'><ul><li>First!</li><li>I disagree with all of it.</li></ul></section>",
        "<div class='respond'>Write to us <form><textarea></textarea></form></div>",
        "<div id='comments'><article>One reader says so.</article><article>Another does not.</article></div>",
        "<div class='notice'>Our terms have changed.</div>",
    ],
)
def test_boilerplate_in_an_article_goes_by_name_and_structure(part):
    assert main_text(f"<body><article>{ARTICLE}{part}</article></body>") == LINES
    assert main_text(f"<body><div id='content'>{ARTICLE}</div>{part}</body>") == LINES


def test_without_an_article_headings_and_short_sections_stay():
    long = "<p>" + "A long and dense paragraph of the text goes on. " * 8 + "</p>"
    short = "<div><p>Short one.</p><p>Short two.</p><p>Short three.</p></div>"
    page = f"<body><h1>The heading</h1><div>{long * 10}</div><h2>Second part</h2>{short}<h2>Elsewhere</h2>{MENU}</body>"
    lines = main_text(page).split("\n")
    assert lines[0] == "The heading" and lines[11:] == ["Second part", "Short one.", "Short two.", "Short three."]
    deeper = f"<body><div><h1>The heading</h1><div><div>{long * 10}</div>{short}</div></div>{MENU}</body>"
    assert main_text(deeper).split("\n")[0] == "The heading" and len(main_text(deeper).split("\n")) == 14


def test_density_decides_on_the_given_pages(spark, sf001_dir):
    """Without their article tags the given pages give the same text."""
    pages = [r.html for r in spark.read.parquet(f"{sf001_dir}/pages.parquet").collect()]
    plain = [p.replace("<article>", "<div>").replace("</article>", "</div>") for p in pages]
    assert [main_text(p) for p in plain] == [main_text(p) for p in pages]


def test_names_that_cover_the_whole_page_do_not_empty_it():
    assert main_text(f"<body><div class='post comments'>{ARTICLE}</div></body>") == LINES


def test_unquoted_addresses_and_deep_lists():
    root = parse("<p><a href=http://x.org/>link</a> text</p>")
    assert root.children[0].children[0].children == ["link"]
    deep = "<ul><li>" * 5000 + "bottom" + "</li></ul>" * 5000
    assert main_text(f"<article><p>top</p>{deep}</article>") == "top\nbottom"


def test_density_is_link_adjusted():
    root = parse(f"<body><div>{MENU}</div><div>{ARTICLE}</div></body>")
    measure(root)
    menu, text = root.children[0].children
    assert text.density > 3 * menu.density and text.density_sum > menu.density_sum


def test_odd_markup():
    for page in ("<", "<a", "</", "<p", "a < b", "</p></p>x", "<!--", "<![CDATA[x]]>", "<script>", "<p a='>", "&", "&am", "<p/>x", "<>x"):
        main_text(page)
    assert main_text("plain words only") == "plain words only"
    assert main_text("<p>a < b and 3<4</p><p>second</p>") == "a < b and 3<4\nsecond"
    assert main_text("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    assert main_text("<nav>only a menu</nav>") == ""
    for page in ("<a " * 60_000, "<p " + "a='" * 60_000, "&lt" * 60_000, '<p a="' * 30_000, "<!-- " * 60_000):
        main_text(page)


def test_rows(spark):
    long = "<article>" + "".join(f"<p>word{i} and more</p>" for i in range(20_000)) + "</article>"
    rows = [(1, "u", None, "x", 5), (1, "u", "", "x", 5), (None, None, "<p>t</p>", "x", 5), (2, "v", long, "x", 5), (2, "v", long, "x", 5)]
    got = sorted((tuple(r) for r in extract_main_text(table(spark, rows, SCHEMA)).collect()), key=repr)
    text = "\n".join(f"word{i} and more" for i in range(20_000))
    want = [(1, "u", "", 0), (1, "u", "", 0), (None, None, "t", 1), (2, "v", text, len(text)), (2, "v", text, len(text))]
    assert got == sorted(want, key=repr)
    assert extract_main_text(table(spark, [], SCHEMA)).collect() == []


def test_given_pages_have_their_article_text(spark, sf001_dir):
    """The given pages hold one h1 and p elements in an article; their text is known from the markup."""
    import html
    import re

    pages = spark.read.parquet(f"{sf001_dir}/pages.parquet")
    got = {r.page_id: r.text for r in extract_main_text(pages).collect()}
    for page in pages.collect():
        inner = re.sub(r"</article>.*", "", page.html.split("<article>")[1], flags=re.S)
        inner = re.sub(r"<[^>]*$", "", inner)
        blocks = re.split(r"</?(?:h1|p)>", inner)
        lines = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in blocks]
        assert got[page.page_id] == "\n".join(x for x in lines if x), page.page_id
