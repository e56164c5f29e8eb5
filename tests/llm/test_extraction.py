"""Main text of pages: made-up pages whose article is known, and the rules one by one."""

import html
import random
from html.parser import HTMLParser

import pytest

from serieslake.llm import extraction as x
from serieslake.llm.common import table

SENTENCE = "The house on the hill was built by the people who had come to the valley in the spring, and it is still there."


class Article(HTMLParser):
    """Brute force for the given pages: whatever stands within <article>."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.parts = False, []

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag != "b":
            self.parts.append(" ")

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        if tag != "b":
            self.parts.append(" ")

    def handle_data(self, data):
        if self.inside:
            self.parts.append(data)


def test_given_pages_against_a_parser(spark, sf):
    pages = {r.page_id: r for r in table(spark, sf, "pages").collect()}
    rows = x.extract(table(spark, sf, "pages")).collect()
    assert len(rows) == len(pages)
    for row in rows:
        parser = Article()
        parser.feed(pages[row.page_id].html)
        parser.close()
        assert row.text == " ".join("".join(parser.parts).split())
        assert (row.url, row.n_chars) == (pages[row.page_id].url, len(row.text))


@pytest.mark.parametrize("seed", range(20))
def test_made_up_pages(seed):
    rng = random.Random(seed)
    junk = [
        "<nav><ul><li><a href='/a'>Home</a><li><a href='/b'>News</a></ul></nav>", "<div class='ad-slot'>Buy the new car of the year and save money on it now</div>",
        "<aside>" + SENTENCE + "</aside>", "<form><p>" + SENTENCE + "<input name=q><button>Go</button></form>", "<div id=cookie-notice>We use cookies. " + SENTENCE + "</div>",
        "<script>if (a < b) document.write('<p>" + SENTENCE + "</p>')</script>", "<style>p > a {color: red}</style>", "<!-- <p>" + SENTENCE + "</p> -->",
    ]
    body, want = [], []
    for k in range(rng.randint(1, 6)):
        text = rng.choice([SENTENCE, "Short one.", f"{SENTENCE} & <more> {k}", "Nicht der Rede wert.", SENTENCE * 3])
        body.append(rng.choice(["<p>{}</p>", "<p class=lead>{}", "<div>{}</div>", "<ul><li>{}</ul>", "<blockquote>{}</blockquote>"]).format(html.escape(text).replace("house", "<b>ho</b>use")))
        want.append(text)
        if rng.random() < 0.4:
            body.append(rng.choice(junk[1:]))
    wrap = rng.choice(["<article>{}</article>", "<main><header><h1>Title here</h1></header>{}</main>", "<div class='sidebar-left'><article class='post'>{}</article></div>"])
    if "Title" in wrap:
        want.insert(0, "Title here")
    page = f"<!DOCTYPE html><html><head><title>Title {SENTENCE}</title></head><body>{rng.choice(junk)}<header><p>{SENTENCE}</p></header>{wrap.format(''.join(body))}<section class='comments'><p>{SENTENCE}</p></section><footer>&copy; {SENTENCE}</footer></body></html>"
    assert x.main_text(page) == " ".join(want)


def test_without_an_article_density_decides():
    page = f"<body><div>Menu of the day</div><p><a href=x>{SENTENCE}</a></p><h2>Head line</h2><p>{SENTENCE}</p><p>Short.</p><p>{SENTENCE}</p><p><a href=1>One</a> <a href=2>Two</a></p><div>Imprint</div>"
    assert x.main_text(page) == f"Head line {SENTENCE} Short. {SENTENCE}"


def test_neighbours_by_brute_force():
    rng = random.Random(4)
    for _ in range(200):
        n = rng.randint(0, 9)
        found = [x.Block("t", 0, rng.random() < 0.3, False, True) for _ in range(n)]
        labels = [rng.choice([1, -1, 0, 0]) for _ in range(n)]
        for i, kept in enumerate(x.settle(found, labels)):
            near = sorted((abs(i - j), (j < i) == found[i].heading, labels[j]) for j in range(n) if labels[j])
            assert kept == ((near[0][2] if near else 1) == 1 if not labels[i] else labels[i] == 1)


@pytest.mark.parametrize(("page", "text"), [
    ("", ""), ("plain words", "plain words"), ("<p>a&nbsp;b&amp;c &#8364; &bogus;</p>", "a b&c € &bogus;"), ("<article><p>One<br>two<p>three</article", "One two three"),
    ("<article><p>cut off <a hre", "cut off"), ("<article><p>tail &am", "tail &am"), ("<article>x < y and <p title='a>b'>z</p></article>", "x < y and z"),
    ("<script>never closed <p>text</p>", ""), ("<article><div hidden>no</div>yes<div style='display:none'>no</div></article>", "yes"), ("<article><p>in</p><div class=comment><article><p>reply</p></article></div></article>", "in"),
])
def test_odd_markup(page, text):
    assert x.main_text(page) == text


def test_long_page_and_edge_rows(frame):
    big = "<article>" + "<p>" + SENTENCE + "</p>" * 3 + ("<p>word</p>" * 50_000) + "</article>"
    pages = frame("page_id long, url string, html string, text string", (1, "u", None, "t"), (None, None, "", "t"), (2, "u", big, None), (2, "u", big, None))
    rows = x.extract(pages).collect()
    assert sorted(r.n_chars for r in rows) == [0, 0] + [len(SENTENCE) + 5 * 50_000] * 2
    assert x.extract(frame("page_id long, url string, html string")).count() == 0


RUSSIAN = "Дом на холме построили люди, которые весной пришли в долину, и он до сих пор стоит там, где его поставили."
POLISH = "Dom na wzgórzu zbudowali ludzie, którzy wiosną przyszli w dolinę, i stoi tam do dziś, choć nikt już w nim nie mieszka."
CHINESE = "山上的房子是春天来到山谷的人们建造的，" * 5


def test_links_in_an_article_drop_only_themselves():
    assert x.main_text("<article><p>Short one.</p><p>Short two.</p><p><a href=s>Source</a></p></article>") == "Short one. Short two."
    assert x.main_text(f"<article><p><a href=s>Source</a></p><p>Short one.</p><p>{SENTENCE}</p><p><a href=t>More</a></p><p>Short two.</p></article>") == f"Short one. {SENTENCE} Short two."


@pytest.mark.parametrize("text", [RUSSIAN, POLISH, CHINESE])
def test_languages_without_stop_words(text):
    assert x.main_text(f"<article><p>{text}</p><p>{text}</p><p><a href=s>{text[:9]}</a></p></article>") == f"{text} {text}"
    page = f"<body><p><a href=1>{text[:5]}</a> <a href=2>{text[5:9]}</a></p><p>{text}</p><p>{text[:20]}</p><p>{text}</p><p><a href=3>{text[:7]}</a></p><div>{text[:8]}</div>"
    assert x.main_text(page) == f"{text} {text[:20].strip()} {text}"


@pytest.mark.parametrize("box", ["<aside class=related>{}</aside>", "<div class='related-box'>{}</div>", "<div id=recommended-list>{}</div>", "<nav>{}</nav>", "<div class=promo>{}</div>", "<div hidden>{}</div>"])
def test_teasers_within_boxes_stay_out(box):
    teaser = box.format(f"<article><h3>Other news</h3><p>{SENTENCE}</p></article>")
    assert x.main_text(f"<body><article><p>{SENTENCE}</p></article>{teaser}</body>") == SENTENCE
    assert x.main_text(f"<body><article><p>{SENTENCE}</p>{teaser}<p>End.</p></article></body>") == f"{SENTENCE} End."


@pytest.mark.parametrize("name", ["content-with-sidebar", "no-sidebar", "skip-lead", "social-history", "has-banner", "without-menu post"])
def test_names_that_only_mention_a_mark(name):
    for page in (f"<body class='{name}'><div class='{name}'><p>{SENTENCE}</p></div></body>", f"<article><div id='{name}'><p>{SENTENCE}</p></div></article>"):
        assert x.main_text(page) == SENTENCE


@pytest.mark.parametrize("name", ["sidebar", "sidebar-left", "left_sidebar", "main-menu", "cookieBar cookie-notice", "ad-slot", "site-footer footer", "social-share-buttons"])
def test_names_that_are_marks(name):
    assert x.main_text(f"<body><p>{SENTENCE}</p><div class='{name}'><p>{SENTENCE}</p></div><p>{SENTENCE}</p></body>") == f"{SENTENCE} {SENTENCE}"


def test_page_within_a_form():
    inner = f"<p>{SENTENCE}</p><p>Short.</p><p>{SENTENCE}</p>"
    assert x.main_text(f"<body><form action=x>{inner}</form></body>") == f"{SENTENCE} Short. {SENTENCE}"
    assert x.main_text(f"<body><form><nav><a href=1>One</a></nav><article>{inner}</article></form></body>") == f"{SENTENCE} Short. {SENTENCE}"
    assert x.main_text(f"<body>{inner}<form><p>{SENTENCE}</p></form></body>") == f"{SENTENCE} Short. {SENTENCE}"
    assert x.main_text(f"<article>{inner}<form><p>{SENTENCE}</p></form></article>") == f"{SENTENCE} Short. {SENTENCE}"


def test_article_paragraph_that_is_one_link():
    assert x.main_text(f"<article><p>{SENTENCE}</p><p><a href=r>{SENTENCE}</a></p><p><a href=1>More on this</a> <a href=2>and this</a></p></article>") == f"{SENTENCE} {SENTENCE}"
