from hypothesis import given, settings
from hypothesis import strategies as st

from hirefunnel.llm import html_text

ARTICLE = "The history of the town is one of trade and of the river that it lies on, as many have said."


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


def test_boilerplate_goes_and_the_article_stays():
    html = page(
        "<nav><ul><li><a href=/>Home</a></li></ul></nav><header class=site>Site name</header>"
        f"<article><h1>A short heading</h1><p>{ARTICLE}</p><script>var x = '<p>no</p>';</script>"
        f"<p>Short line.</p><p>{ARTICLE} Caf&eacute; &amp; &#x4e2d;</p>"
        "<div class='ad-box advert'>Buy now, the best of all offers in the world for you</div></article>"
        f"<section id=comments><p>{ARTICLE} I liked this.</p></section>"
        "<form>Your e-mail <input></form><aside>Also read</aside><footer>© all rights</footer>"
    )
    assert html_text.main_text(html) == f"A short heading {ARTICLE} Short line. {ARTICLE} Café & 中"


def test_short_blocks_take_the_label_of_the_nearest():
    links = "<div><a href=/a>one link</a> <a href=/b>another link</a></div>"
    html = page(f"{links}<div>left out?</div><div>near it</div><div>{ARTICLE}</div>")
    # "left out?" is nearer to the links, "near it" to the article.
    assert html_text.main_text(html) == f"near it {ARTICLE}"


def test_white_space_and_unfinished_markup():
    assert html_text.main_text(f"<p> a \n\t b<br>c </p><p>{ARTICLE}") == f"a b c {ARTICLE}"
    assert html_text.main_text("<p>1 < 2 and x<!-- open comment") == "1 < 2 and x"
    assert html_text.main_text("text <script>never closed") == "text"
    assert html_text.main_text("a<div") == "a"
    assert [html_text.main_text(x) for x in (None, "", " ", "<p></p>")] == [""] * 4


def test_long_pages_take_linear_time():
    text = html_text.main_text(page("<div>" * 20_000 + f"<p>{ARTICLE}</p>" * 5_000))
    assert text.count(ARTICLE) == 5_000
    assert html_text.main_text("<article>" + "<" * 100_000) == "<" * 100_000


def test_inline_boilerplate_takes_nothing_that_follows():
    share = '<a class="share" href=#>Share</a>'
    icon = '<i class="icon" aria-hidden="true">x</i>'
    assert html_text.main_text(f"<article>{share}<p>{ARTICLE}</p><p>{ARTICLE}</p></article>") == f"{ARTICLE} {ARTICLE}"
    assert html_text.main_text(f"<p>Start {icon} rest</p>") == "Start rest"
    # The paragraph stays one block: neither half is long enough by itself, and links stand nearer.
    half = len(ARTICLE) // 2
    menu = "<div><a href=/>one</a> <a href=/>two</a></div>"
    cut = f"{menu}<p>{ARTICLE[:half]}{icon}{ARTICLE[half:]}</p>{menu}"
    assert html_text.main_text(cut) == ARTICLE
    # Spans in an advert, an advert with blocks, unclosed and crossed elements.
    advert = "<span class=advert>Buy <span>this</span> now</span>"
    assert html_text.main_text(f"<article>{advert}<p>{ARTICLE}</p>{advert} end</article>") == f"{ARTICLE} end"
    boxes = "<a class=advert href=/><div>Buy</div><p>this</p></a>"
    assert html_text.main_text(f"<article>Before {boxes} after<p>{ARTICLE}</p></article>") == f"Before after {ARTICLE}"
    assert html_text.main_text(f"<article><p>a <span hidden>b<p>{ARTICLE}</p></article>") == f"a {ARTICLE}"
    assert html_text.main_text(f"<article><a class=advert><div>Buy</a>{ARTICLE}</div></article>") == ARTICLE


def test_only_attributes_of_their_own_tell_boilerplate():
    kept = [
        "style='overflow:hidden'", 'title="The hidden cost"', "title='a class=\"ad\" is hidden'", "data-hidden",
        "data-x=hidden", "aria-hidden=false", "class=post data-class=ad", "alt='id=footer role=menu'",
        "class=post class=advert", "href=/?id=footer",
    ]
    for attributes in kept:
        for name in ("div", "article", "p"):
            assert html_text.main_text(f"<{name} {attributes}>{ARTICLE}</{name}>") == ARTICLE, (name, attributes)
    lost = [
        "hidden", "HIDDEN=''", "x hidden", "style='a:b'hidden", "hidden=until-found", "aria-hidden = 'true'",
        "ID = footer", "title='post'class='x advert'", "role=menu", "/class=\"advert\"",
    ]
    for attributes in lost:
        html = f"<article>{ARTICLE}<div {attributes}>Buy this</div></article>"
        assert html_text.main_text(html) == ARTICLE, attributes


def test_names_of_layouts_and_topics_are_kept():
    for names in ("col has-sidebar", "no-sidebar", "with-ads", "sidebar-left", "nav-open", "page--no-sidebar"):
        assert html_text.main_text(f'<div id=content class="{names}"><p>{ARTICLE}</p></div>') == ARTICLE, names
    for names in ("post has-comments", "post sponsored", "no-share"):
        assert html_text.main_text(f'<article class="{names}"><p>{ARTICLE}</p></article>') == ARTICLE, names
    parts = f'<section id="related-work"><p>{ARTICLE}</p></section><h2 id="social-impact">Social</h2><p>{ARTICLE}</p>'
    assert html_text.main_text(f"<article>{parts}</article>") == f"{ARTICLE} Social {ARTICLE}"
    # Whole names: a heading's topic, and long prose of an article, also in a span.
    topic = f'<h2 id=cookies>Cookies</h2><section id=advertising class=notice><p>{ARTICLE}</p><p>Short</p></section>'
    assert html_text.main_text(f"<main>{topic}</main>") == f"Cookies {ARTICLE}"
    span = f"<p>Before <span class=notice>{ARTICLE}</span> after {ARTICLE}</p>"
    assert html_text.main_text(f"<main>{span}</main>") == f"Before {ARTICLE} after {ARTICLE}"


def test_whole_names_and_known_pairs_are_left_out():
    names = """ad ads ad-box ad-300x250 ad1 comments comment-12 comments-area cookie-banner site-footer share-buttons
    article__share post-comments related-posts social-links newsletter_signup widget-area main-nav x--y""".split()
    for name in names:
        html = f'<article><p>{ARTICLE}</p><div class="{name}">Buy this</div></article>'
        assert html_text.main_text(html) == ARTICLE + (" Buy this" if name == "x--y" else ""), name
    # Adverts and readers' comments go at any length.
    for name in ("advert", "comments", "comment-12 even", "cookie-consent"):
        assert html_text.main_text(f'<article><p>{ARTICLE}</p><p class="{name}">{ARTICLE}</p></article>') == ARTICLE


def test_stray_quotes_do_not_hold_a_tag_open():
    after = f"<p>{ARTICLE}</p><p class='x' title=\"y\">{ARTICLE}</p>"
    tags = [
        "<p title=don't>", '<b title="x"">', "<p 'x>", '<p x"y>', "<p title=5\">", "<p a='b'c'>", "<p/'>", "<p = '>",
        "<p a=b\"c'd>", "<p a='>'>", '<p a = ">" b>',
    ]
    for tag in tags:
        for rest in (after, f"<p>{ARTICLE}</p><p>{ARTICLE}</p>"):
            assert html_text.main_text(tag + "One. " + rest) == f"One. {ARTICLE} {ARTICLE}", tag
    # A quoted value whose quote never comes ends at the next ">", an unfinished tag takes the rest.
    assert html_text.main_text(f'<p title="x>{ARTICLE}</p>') == ARTICLE
    assert html_text.main_text("a<p title='x>' b") == "a"
    # The slash of an unquoted value closes no element.
    assert html_text.main_text(f"<article>{ARTICLE}<div class=advert data-to=/>Buy</div></article>") == ARTICLE
    assert html_text.main_text("<p a='" * 50_000 + f">{ARTICLE}") == ARTICLE


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("< > </ <p> </p> <a href='x'> </a> <nav> </nav> &amp; &# \" ' a b <!-- --> <script> </script> <article>".split())).map("".join))
def test_any_markup(html):
    text = html_text.main_text(html)
    assert text == " ".join(text.split())


RUSSIAN = "Это длинный абзац текста о мостах и реках, который должен остаться в статье без потерь. " * 2
POLISH = "Most nad rzeką zbudowano dawno temu, lecz ludzie nadal nim chodzą każdego dnia do pracy. " * 2
CHINESE = "这座桥建于洪水之年,镇上的人们至今仍在使用它。" * 8


def test_languages_without_known_words_keep_their_text():
    for prose in (RUSSIAN, POLISH, CHINESE):
        text = " ".join(prose.split())
        for html in (
            f"<div><h1>T</h1><p>{prose}</p><p>{prose}</p></div>",
            f"<nav><a href=x>a</a></nav><div><h1>T</h1><p>{prose}</p><p>{prose}</p></div><footer>f</footer>",
        ):
            assert html_text.main_text(html) == f"T {text} {text}"
    # A quotation in other letters on a page of a known language stays with its neighbours.
    text = " ".join(RUSSIAN.split())
    assert html_text.main_text(f"<p>{ARTICLE}</p><p>{RUSSIAN}</p><p>{ARTICLE}</p>") == f"{ARTICLE} {text} {ARTICLE}"


def test_linked_prose_of_an_article_stays_and_lists_of_links_go():
    linked = "<p>Read <a>the full report of the commission on bridges</a> now.</p>"
    source = "<ul><li><a>A history of bridges and rivers</a>, 1931</li></ul>"
    menu = "<ul><li><a>Home and garden</a></li><li><a>Sport</a></li></ul><p>Tags: <a>bridge</a> <a>river</a></p>"
    html = f"<article><p>{ARTICLE}</p>{linked}{source}<p>{ARTICLE}</p>{menu}<p>{ARTICLE}</p></article>"
    report, book = "Read the full report of the commission on bridges now.", "A history of bridges and rivers, 1931"
    want = f"{ARTICLE} {report} {book} {ARTICLE} {ARTICLE}"
    assert html_text.main_text(html) == want


def test_boilerplate_of_two_names_and_comments_under_a_count():
    for element in (
        f"<div class='newsletter-signup'>{ARTICLE}</div>",
        f"<div class='related-stories'>{ARTICLE}</div>",
        f"<div class='reader-comments'>{ARTICLE}</div>",
        f"<div class='comment-thread'>{ARTICLE}</div>",
        f"<div id='discussion'><h2>3 Responses</h2><p>{ARTICLE}</p></div>",
        f"<section><h3>12 Kommentare zu diesem Text</h3><p>{ARTICLE}</p><p>{ARTICLE}</p></section>",
    ):
        assert html_text.main_text(f"<article><p>{ARTICLE}</p>{element}<p>{ARTICLE}</p></article>") == f"{ARTICLE} {ARTICLE}", element
    # A section that is called so without a count is the article's own.
    html = f"<article><section id='discussion'><h2>Discussion</h2><p>{ARTICLE}</p></section></article>"
    assert html_text.main_text(html) == f"Discussion {ARTICLE}"


def test_unclosed_elements_take_linear_time():
    import time

    for unit in ("<option>aaa ", "<button>", "<select>", "<svg>", "<svg><button>", "<option aaa ", "<style>x"):
        html = unit * (1_000_000 // len(unit))
        start = time.process_time()
        html_text.main_text(html)
        assert time.process_time() - start < 10, unit
    assert html_text.main_text(f"<svg><svg></svg>x</svg><p>{ARTICLE}</p><select><option>a</select>") == ARTICLE


def test_query(spark):
    rows = [(1, "u", page(f"<p>{ARTICLE}</p>"), 5), (1, "u", None, 6), (None, None, "", 7)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    out = sorted((tuple(r) for r in html_text.extracted(pages).collect()), key=str)
    want = [(1, "u", ARTICLE, len(ARTICLE)), (1, "u", "", 0), (None, None, "", 0)]
    assert out == sorted(want, key=str)
    assert html_text.extracted(pages.limit(0)).collect() == []
