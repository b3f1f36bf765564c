"""Template deduction and extraction on pages with known articles."""

import random
import time
from collections import defaultdict
from html.parser import HTMLParser

import pytest
from conftest import rows

from parityline.llm import html_template as H


def test_tokens_of_a_page():
    page = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="</p><p>x";</script>
    </head><body><nav><ul><li><a>menu</a></ul></nav><div class="ad big">buy</div><!-- <p>no</p> -->
    <article><h1>Head &amp; tail</h1><p>One <b>two<br>three</b>\n four<p>five &#233;&eacute;<p>  <p>six</p>seven
    <div id="comments"><p>nice</p></div><form><p>name</p></form></article>
    <footer>&copy; us</footer></body></html><p"""
    assert H.extract(page) == "Head & tail\nOne two three four\nfive éé\nsix\nseven"
    texts = [t for t in H.parse(page) if t.text]
    assert len({t.within for t in texts}) == 2  # the heading, and the article
    assert len({t.hash for t in H.parse(page) if t.text is None}) == 5  # html, body, article, h1, p
    assert H.extract(page, frozenset({texts[1].hash})) == "Head & tail\nfive éé\nsix\nseven"


def test_odd_pages():
    for page in (None, "", " ", "<", "<p", "<article>", "</p></div>", "<script>x", "<p a='", "<!--", "</"):
        assert H.extract(page) == ("<" if page == "<" else "")
    assert H.extract("plain  text") == "plain text"
    assert H.extract("a < b") == "a < b"
    assert H.extract("x <!-- open") == "x"
    assert H.extract("<a title='>'>x</a>") == "x"
    assert H.extract("<p title=\"x>Hello</p>") == "Hello"
    assert H.extract("<p title=\"x>Hello</p><p title='y'>there</p>") == "Hello\nthere"
    assert H.extract("<p title=\"x>Hello</p><p title=\"y\">there</p>") == "Hello\nthere"
    assert H.extract("<p onclick='if(a>b && c<d)x()'>it's</p>") == "it's"
    assert H.extract("<p data-x='<b>no</b>' title = \"a'b\">yes</p>") == "yes"
    assert len(H.extract("<p>" + "w " * 200_000)) == 399_999


@pytest.mark.parametrize(
    "part",
    ["<a ", '<a "', "<a '", "<a href=\"'", "<div>", "<div class=ad>", "<div class=sidebar>", "<p a=\"><p b='",
     "<span class=ad>", "</a ", "<!--", "<", "<td><p><li>", "&amp;", "<div class=sidebar><h1>", "<a b=", "<p> "],
)
def test_a_page_of_a_megabyte_takes_seconds(part):
    began = time.process_time()
    H.extract(part * (1_000_000 // len(part)) + "</x>" * 1000 + "</div></span>" * 1000)
    assert time.process_time() - began < 10


WORDS = "sun rain road tree house river".split()


def site(host, n, article, seed):
    rng = random.Random(seed)
    word = lambda k: " ".join(rng.choice(WORDS) for _ in range(k))
    for _ in range(n):
        blocks = [word(rng.randrange(4, 40)) for _ in range(rng.randrange(1, 9))]
        body = "".join(f"<p>{b}</p>" for b in blocks)
        yield (
            f"https://{host}/x?{rng.random()}",
            f"<html><body><div class=top>Welcome to us</div><div class='{article}'>{body}</div>"
            f"<div class=low>Read on</div></body></html>",
            "\n".join(blocks),
        )


def test_article_is_found_where_no_element_names_it(spark):
    pages = [*site("a.example", 40, "c17", 1), *site("b.example", 25, "zz", 2), *site("c.example", 2, "q", 3)]
    data = [(i, u, p, "x", "y") for i, (u, p, _) in enumerate(pages)]
    data += [(100, None, None, "", ""), (101, "no host", "<p>x</p>", "", ""), (0, data[0][1], data[0][2], "", "")]
    frame = spark.createDataFrame(data, "page_id long, url string, html string, host string, text string")
    want = [(i, u, t) for i, (u, _, t) in enumerate(pages)]
    want += [(100, None, ""), (101, "no host", "x"), (0, pages[0][0], pages[0][2])]
    got = rows(H.main_text(frame.repartition(3)))
    assert got == sorted(want, key=repr)
    assert H.main_text(frame.limit(0)).count() == 0


def test_template_is_a_tree_in_order(spark):
    pages = [
        f"<body><div class=top><b>Us</b><p>All news</p></div><main><p>{' '.join(f'w{i}x{k}' for k in range(9))}</p>"
        f"<p>Read on</p></main><div class=low>Bye</div></body>"
        for i in range(20)
    ]
    frame = spark.createDataFrame([("h", p) for p in pages], "host string, page string")
    tokens = {t.hash: t for t in H.parse(pages[0])}
    name = {h: t.text or f"<{i}>" for i, (h, t) in enumerate(tokens.items())} | {0: "-"}
    found = {name[r.token]: (name[r.slot], name[r.before]) for r in H.templates(frame).collect()}
    # One class, in one order; the article's own text is no part of it.
    order = [name[h] for h in tokens if not name[h].startswith("w0x")]
    assert found == {t: ("-", p) for t, p in zip(order, ["-", *order], strict=False)}


def test_smaller_classes_nest_in_slots(spark):
    def page(i):
        video = "<div class=player>Watch it<i></i> now<div class=inner>Full screen</div></div>" if i % 3 == 0 else ""
        return f"<body><div class=a>Top</div><p>own text {i} of it</p>{video}<div class=b>End</div></body>"

    frame = spark.createDataFrame([("h", page(i)) for i in range(30)], "host string, page string")
    tokens = list(H.parse(page(0)))
    at = {t.text or f"<{k}>": t.hash for k, t in enumerate(tokens)}
    found = {r.token: (r.slot, r.before) for r in H.templates(frame).collect()}
    paragraph = tokens[3].hash  # the last token of all pages before the video
    player = next(t.hash for t in tokens if t.text is None and t.within == tokens[0].hash and t.hash not in
                  {x.hash for x in H.parse(page(1))})
    assert found[player] == (paragraph, 0)
    assert found[at["Watch it now"]] == (paragraph, player)
    assert found[at["End"]][0] == 0
    got = H.main_text(spark.createDataFrame([(i, "http://h/", page(i)) for i in range(30)], "page_id long, url string, html string"))
    assert {r.page_id: r.text for r in got.collect()} == {i: f"own text {i} of it" for i in range(30)}


def texts(spark, pages):
    data = [(i, f"https://one.example/{i}", p) for i, p in enumerate(pages)]
    found = H.main_text(spark.createDataFrame(data, "page_id long, url string, html string"))
    return {r.page_id: r.text for r in found.collect()}


def test_pages_of_equal_text_count_once(spark):
    page = "<html><body><main><h1>Title</h1><p>One</p><p>Two</p></main></body></html>"
    data = [(i, f"https://copies.example/{i}", page) for i in range(14)]
    data += [(20 + i, f"https://tracked.example/{i}", f"{page}<script>{i}</script>") for i in range(14)]
    found = H.main_text(spark.createDataFrame(data, "page_id long, url string, html string"))
    assert {r.text for r in found.collect()} == {"Title\nOne\nTwo"}


def test_fixed_text_goes_whatever_its_share(spark):
    fixed = "".join(f"<p>Paragraph {k} of the terms that every page repeats</p>" for k in range(12))
    got = texts(spark, [f"<body><div>{fixed}<p>own sentence {i}</p></div></body>" for i in range(30)])
    assert got == {i: f"own sentence {i}" for i in range(30)}
    # Also where a page has nothing else.
    got = texts(spark, [f"<body><div>{fixed}<p>{f'own {i}' if i else ''}</p></div></body>" for i in range(30)])
    assert got[0] == "" and got[7] == "own 7"


def test_changed_copies_of_an_article_are_no_template(spark):
    body = "".join(f"<p>Paragraph {k} of the copied story, of some length</p>" for k in range(9))
    pages = [f"<article>{body.replace(f'Paragraph {i % 9} ', f'Changed {i} ')}</article>" for i in range(36)]
    assert texts(spark, pages)[1].count("copied story") == 9
    # A group of copies on a host of other pages has no support.
    word = lambda i: " ".join(f"w{i}x{k}" for k in range(30))
    pages = [f"<article><p>{word(i)}</p></article>" for i in range(40)]
    pages += [f"<article>{body}<p>version {i}</p></article>" for i in range(12)]
    got = texts(spark, pages)
    assert got[3] == word(3) and got[45].count("copied story") == 9


def test_names_that_say_as_a_whole_what_is_apart():
    for name in ("ad", "ads-top", "cookie-notice", "cookieNotice", "ad-300x250"):
        assert (H.named_apart(name) == "foreign") == (name != "ad-300x250")
    for name in ("privacy-notice", "cookiebar", "google-ads", "newsletter-signup", "banner-ad"):
        assert H.named_apart(name) == "foreign"
    for name in ("comments", "comment-list", "post-comments", "CommentBody", "comment-12", "commentlist", "disqus_thread"):
        assert H.named_apart(name) == "comment"
    for name in ("copyright", "navbar-toggle", "popular-posts", "sidebarwrap"):
        assert H.named_apart(name) == "layout"
    for name in ("adlink", "commenter-of-the-year", "headerless", "noticed"):
        assert H.named_apart(name) is None
    for name in ("sidebar", "sidebar-left", "site-footer", "main_menu", "related-posts"):
        assert H.named_apart(name) == "layout"
    for name in ("has-sidebar", "no-ads", "comments-open", "content-sidebar-wrap", "social-policy", "wrap-social",
                 "notice-of-death", "nav-open", "post", "adrift", "", "12", "page-content"):
        assert H.named_apart(name) is None


def test_elements_that_are_named_otherwise_stay():
    for open_, close in (
        ("<div class='content-sidebar-wrap'>", "</div>"),
        ("<div id='page' class='has-sidebar'><article>", "</article></div>"),
        ("<article class='post comments-open'>", "</article>"),
        ("<section class='social-policy'>", "</section>"),
        ("<div class='sidebar'><main>", "</main></div>"),
        ("<div class='menu'><div class='header'><h1>A head</h1>", "</div></div>"),
    ):
        page = f"<body>{open_}<p>A story of some length</p><div class='sidebar'>not this</div>{close}</body>"
        assert H.extract(page).removeprefix("A head\n") == "A story of some length"
    page = "<body><h1>A head of some length</h1><p>And a story</p><p class='notice-of-death'>He died</p></body>"
    assert H.extract(page).endswith("He died")
    page = """<html class="no-ads"><body class="has-sidebar nav-open"><div class="sidebar">no</div>
    <main class="no-sidebar"><h2 class="section-header">Yes</h2><table><tr><th class="header">a<td>b</table>
    <p class="notice">no</p></main></body></html>"""
    assert H.extract(page) == "Yes\na\nb"


def test_comments_notices_and_adverts_go_whatever_their_share(spark):
    def page(i, wrap):
        comments = "".join(f"<article class=c>Reader {i} {k} says a lot of things at length</article>" for k in range(8))
        return f"<body>{wrap.format(f'<p>Short story {i}</p>')}<section id='comments'><h1>Comments</h1>{comments}</section></body>"

    for wrap in ("<article>{}</article>", "{}"):
        assert texts(spark, [page(i, wrap) for i in range(30)]) == {i: f"Short story {i}" for i in range(30)}
    assert H.extract("<body><div class='cookie-notice'>We use cookies</div></body>") == ""
    assert H.extract("<body>" + "<div class='promo'>one of three</div>" * 3 + "</body>") == ""
    page = "<article>One <span class='ad'>buy <span>this</span> <b>now</b></span> two<p><a class=ad>x<div>y</div></a>z</article>"
    assert H.extract(page) == "One two\nz"
    assert H.extract("<p>See <a class='related'>this</a> <code class='comment'># that</code></p>") == "See this # that"


def test_fixed_text_is_judged_by_the_pages_of_its_container(spark):
    word = lambda i: " ".join(f"w{i}x{k}" for k in range(30))
    page = lambda i, more="": f"<body><div class=box><p>{word(i)}</p><p>Call us now</p>{more}</div></body>"
    for n in (4, 40):
        # Pages that are null, empty or built otherwise, and one that prints the text twice.
        pages = [page(i, "<p>Call us now</p>" if i == 1 else "") for i in range(n)]
        odd = [None, "", f"<body><div class=other>{word(n)}</div></body>"]
        got = texts(spark, [*pages, *odd])
        assert [got[i] for i in range(n)] == [word(i) for i in range(n)]
        assert [got[n + k] for k in range(3)] == ["", "", word(n)]
    same = texts(spark, [page(i) for i in range(12)] * 2)
    assert same[3] == word(3)
    tables = [f"<table><tr><td>{word(i)}{'<tr><td>yes' * (1 + i % 9)}</table>" for i in range(18)]
    assert texts(spark, tables)[4].count("yes") == 5


def test_all_slots_are_text(spark):
    word = lambda i: " ".join(f"w{i}x{k}" for k in range(30))
    both = [
        f"<body><article class=featured>{word(i)} more</article><article class=regular>{word(100 + i)}</article></body>"
        for i in range(12)
    ]
    got = texts(spark, both)
    assert got == {i: f"{word(i)} more\n{word(100 + i)}" for i in range(12)}
    pages = [f"<body><main><p>{word(i)}</p></main></body>" for i in range(12)]
    pages += [f"<body><main>teaser {i}</main><div class=story>{word(50 + i)}</div></body>" for i in range(3)]
    assert texts(spark, pages)[13] == f"teaser 1\n{word(51)}"


class Blocks(HTMLParser):
    """A reference reader: the blocks of a page whose text is not marked as foreign in its data."""

    def __init__(self):
        super().__init__()
        self.out, self.words, self.skip = [], [], 0

    def handle_starttag(self, tag, attrs):
        self.cut()
        names = dict(attrs)
        if self.skip or tag in ("nav", "footer", "aside", "script") or names.get("class") in ("ad", "comments"):
            self.skip += 1

    def handle_endtag(self, tag):
        self.cut()
        self.skip -= bool(self.skip)

    def handle_data(self, data):
        if not self.skip:
            self.words.append(data)

    def cut(self):
        text = " ".join("".join(self.words).split())
        self.words.clear()
        if text:
            self.out.append(text)


def test_generated_hosts_against_brute_force(spark):
    """Segments at one place that all pages of a layout have are template; all others are text."""
    rng = random.Random(11)
    data, want = [], {}
    for h in range(6):
        n, fixed = rng.randrange(12, 40), [f"Fixed {h} {k}" for k in range(rng.randrange(1, 6))]
        slots = [rng.choice(["p", "section", "div"]) for _ in fixed]
        pages = []
        for i in range(n):
            parts = [f"<{s}>{f}</{s}>" for s, f in zip(slots, fixed, strict=True)]
            body = [f"<p>{h}x{i}x{k} {rng.choice(WORDS)} it &amp; on</p>" for k in range(rng.randrange(1, 8))]
            extra = [
                f"<nav><ul><li>{rng.choice(WORDS)}</li></ul></nav>", f"<div class='ad'>{i} buy</div>",
                f"<div class='comments'><p>{'long ' * 60}{i}</p></div>", f"<footer>{i}</footer>", "<script>1<2</script>",
            ]
            rng.shuffle(extra)
            half = len(parts) // 2
            html = f"<html><body>{extra[0]}{''.join(parts[:half])}<article>{''.join(body)}</article>{extra[1]}{''.join(parts[half:])}{''.join(extra[2:])}</body></html>"
            pages.append(html)
        seen = defaultdict(int)
        read = []
        for html in pages:
            reader = Blocks()
            reader.feed(html)
            reader.cut()
            read.append(reader.out)
            for t in set(reader.out):
                seen[t] += 1
        for i, (html, out) in enumerate(zip(pages, read, strict=True)):
            data.append((h * 100 + i, f"https://h{h}.example/{i}", html))
            want[h * 100 + i] = "\n".join(t for t in out if seen[t] < n)
    found = H.main_text(spark.createDataFrame(data, "page_id long, url string, html string").repartition(5))
    got = {r.page_id: r.text for r in found.collect()}
    assert got == want
