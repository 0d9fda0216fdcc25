import pytest

from lakeops.llm import extraction as x

STORY = "It is the story of a man and of his dog in the old town by the sea, and it was long."

CASES = [
    (None, ""), ("", ""), ("   ", ""), ("a < b &amp; c", "a < b & c"),
    (f"<article><h1>Title</h1><p>{STORY}<p>Les.</p></article><footer>&copy; x</footer>", f"Title\n{STORY}\nLes."),
    (f"<nav><ul><li><a href=a>Home</a></li></ul></nav><div class='ad'>{STORY}</div><article><p>{STORY}</p></article>", STORY),
    (f"<body><div id=cookie-notice>{STORY}</div><p>{STORY}</p><section class='userComments'><p>{STORY}</p></section>", STORY),
    (f"<article><p>{STORY}</p><aside>{STORY}</aside><form>the name of it <input></form><p>ok</p></article>", f"{STORY}\nok"),
    ("<p>x<script>var a='</p>'</script>y</p><style>p{}</style><!-- z", "xy"),
    (f"<article><p>{STORY}</p><ul><li>one</li><li>two</li></ul></article>", f"{STORY}\none\ntwo"),
    ("<article><p>a  b\n\tc<br>d &lt;i&gt;</p></article>", "a b c d <i>"),
    (f"<p>{STORY}</p><p><a href=x>Only a link to the other side</a></p>", STORY),
    (f"<article><p>{STORY} <span class=advert>the ad of it</span>and on</p></article>", f"{STORY} and on"),
    (f"<article><div hidden>{STORY}</div><p>{STORY}</p>", STORY),
]


@pytest.mark.parametrize("page, text", CASES)
def test_main_text(page, text):
    assert x.main_text(page) == text


LONG_STORY = f"{STORY} {STORY}"
LINKS = "<a href=x>Ten things to see</a> <a href=y>Nine more of them here</a>"


@pytest.mark.parametrize("page, text", [
    # the text in a plain div, teasers in articles
    (f"<div><h1>Title</h1><p>{LONG_STORY}</p><p>Short.</p><p>{LONG_STORY}</p></div><article><a href=x>Next</a></article>",
     f"Title\n{LONG_STORY}\nShort.\n{LONG_STORY}"),
    # link lists in an article, also what stands between them; a linked title stays
    (f"<article><h1><a href=x>Title</a></h1><p>{STORY}</p><p>{LINKS}</p><p>See also</p><p>{LINKS}</p></article>",
     f"Title\n{STORY}"),
    # short text beside an article, and texts without stop words in it
    (f"<article><p>{'Zeile ' * 40}</p></article><div>Copyright of x</div>", ("Zeile " * 40).strip()),
])
def test_both_passes_run_inside_and_outside_of_regions(page, text):
    assert x.main_text(page) == text


@pytest.mark.parametrize("page, text", [
    (f"<html class='has-footer'><body class='no-sidebar'><div class='content-with-sidebar'><p>{STORY}", STORY),
    (f"<article class='post comments-open'><p>{STORY}</p></article>", STORY),
    (f"<body style='display: none'><main id=search><p>{STORY}</p></main></body>", STORY),
    (f"<div class='overflow-hidden'>{STORY}</div><p class='share-price'>{STORY}</p>", f"{STORY}\n{STORY}"),
    (f"<div data-id='ad' title='class=ad hidden'>{STORY}</div>", STORY),
    (f"<div class='share-price'><p>{LONG_STORY}</p><p>Les.</p></div>", LONG_STORY),     # the text overrules the name
    (f"<p>{STORY}</p><div class='site-footer'>{STORY}</div><div class='hidden'>{STORY}</div>", STORY),
    (f"<p>{STORY}</p><div aria-hidden=true>{LONG_STORY}</div><div style='x:y;display:none'>{LONG_STORY}</div>", STORY),
])
def test_names_of_boilerplate(page, text):
    assert x.main_text(page) == text


@pytest.mark.parametrize("page, text", [
    (f"<a name=top><p>{STORY}</p><div>{STORY}</div>", f"{STORY}\n{STORY}"),
    (f"<a id=x/><p>{STORY}</p>", STORY),
    (f"<div><a href=x>One</div><p>{STORY}</p>", STORY),               # closed with the element around
    (f"<p>{STORY} <a href=x>One<p>{STORY}</p>", f"{STORY} One\n{STORY}"),
    (f"<ul><li><a href=x>One<li>{STORY}</ul><p>{STORY}</p>", f"{STORY}\n{STORY}"),
    (f"<p>{STORY}</p><a href=x><div><p>Ten things</p><p>{STORY}</p></div></a><p>{STORY}</p>", f"{STORY}\n{STORY}"),
    (f"<head><title>x</title><p>{STORY}</p><p>{STORY}</p>", f"{STORY}\n{STORY}"),
    (f"<head><meta x><link y><script>z</script>\n{STORY}", STORY),
    (f"<head><title>x</title></head><body><p>{STORY}</p>", STORY),
])
def test_links_and_heads_end(page, text):
    assert x.main_text(page) == text


def test_second_pass_takes_the_nearest_label():
    assert x.resolve([1, None, 1], [0] * 3, [False] * 3) == [1, 1, 1]
    assert x.resolve([0, None, 0], [0] * 3, [False] * 3) == [0, 0, 0]
    assert x.resolve([1, None, None, 0], [0] * 4, [False] * 4) == [1, 1, 0, 0]
    assert x.resolve([1, None, 0], [0] * 3, [False] * 3) == [1, 1, 0]
    assert x.resolve([0, None], [0, 1], [False] * 2) == [0, 1]
    assert x.resolve([None, None], [0, 0], [True, False]) == [0, 1]


def test_long_pages_stay_whole():
    page = "<article>" + "".join(f"<p>{STORY} {i}</p>" for i in range(5000)) + "</article>"
    assert x.main_text(page).count("\n") == 4999
    assert x.main_text("<div>" * 20000 + "x" + "</div>" * 20000) == "x"


def test_job(spark):
    rows = [(k, None if k % 3 else f"u{k}", p, "clash") for k, (p, _) in enumerate(CASES)]
    rows += [(None, "n", CASES[4][0], "clash"), (3, "again", CASES[4][0], "clash")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in x.extracted(df).collect()}
    for k, (_, text) in enumerate(CASES):
        assert got[(k, rows[k][1])] == (text, len(text))
    assert got[(None, "n")][0] == got[(3, "again")][0] == CASES[4][1]
    assert x.extracted(df.limit(0)).count() == 0


# ---------------------------------------------------------------- boilerplate that is long prose

PROSE = " ".join([STORY] * 4)


@pytest.mark.parametrize("junk", [
    "<div class='ad'>{}</div>", "<div class=advertisement><p>{}</p></div>", "<div class=cookie-notice>{}</div>",
    "<div class='box left-sidebar'><p>{}</p></div>", "<div id=comments><p>{}</p><p>{}</p></div>",
    "<section class=comments><div class=c><p>{}</p></div></section>", "<div class=commentList><article><p>{}</p></article></div>",
    "<div id=site-notice>{}</div>", "<ul class=main-menu><li>{}</ul>", "<div role=navigation>{}</div>",
    "<div class=related>{}</div>", "<div class=newsletter-signup>{}</div>", "<div class=popup>{}</div>",
])
def test_long_boilerplate_goes(junk):
    body = f"<article><h1>Title</h1><p>{PROSE}</p><p>{PROSE} And on.</p></article>"
    want = f"Title\n{PROSE}\n{PROSE} And on."
    filled = junk.replace("{}", PROSE)
    assert x.main_text(f"<body>{filled}{body}</body>") == want
    assert x.main_text(f"<body>{body}{filled}</body>") == want
    assert x.main_text(body.replace("</h1>", f"</h1>{filled}")) == want
    assert x.main_text(body.replace("article>", "div>").replace("</h1>", f"</h1>{filled}")) == want


@pytest.mark.parametrize("page", [
    "<body class=no-sidebar><article>{}</article>", "<body><article class=comments-open>{}</article>",
    "<body><div class='page sidebar-layout'><div>{}</div></div>", "<body><div class=menu-open>{}</div>",
    "<body><div class=share>{}</div>", "<body><div id=search-results><p>{}</p></div>",
])
def test_names_of_something_else_stay(page):
    assert x.main_text(page.replace("{}", PROSE)) == PROSE


# ---------------------------------------------------------------- slow pages

@pytest.mark.parametrize("piece", [
    "<a ", '<a x="', "<a x='\">", "</script ", "<script", "<!--", "<![CDATA[", "<!x ", "<a =", "<a x=\">\" ", "< ", "</p ", "&#",
    "<div>", "<section></div>", "<ul><li>", "<a href=x>", "<p class='a b'>", "&#9", "a" * 60, "\n ",
])
def test_time_follows_length(piece):
    import time
    for lead in ("", f"<section><p>{STORY}</p></section>", "<script>", '<a x="'):
        page = lead + piece * (1_000_000 // len(piece))
        began = time.perf_counter()
        x.main_text(page)
        x.main_text(page + ">")
        assert time.perf_counter() - began < 4       # two pages of 1 MB


def test_nested_under_a_closed_element():
    import time
    began = time.perf_counter()
    x.main_text("<section></section>" + "<div>" * 100_000 + "</section>" * 60_000)
    assert time.perf_counter() - began < 2


def test_numbers_beyond_unicode():
    assert x.main_text("<p>a&#" + "9" * 6000 + ";b&#" + "0" * 6000 + "65;&#x" + "f" * 5000 + ";&#x" + "0" * 50 + "41;</p>") \
        == "a�bA�A"


# ---------------------------------------------------------------- against a tree

class Tree:
    """A slow reference for well-formed pages: the standard parser's events
    as a tree, and by the contract's words the article without what is no part
    of it."""

    def __init__(self, page):
        from html.parser import HTMLParser
        self.root = ["root", {}, []]
        path = [self.root]
        outer = self

        class Events(HTMLParser):
            def handle_starttag(self, tag, attrs):
                if tag in ("p", "div", "section", "h2", "article", "ul") and path[-1][0] == "p":
                    path.pop()
                if tag == "br":
                    path[-1][2].append(" ")
                elif tag not in x.VOID_TAGS:
                    node = [tag, {k: v or "" for k, v in attrs}, []]
                    path[-1][2].append(node)
                    path.append(node)

            def handle_endtag(self, tag):
                if tag in [n[0] for n in path]:
                    while path.pop()[0] != tag:
                        pass

            def handle_data(self, data):
                path[-1][2].append(data)

        e = Events(convert_charrefs=True)
        e.feed(page)
        e.close()
        outer.lines, outer.line = [], []

    JUNK = {"nav", "footer", "aside", "form", "script", "style", "head", "title", "header"}
    NAMES = {"ad", "comments", "cookie-notice", "left-sidebar", "sidebar", "menu"}

    def text(self):
        def end():
            t = " ".join("".join(self.line).split())
            self.line.clear()
            if t:
                self.lines.append(t)

        def walk(node, inside):
            tag, attrs, children = node
            if tag in self.JUNK or {*attrs.get("class", "").split(), attrs.get("id")} & self.NAMES:
                return
            inside = inside or tag == "article"
            block = tag in x.BLOCK_TAGS
            if block:
                end()
            for c in children:
                if isinstance(c, str):
                    if inside:
                        self.line.append(c)
                else:
                    if c[0] in x.BLOCK_TAGS:
                        end()
                    walk(c, inside)
            if block:
                end()

        import sys
        limit = sys.getrecursionlimit()
        sys.setrecursionlimit(100_000)
        try:
            walk(self.root, False)
        finally:
            sys.setrecursionlimit(limit)
        end()
        return "\n".join(self.lines)


def supplied_pages():
    import pyarrow.parquet as pq
    return pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"]).column("html").to_pylist()


def test_supplied_pages_equal_the_tree():
    for page in supplied_pages():
        assert x.main_text(page) == Tree(page or "").text()


def test_mutated_pages_equal_the_tree():
    import random
    import re
    rng = random.Random(5)
    pages = [p for p in supplied_pages() if p]
    junk = ["<div class='ad'>{}</div>", "<div class=\"x cookie-notice\">{}</div>", "<aside><p>{}</p></aside>",
            "<section id=comments><p>{}</p><p>{}</p></section>", "<div class=left-sidebar>{}</div>",
            "<form><p>{}</p></form>", "<!-- <article>{}</article> -->", "<script>x='<p>{}</p>'</script>"]
    for _ in range(200):
        page = rng.choice(pages)
        for _ in range(rng.randrange(1, 6)):
            at = rng.choice([m.end() for m in re.finditer(r"</p>|<article>|</nav>|</article>", page)
                             if m.start() >= page.index("</nav>")])
            kind = rng.randrange(5)
            if kind < 3:
                page = page[:at] + rng.choice(junk).replace("{}", PROSE) + page[at:]
            elif kind == 3 and page.index("<h1>") < at < page.rindex("</article>"):
                page = page[:at] + rng.choice(["\n\t ", "<p title='a > b'>" + PROSE + "</p>", f"<div><p>{PROSE}</p></div>"]) + page[at:]
            else:
                page = page.replace("<p>", rng.choice(["<P>", "<p class=lead>", "<p\n id='p1'>"]), rng.randrange(9))
        assert x.main_text(page) == Tree(page).text()
