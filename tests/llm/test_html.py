"""Main text of generated sites against what was put in, odd markup, and the pages of the tables."""

import html
import random
import re

import pyarrow.parquet as pq
import pytest

from ledgerhub.llm import html as extraction
from ledgerhub.llm.queries import QUERIES


def sentence(rng, n=12):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(n)) + "."


def site(rng, kind, pages=20):
    """(html, main text) of pages of one site with all that is not the article around it."""
    out = []
    for i in range(pages):
        title, blocks = sentence(rng, 6), [sentence(rng, rng.randrange(5, 60)) for _ in range(rng.randrange(2, 9))]
        body = f"<h1>{title}</h1>" + "".join(f"<p>{b}</p>\n" for b in blocks)
        body = body.replace(" ", " <b>x &amp; y</b>z ", 1)
        main = html.unescape(" ".join(re.sub(r"<[^>]+>", " ", re.sub("</?b>", "", body)).split()))
        links = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in sentence(rng, 7).split())
        around = (
            f"<header><a href='/'>Site</a> {sentence(rng, 3)}</header><nav><ul>{links}</ul></nav>"
            f'<div class="cookie-notice">We use cookies {sentence(rng, 4)}</div><div id="ad-{i}">{sentence(rng, 9)}</div>'
            f"<aside>{sentence(rng, 25)}</aside><form><label>Mail</label><input><button>Go</button></form>",
            f"<section class='comments'><h2>Comments</h2><article class='comment'>{sentence(rng, 40)}</article></section>"
            f"<div class=sidebar><p>{sentence(rng, 30)}</div><footer>&copy; {sentence(rng, 5)}</footer>")
        share = "<p>Follow us on every network</p>"
        inner = {"article": f"<main><article>{body}{share}</article></main>", "div": f'<div id="content">{body}{share}</div>'}[kind]
        out.append((
            f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var a='</p><p>no</p>';</script>"
            f"</head><body>{around[0]}<!-- <p>not this</p> -->{inner}{around[1]}</body></html>", main))
    return out


@pytest.mark.parametrize("kind", ["article", "div"])
def test_sites(kind):
    pages = site(random.Random(1), kind)
    got = extraction.extracted([p for p, _ in pages], True)
    assert got == [m for _, m in pages]


def test_template_text_is_found_by_its_class():
    pages = [extraction.parsed(p) for p, _ in site(random.Random(2), "div")]
    template = extraction.deduced(pages)
    words = {t[1] for t in template.held if not t[1].startswith("<")}
    assert {"Follow", "network", "cookies"} <= words
    assert extraction.deduced(pages[:extraction.MIN_PAGES - 1]) is None
    assert extraction.container(pages, template)[-1] == "div content"


def test_copies_keep_their_text():
    pages = site(random.Random(3), "article", 3)
    sources = [pages[0][0]] * 30 + [p for p, _ in pages]
    assert set(extraction.extracted(sources, True)[:30]) == {pages[0][1] + " Follow us on every network"}
    near = [pages[0][0].replace("</h1>", f" {i}</h1>") for i in range(20)]
    assert all(len(x) > 0.9 * len(pages[0][1]) for x in extraction.extracted(near, True))


ODD = [
    ("", ""), ("   ", ""), ("plain text  only", "plain text only"), ("<p>a<br>b", "a b"), ("<p>a<b>b</b>c</p>", "abc"),
    ("<p>a < b & c &lt;d&gt; &#233;&eacute; &amp;amp;</p>", "a < b & c <d> éé &amp;"), ("<article>x", "x"),
    ("<body><nav>no</nav>yes<nav>no", "yes"), ("<p title='>'>q</p><a href=\"x>y", "q y"), ("</div></p>ok", "ok"),
    ("<script>never ends <p>x</p>", ""), ("<!-- never ends <p>x</p>", ""), ("<P>Upper</P><SCRIPT>no</SCRIPT>", "Upper"),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a b c d"), ("a&nbsp;&nbsp;b", "a b"),
    ("<head><title>t</title><body>text", "text"), ("<div hidden>no</div>yes", "yes"), ("<b>" * 3000 + "deep", "deep"),
]


@pytest.mark.parametrize("source,text", ODD)
def test_odd_markup(source, text):
    assert extraction.extracted([source], False) == [text]


def test_frames(spark):
    rows = [(1, "http://a.b/x", "<p>one</p>"), (1, "http://a.b/x", "<p>one</p>"), (2, None, None), (None, "not a url", "<p>x"),
            (4, "https://U:p@A.B:80/?q#f", ""), (5, "http://a.b", "<article>" + "long words " * 50000 + "</article>")]
    df = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, host int")
    got = extraction.with_length(extraction.main_text(df)).collect()
    assert sorted((str(r["page_id"]), r["n_chars"]) for r in got) == [
        ("1", 3), ("1", 3), ("2", 0), ("4", 0), ("5", 549999), ("None", 1)]
    assert {(str(r["page_id"]), r["url"]) for r in got} == {(str(r[0]), r[1]) for r in rows}
    assert {r["text"] for r in got if r["page_id"] == 1} == {"one"}
    assert extraction.main_text(df.limit(0)).count() == 0
    hosts = [r[0] for r in df.select(extraction.host(df["url"])).collect()]
    assert hosts == ["a.b", "a.b", "", "", "a.b", "a.b"]


def wanted(source):
    inner = re.search(r"<article>(.*?)</article>", source, re.S)[1]
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inner))).split())


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_query(spark, folder):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = QUERIES["op8_html"](spark, folder).collect()
    assert len(got) == len(pages)
    for r in got:
        own = pages[r["page_id"]]
        assert (r["url"], r["text"], r["n_chars"]) == (own["url"], wanted(own["html"]), len(wanted(own["html"])))


WRAPPERS = [
    ("<form id=aspnetForm>", "</form>"), ("<div class='layout has-sidebar'>", "</div>"), ("<div id=page class='search'>", "</div>"),
    ("<form><div role=search>", "</div></form>"),
]


def wrapped(source, kind, opened, closed):
    """The page with an element of that name around all of its body, or in place of the article's own."""
    if kind == "article":
        return source.replace("<main><article>", "<main><article class='post no-comments'>")
    return source.replace("<body>", "<body>" + opened, 1).replace("</body>", closed + "</body>")


@pytest.mark.parametrize("opened,closed", WRAPPERS)
@pytest.mark.parametrize("kind", ["article", "div"])
def test_names_do_not_judge_what_is_around_the_article(kind, opened, closed):
    pages = site(random.Random(4), kind)
    sources = [wrapped(p, "div", opened, closed) for p, _ in pages]
    assert extraction.extracted(sources, True) == [m for _, m in pages]
    alone = [extraction.extracted([s], False)[0] for s in sources]
    assert alone == [extraction.extracted([p], False)[0] for p, _ in pages] and all(m in a for (_, m), a in zip(pages, alone))


def test_names_do_not_judge_the_article_itself():
    pages = site(random.Random(5), "article")
    sources = [wrapped(p, "article", "", "") for p, _ in pages]
    assert extraction.extracted(sources, True) == [m for _, m in pages]
    assert [extraction.extracted([s], False)[0] for s in sources] == [m + " Follow us on every network" for _, m in pages]


def test_a_few_wrapped_pages_among_others():
    pages = site(random.Random(6), "div")
    sources = [wrapped(p, "div", *WRAPPERS[0]) if i % 7 == 0 else p for i, (p, _) in enumerate(pages)]
    assert all(m in got for got, (_, m) in zip(extraction.extracted(sources, True), pages))


def test_long_comments_do_not_replace_the_article():
    pages = [(p.replace("</h2>", "</h2><p>" + "so true " * 300 + f"{i}</p>"), m) for i, (p, m) in enumerate(site(random.Random(7), "article"))]
    assert extraction.extracted([p for p, _ in pages], True) == [m for _, m in pages]


@pytest.mark.parametrize("source,text", [
    ("<form id=f><h1>a</h1><header>no</header><nav>no</nav><p>b</p></form>", "a b"), ("<nav>no</nav><div class=search>all</div>", "all"),
    ("<article class='no-comments'><header>a</header>b<div class=share>no</div></article>", "a b"), ("<nav>no</nav>", ""),
    ("<main>text of the page</main><form>" + "label " * 20 + "</form>", "text of the page"),
])
def test_names_around_single_pages(source, text):
    assert extraction.extracted([source], False) == [text]


NAMED = ['<section id="discussion">', '<p class="share-price">', '<div class="alert-info">', '<p id="hidden-cost">',
         '<p class="search-results-explained">', '<div class="social-history menu-costs">']


@pytest.mark.parametrize("kind", ["article", "div"])
def test_words_in_names_leave_nothing_out_inside_the_article(kind):
    """Elements of these names are text of the article; whole names of adverts and comments are not."""
    rng = random.Random(8)
    sources, texts = [], []
    for page, main in site(rng, kind):
        more = [(opened, sentence(rng, 8)) for opened in NAMED]
        extra = "".join(f"{o}{t}</{o[1:].split()[0]}>" for o, t in more)
        out = f"<div class='ad'>{sentence(rng, 9)}</div><div class='post comments'>{sentence(rng, 9)}</div><div id=comment-list>{sentence(rng, 9)}</div>"
        sources.append(page.replace("<p>Follow us", extra + out + "<p>Follow us"))
        texts.append(" ".join([main, *[t for _, t in more]]))
    assert extraction.extracted(sources, True) == texts
    if kind == "article":
        assert [extraction.extracted([s], False)[0] for s in sources] == [t + " Follow us on every network" for t in texts]


def nameless(source):
    """The page with a plain div for every element that says what it is, and no class, id or role."""
    source = re.sub(r"<(/?)(?:article|nav|aside|footer|header|main|section|form)\b", r"<\1div", source, flags=re.I)
    return re.sub(r"<(div|ul|li|p)\b[^>]*>", r"<\1>", source, flags=re.I)


def hosts_pages():
    hosts = {}
    for r in pq.read_table("/root/testdata/sf0.1/pages.parquet", columns=["url", "html"]).to_pylist():
        hosts.setdefault(r["url"].split("/")[2], []).append(r["html"])
    return hosts


def test_slots_alone_find_the_article():
    """Without any name the template's slots give the same texts on every page, and nothing else does."""
    hosts, with_template = hosts_pages(), 0
    for sources in hosts.values():
        plain = [nameless(s) for s in sources]
        different = {extraction.largest_text(p): p for p in map(extraction.parsed, plain)}
        if extraction.deduced(list(different.values())) is not None:
            with_template += len(sources)
            assert extraction.extracted(plain, True) == [wanted(s) for s in sources]
    assert with_template >= 0.9 * sum(map(len, hosts.values()))


def test_without_a_template_nameless_pages_keep_their_menus(monkeypatch):
    sources = next(iter(hosts_pages().values()))
    monkeypatch.setattr(extraction, "deduced", lambda pages: None)
    got = extraction.extracted([nameless(s) for s in sources], True)
    assert not any(text == wanted(s) for text, s in zip(got, sources))


def boxes(rng, counts):
    out = []
    for n in counts:
        text = [sentence(rng, 40) for _ in range(3)]
        more = "".join(f"<div>{sentence(rng, 4)}</div>" for _ in range(n))
        out.append((f"<body><div><div>{sentence(rng, 5)}</div><div><h1>{text[0]}</h1><p>{text[1]}</p><p>{text[2]}</p></div>"
                    f"{more}</div></body>", " ".join(text)))
    return out


def test_places_tell_siblings_apart_only_where_all_pages_have_as_many():
    pages = boxes(random.Random(9), [2] * 20)
    assert extraction.extracted([p for p, _ in pages], True) == [m for _, m in pages]
    uneven = boxes(random.Random(9), [2, 3] * 10)
    got = extraction.extracted([p for p, _ in uneven], True)
    assert all(m in text and text != m for text, (_, m) in zip(got, uneven))


def test_a_part_of_the_article_beside_its_heading_stays():
    rng = random.Random(10)
    parts = [[sentence(rng, 30) for _ in range(3)] for _ in range(20)]
    sources = [f"<body><div><h1>{a}</h1>{b}</div><div>{c}</div></body>" for a, b, c in parts]
    assert extraction.extracted(sources, True) == [" ".join(p) for p in parts]


def test_equal_rows_are_one_row_in_their_cohort(spark):
    """Half of a host is one repeated row: read once, returned as often as it came, and others are not changed."""
    pages = site(random.Random(11), "article")
    rows = [(i, "http://a.b/x", p) for i, (p, _) in enumerate(pages)]
    df = spark.createDataFrame(rows + [rows[0]] * 500 + [(None, None, None)] * 3, "page_id long, url string, html string")
    kept = extraction.once_each(df)
    assert kept.count() == len(rows) + 1 and kept.groupBy().sum("copies").first()[0] == df.count()
    got = sorted(map(tuple, extraction.main_text(df).collect()), key=str)
    wanted_rows = [(i, "http://a.b/x", m) for i, (_, m) in enumerate(pages)]
    assert got == sorted(wanted_rows + [wanted_rows[0]] * 500 + [(None, None, "")] * 3, key=str)
