"""Main text of pages by deducing the template that pages of one host share.

Pages of a host are dealt into cohorts of bounded size. A page is a sequence of tokens, tags and
words, told apart by the chain of elements around them. Tokens with the same occurrence vector, the
count on each page of the cohort, form an equivalence class. The class of tokens found once on
every page in the same order is the template's root; other large and frequent classes are valid if
each lies in one slot of the root on all pages, and nest there. What the template does not
hold are the slots. The element of the template that holds the article is the one with most slot
text; what tags, roles and class names beside it call a menu, advert, form, comment and so on is left
out, inside it only what tags, roles or whole names (``INNER_NAMES``) call so. They don't judge the
article's element itself nor those around it: a form, class, id or role that would leave out most slot
text is the page's wrapper and is passed over.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerhub.llm.common import with_new, written_once
from ledgerhub.sizing import broadcast_within

COHORT_PAGES = 64
#: A template is deduced from this many pages with different texts at least.
MIN_PAGES = 8
#: A class has two tokens at least, on half of the pages at least.
MIN_CLASS, MIN_SUPPORT = 2, 0.5
#: A page of which the template would take more than this share of the article keeps it whole.
MAX_TEMPLATE_SHARE = 0.3
#: How many times the slot text outside it an element that names leave out must hold to be the article's, by
#: whether it and the text outside have a first-level heading or an article element.
WRAPPER_SHARE = {(True, False): 1, (True, True): 4, (False, False): 4, (False, True): 20}

#: Elements by what HTML says they are.
RAW = ("script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "xmp", "noembed", "noframes")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr output progress q "
    "rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
LEFT_OUT = frozenset(
    "head nav footer aside form menu dialog button select option optgroup datalist fieldset object canvas audio "
    "video map applet frameset".split())
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Of these, what can be around a whole page; the others never hold an article.
WRAPPERS = frozenset("form fieldset object dialog frameset".split())
WRAPPER_ROLES = frozenset("search form dialog alert alertdialog".split())
CONTAINERS = frozenset(["article", "main"])
NAMELESS = ("div", "section")
#: Words in class names and ids of what is not the article.
LEFT_OUT_NAMES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie "
    "cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup sidebar "
    "sidebars aside widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead topbar "
    "comment comments reply replies respond disqus discussion share sharing social related recommended "
    "recommendations pagination pager toolbar login search hidden".split())
#: Whole class names and ids that are left out inside the article too; there, words in longer names
#: such as share-price don't count.
INNER_NAMES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies "
    "consent newsletter subscribe subscription signup sidebar menu nav navbar navigation breadcrumb breadcrumbs "
    "footer comment comments replies disqus share sharing social related pagination pager toolbar login hidden".split())
_COMMENTS = re.compile(r"comments?[-_](?:area|body|box|container|form|item|list|section|thread|wrapper)")
#: As above, but only outside the article.
OUTER_NAMES = frozenset("header top bottom".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(RAW) + r")\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)>|<[!?/][^>]*+(?:>|\Z)|(?P<text>[^<]++|<)",
    re.DOTALL | re.IGNORECASE)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME = re.compile(r"[A-Za-z]+")
_NAMED = re.compile(r"(?:^|\s)(?:class|id|role|hidden|aria-hidden)\b", re.IGNORECASE)
_DIGITS = re.compile(r"\d+")


@dataclass
class Node:
    """A run of text: the chain of elements around it, its words, and the left-out elements it is in."""

    path: tuple[str, ...]
    text: str
    never: bool  # in an element that holds no article
    owner: int  # of the others that are left out, the place of the innermost in the path; 0 if there is none
    firm: int  # the same, of those that are left out inside the article too
    serial: int  # its number on the page
    nested: bool  # it is in another one
    heading: int  # level
    separate: bool  # a block ended before it

    @property
    def out(self) -> bool:
        return self.never or self.owner > 0

    def inside(self, chain: tuple[str, ...]) -> bool:
        """Does it lie in the article's element, in nothing that is left out there?"""
        return not self.never and self.firm <= len(chain) and self.path[:len(chain)] == chain

    def seen(self, wrapper: tuple[str, ...]) -> bool:
        """Is it kept if the rules pass over the wrapper and the elements around it?"""
        return not self.never and (not self.owner or (
            self.owner <= len(wrapper) and self.path[:self.owner] == wrapper[:self.owner]))


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=list)
    tags: list[tuple[int, tuple[str, ...], str]] = field(default_factory=list)  # (nodes before it, path, tag)


def names_of(value: str) -> set[str]:
    parts = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value)
    return {n.lower() for n in _NAME.findall(parts)}


def element(tag: str, attrs: str, inside: bool) -> tuple[str, bool, bool, bool]:
    """Label of an element (tag, class and id, numbers apart), whether it never holds an article, and is left out
    outside and inside the article."""
    given = {}
    if attrs.strip(" /"):
        for name, *values in _ATTRIBUTE.findall(attrs):
            given.setdefault(name.lower(), html.unescape(next((v for v in values if v), "")))
    label = " ".join(filter(None, (tag, given.get("class", ""), given.get("id", ""))))
    named = given.get("class", "") + " " + given.get("id", "")
    whole = set(named.lower().split())
    role = given.get("role", "").lower()
    top = tag in ("html", "body", "main")
    never = tag in LEFT_OUT - WRAPPERS or role in LEFT_OUT_ROLES - WRAPPER_ROLES
    never = never or (tag == "header" and not inside) or ("hidden" in given and not top)
    firm = tag in WRAPPERS or role in WRAPPER_ROLES or "hidden" in given or given.get("aria-hidden") == "true"
    firm = firm or (not top and (bool(whole & INNER_NAMES) or any(map(_COMMENTS.fullmatch, whole))))
    out = firm
    if not top and not inside:
        words = names_of(named)
        out = out or bool(words & LEFT_OUT_NAMES) or (tag != "article" and bool(words & OUTER_NAMES))
    return _DIGITS.sub("#", label), never, out, firm


def parsed(source: str) -> Page:
    """Text runs and tags of a page. Ends of elements that aren't open are ignored; open ones end with their parent."""
    page = Page()
    stack: list[tuple[str, str, bool, int, int, int, bool]] = []  # tag, label, and never to nested of its text
    path: tuple[str, ...] = ()
    separate, heading, serial = True, 0, 0
    for m in _TOKEN.finditer(source):
        text = m["text"]
        if text is not None:
            within = stack[-1][2:] if stack else (False, 0, 0, 0, False)
            page.nodes.append(Node(path, html.unescape(text) if "&" in text else text, *within, heading, separate))
            separate = False
            continue
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            separate = separate or m["raw"] is not None
            continue
        end, attrs = m["end"] or m["end2"] or "", m["attrs"] or m["attrs2"] or ""
        if tag in INLINE and not (any(t[0] == tag for t in stack) if end else _NAMED.search(attrs)):
            continue
        separate = separate or tag not in INLINE
        if tag in VOID or (tag == "p" and not attrs.strip()):
            page.tags.append((len(page.nodes), path, end + tag))
            continue
        if len(tag) == 2 and tag[0] == "h" and tag[1] in "123456":
            heading = 0 if end else int(tag[1])
        if end:
            page.tags.append((len(page.nodes), path, "/" + tag))
            if any(t[0] == tag for t in stack):
                while stack.pop()[0] != tag:
                    pass
                path = tuple(t[1] for t in stack)
            continue
        if tag == "body":  # ends a head left open
            stack = [s for s in stack if s[0] != "head"]
        elif tag in ("li", "dt", "dd", "tr", "td", "th", "p", "option") and stack and stack[-1][0] == tag:
            stack.pop()
        label, never, out, firm = element(tag, attrs, any(t[0] in CONTAINERS for t in stack))
        over, owner, held, number, nested = stack[-1][2:] if stack else (False, 0, 0, 0, False)
        serial += 1
        place = len(stack) + 1
        if out:
            owner, number, nested = place, serial, owner > 0
        stack.append((tag, label, never or over, owner, place if firm else held, number, nested))
        path = tuple(t[1] for t in stack)
        page.tags.append((len(page.nodes), path, tag))
    return page


Key = tuple[tuple[str, ...], str]


def tokens(page: Page) -> Iterator[Key]:
    """Tokens in page order: a tag or word and the elements around it."""
    at = 0
    for number, node in enumerate(page.nodes):
        while at < len(page.tags) and page.tags[at][0] <= number:
            yield page.tags[at][1], "<" + page.tags[at][2]
            at += 1
        for word in node.text.split():
            yield node.path, word
    for _, path, tag in page.tags[at:]:
        yield path, "<" + tag


@dataclass
class Template:
    root: frozenset  # tokens of the root class
    held: frozenset  # tokens of all valid classes


def ordered(root: set, sequences: list[list[Key]]) -> set:
    """Tokens of the root class that stand in the same order on all pages; those that don't are dropped."""
    first = [t for t in sequences[0] if t in root]
    rank = {t: i for i, t in enumerate(first)}
    bad: set = set()
    for s in sequences[1:]:
        top = -1
        for t in s:
            if (i := rank.get(t)) is not None and t not in bad:
                if i < top:
                    bad.add(t)
                else:
                    top = i
    return root - bad


def deduced(pages: list[Page]) -> Template | None:
    """The template of pages with different texts, or None if they are too few."""
    if len(pages) < MIN_PAGES:
        return None
    sequences = [list(tokens(p)) for p in pages]
    vectors: dict[Key, dict[int, int]] = defaultdict(dict)
    for i, s in enumerate(sequences):
        for t, n in Counter(s).items():
            vectors[t][i] = n
    least = MIN_SUPPORT * len(pages)
    classes: dict[tuple, set] = defaultdict(set)
    for t, v in vectors.items():
        if len(v) >= least:
            classes[tuple(sorted(v.items()))].add(t)
    once = tuple((i, 1) for i in range(len(pages)))
    root = ordered(classes.pop(once, set()), sequences)
    if len(root) < MIN_CLASS:
        return None
    slots: dict[Key, set[int]] = defaultdict(set)  # of each token, the root's slots it is found in
    rank = {t: i for i, t in enumerate(t for t in sequences[0] if t in root)}
    frequent = {t for c in classes.values() if len(c) >= MIN_CLASS for t in c}
    for s in sequences:
        slot = -1
        for t in s:
            if t in rank:
                slot = rank[t]
            elif t in frequent:
                slots[t].add(slot)
    held = set(root)
    for c in classes.values():
        inside = set().union(*(slots[t] for t in c)) if len(c) >= MIN_CLASS else set()
        if len(inside) == 1 and any(t[1].startswith("<") for t in c):
            held |= c
    return Template(frozenset(root), frozenset(held))


def joined(nodes: list[Node]) -> str:
    return " ".join("".join((" " if n.separate else "") + n.text for n in nodes).split())


def in_template(node: Node, template: Template) -> bool:
    words = node.text.split()
    return bool(words) and not node.heading and all((node.path, w) in template.held for w in words)


def slots(page: Page, template: Template | None) -> list[Node]:
    """Text that can be the article's, whatever names say of it."""
    return [n for n in page.nodes if not n.never and n.text.strip() and (template is None or not in_template(n, template))]


def owned(found: list[Node]) -> tuple[dict[tuple[str, ...], int], set[tuple[str, ...]]]:
    """Of a page's slots, the size of the largest left-out element of each chain, and which have a heading or article.

    () is the text that the rules keep.
    """
    sizes: dict[tuple, int] = defaultdict(int)
    marked, paths = set(), set()
    for n in found:
        key = n.path[:n.owner]
        sizes[key, n.serial] += len(n.text)
        if n.heading == 1:
            marked.add(key)
        elif not n.nested and n.path not in paths:
            paths.add(n.path)
            if any(x.split(" ", 1)[0] in CONTAINERS for x in n.path):
                marked.add(key)
    largest: dict[tuple[str, ...], int] = {}
    for (key, _), size in sizes.items():
        largest[key] = max(size, largest.get(key, 0))
    return largest, marked


def wrapper(found: list[list[Node]]) -> tuple[str, ...]:
    """The chain of a left-out element that holds the article by the pages' slots; () if there is none."""
    total: Counter = Counter()
    marks: Counter = Counter()
    for nodes in found:
        largest, marked = owned(nodes)
        total.update(largest)
        marks.update(marked)
    outside = total.pop((), 0)
    if not total:
        return ()
    marked = lambda p: 2 * marks[p] >= len(found)
    best = max(total, key=lambda p: (total[p] * (WRAPPER_SHARE[False, False] if marked(p) else 1), p))
    return best if total[best] > outside * WRAPPER_SHARE[marked(best), marked(())] else ()


def container(
    pages: list[Page], template: Template, around: tuple[str, ...] = (), found: list[list[Node]] | None = None,
) -> tuple[str, ...] | None:
    """The chain of the template's element that holds the article, by the pages' slots (``found`` if they are known)."""
    sizes: Counter = Counter()
    elements = {t[0] for t in template.root if t[1].startswith("<") and not t[1].startswith("</")}
    total = 0
    for nodes in [slots(p, template) for p in pages] if found is None else found:
        for n in nodes:
            if n.seen(around):
                size = len(n.text)
                total += size
                for k in range(1, len(n.path) + 1):
                    if n.path[:k] in elements:
                        sizes[n.path[:k]] += size
    named = [p for p, n in sizes.items() if p[-1].split(" ")[0] in CONTAINERS and n >= total / 2]
    if named:
        return max(named, key=lambda p: (len(p), p))
    wide = [p for p, n in sizes.items() if n >= 0.8 * total]
    return max(wide, key=lambda p: (len(p), p)) if wide else None


def article(page: Page, template: Template | None, chain: tuple[str, ...] | None, around: tuple[str, ...] = ()) -> str:
    """Text of the slots in the article's element; without a template, of articles or else the body.

    A page without the template's article element is judged by its own slots.
    """
    if chain is not None and any(n.path[:len(chain)] == chain and n.text.strip() for n in page.nodes if n.seen(around)):
        whole = chain[-1].split(" ")[0] in ("html", "body")  # not one element of the page: names judge as outside
        kept = [n for n in page.nodes if (n.seen(around) and n.path[:len(chain)] == chain if whole else n.inside(chain))]
    else:
        around = wrapper([slots(page, template)]) if any(n.owner and not n.never for n in page.nodes) else ()
        kept = [n for n in page.nodes if n.seen(around)]
        own = [n for n in kept if any(x.split(" ")[0] in CONTAINERS for x in n.path)]
        kept = own if any(n.text.strip() for n in own) else kept
    if template is not None:
        held = sum(len(n.text) for n in kept if in_template(n, template))
        if held <= MAX_TEMPLATE_SHARE * sum(len(n.text) for n in kept):
            # a dropped run still ends the word before it if it began a block
            out, cut = [], False
            for n in kept:
                if in_template(n, template):
                    cut = cut or n.separate
                else:
                    out.append(replace(n, separate=n.separate or cut))
                    cut = False
            kept = out
    return joined(kept)


def largest_text(page: Page) -> str:
    """What tells pages apart: the text that the rules keep, or that of a left-out element which holds more."""
    sizes, _ = owned(slots(page, None))
    most = max(sizes, key=lambda p: (sizes[p], not p, p), default=())
    return joined([n for n in page.nodes if not n.never and n.path[:n.owner] == most])


def repeated(pages: list[Page], chain: tuple[str, ...]) -> dict[str, int]:
    """Nameless elements right below the chain that every page has several of, and how many."""
    counts = []
    for page in pages:
        found = Counter(path[-1] for _, path, tag in page.tags
                        if len(path) == len(chain) + 1 and path[:-1] == chain and path[-1] == tag)
        counts.append(found)
    return {label: n for label, n in counts[0].items()
            if n > 1 and label in NAMELESS and all(c[label] == n for c in counts)}


def numbered(page: Page, chain: tuple[str, ...], labels: dict[str, int]) -> Page:
    """The page with those elements' places in their labels."""
    depth, place = len(chain), Counter()

    def path_of(path: tuple[str, ...]) -> tuple[str, ...]:
        if len(path) <= depth or path[depth] not in labels or path[:depth] != chain:
            return path
        return (*chain, f"{path[depth]} ~{place[path[depth]]}", *path[depth + 1:])

    out, at = Page(), 0
    for number, node in enumerate([*page.nodes, None]):
        while at < len(page.tags) and page.tags[at][0] <= number:
            before, path, tag = page.tags[at]
            if len(path) == depth + 1 and path[-1] == tag and path[:depth] == chain:
                place[tag] += 1
            out.tags.append((before, path_of(path), tag))
            at += 1
        if node is not None:
            out.nodes.append(replace(node, path=path_of(node.path)))
    return out


def titled(pages: list[Page], chain: tuple[str, ...]) -> bool:
    """Whether the element has a first-level heading on every page."""
    return all(any(n.heading == 1 and n.path[:len(chain)] == chain for n in p.nodes) for p in pages)


def told_apart(
    pages: list[Page], different: list[Page], template: Template, chain: tuple[str, ...] | None,
) -> tuple[list[Page], Template, tuple[str, ...] | None]:
    """Pages, template and the article's element once siblings without names are told apart by their places.

    That is done while the element has no name itself and one of those below it holds the heading of all
    pages and the article's share of slot text; else all stays as it is.
    """
    while chain is not None and chain[-1] in ("html", "body", *NAMELESS):
        labels = repeated(different, chain)
        apart = [numbered(p, chain, labels) for p in different] if labels else []
        finer = deduced(apart) if labels else None
        inner = container(apart, finer) if finer is not None else None
        if inner is None or inner[:len(chain)] != chain or len(inner) == len(chain) or not titled(apart, inner):
            break
        pages, different = [numbered(p, chain, labels) for p in pages], apart
        template, chain = finer, inner
    return pages, template, chain


def extracted(sources: list[str], same_host: bool) -> list[str]:
    """Main texts of a cohort's pages."""
    pages = [parsed(s) for s in sources]
    different = list({largest_text(p): p for p in pages}.values())
    template = deduced(different) if same_host else None
    if template is None:
        return [article(p, None, None) for p in pages]
    found = [slots(p, template) for p in different]
    around = wrapper(found)
    chain = container(different, template, around, found)
    if not around:
        pages, template, chain = told_apart(pages, different, template, chain)
    return [article(p, template, chain, around) for p in pages]


def host(url: Column) -> Column:
    """Lower-case host of a URL; '' if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def once_each(rows: DataFrame) -> DataFrame:
    """``rows`` with ``copies``: equal rows as one, however many, so that no cohort grows with them.

    Digests are counted; only rows whose digest is repeated are grouped.
    """
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    null = lambda c: F.col(c).isNull().cast("string")
    whole = F.concat_ws("\0", null("page_id"), plain("page_id"), null("url"), plain("url"), plain("html"))
    marked = rows.withColumn("same", F.md5(whole.cast("binary")))
    counts = marked.groupBy("same").agg(F.count(F.lit(1)).alias("copies"))
    repeats = written_once(counts.where("copies > 1"), "html-repeats")
    if repeats.isEmpty():
        return rows.withColumn("copies", F.lit(1).cast("long"))
    side = broadcast_within(repeats)
    single = marked.join(side, "same", "left_anti").withColumn("copies", F.lit(1).cast("long"))
    equal = marked.join(side, "same").groupBy("same").agg(
        *[F.first(c).alias(c) for c in (*rows.columns, "copies")])
    return single.unionByName(equal).drop("same")


def main_text(df: DataFrame) -> DataFrame:
    """(page_id, url, html) of ``df`` as (page_id, url, text), a row for each row.

    Whole pages are read. A null or empty html has the text ''. Pages without a host, and hosts with
    fewer than MIN_PAGES different pages in a cohort, have no template: articles or else the body
    are taken, without what tags and names leave out; an element that they leave out is taken all
    the same if the slot text shows that it holds the article. Repeated rows each give a row, but are read
    once. Other columns of ``df`` are not looked at. A host's pages are dealt over cohorts by a hash of the row, so a
    host with most pages is many groups.
    """
    rows = once_each(df.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")).withColumn(
        "host", host(F.col("url")))
    parts = F.ceil(F.count(F.lit(1)) / COHORT_PAGES).cast("int").alias("parts")
    counts = written_once(rows.groupBy("host").agg(parts), "html-hosts")
    dealt = rows.join(counts, "host").withColumn(
        "cohort", F.pmod(F.xxhash64("page_id", "html"), "parts")).drop("parts")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        sources = [x or "" for x in table["html"].to_pylist()]
        texts = extracted(sources, key[0].as_py() != "")
        return table.select(["page_id", "url", "copies"]).append_column("text", pa.array(texts, pa.string()))

    found = dealt.groupBy("host", "cohort").applyInArrow(run, "page_id long, url string, copies long, text string")
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("page_id", "url", "text")


def with_length(df: DataFrame) -> DataFrame:
    return with_new(df, n_chars=F.length("text").cast("long"))
