"""HTML main-text extraction with site template removal (operator 6).

A page's markup is read into a flat list of blocks, each with the elements it
stands in.  Two things go:

* elements that say what they are: menus, headers, footers, sidebars, notices,
  adverts, forms, scripts, styles, comments, by their tag, role, class or id;
* elements that a site repeats: every element subtree is hashed, Spark counts
  on how many pages of a host each hash stands, and subtrees that recur on
  pages whose remaining text differs are deleted, however large the host is.

What an ``article`` or ``main`` element holds is the article itself, so inside
it only whole containers (``div``, ``section``, ``ul``, ``table`` ...) can be
templates, never single headings, paragraphs or list items; a page that was
copied within its site keeps its text.  The articles are the text if they hold
at least half of what stands in ``main`` (or the body) outside links; else all
of ``main`` (or the body) is.  An article within an article is a reader's
comment or the like and goes, unless such articles hold most of the outer one.

Rows: null or blank html gives an empty text.  A null URL belongs to the host
``''``.  Pages whose text without scripts, comments and unwanted elements is
equal count as one page when templates are sought, and so do pages that differ
in recurring elements only: a page repeated many times is not its own template.  Only ``page_id``, ``url``
and ``html`` are read.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import ascii_lower, stage

#: a subtree is a template if it stands on pages of its host with so many different texts besides what recurs
MIN_PAGES = 10

# HTML elements by what they do to text.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var wbr br".split())
DROPPED = frozenset("head title script style noscript template nav footer aside form button select option textarea iframe object embed "
                    "svg math canvas audio video dialog menu noembed noframes xmp".split())
# dropped elements that stand as blocks of their own; the others leave no gap in a line
DROPPED_BLOCKS = frozenset("nav footer aside form menu dialog".split())
CONTAINERS = frozenset("div section ul ol dl table aside nav header footer form figure details fieldset center".split())
# An opening tag that ends open elements of these names (up to the nearest barrier).
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
        "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "body": {"head"}}
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                   "header hgroup hr main menu nav ol p pre section table ul li dt dd".split())
BARRIERS = frozenset("table ul ol dl td th div section article main body html blockquote aside nav header footer form".split())
# Words in class, id or role that mark what is not the article.
MARKS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|notification|alert|popup|modal|overlay|"
    r"newsletter|subscribe|signup|login|sidebar|side-bar|menu|navbar|nav|navigation|breadcrumbs?|pagination|pager|toolbar|header|masthead|"
    r"footer|comments?|comment-list|commentlist|disqus|replies|respond|reviews|share|sharing|social|related|recommended|widget|"
    r"skip-link|contentinfo|complementary|search)(?:$|[\s_-])", re.I)
SPACE = re.compile(r"[ \t\n\r\f\v]+")
# a quote opens a value only after the equals sign; possessive, so that a page is scanned once
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>|<[!?][^>]*+>", re.S)
PLAIN_TOKEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?][^>]*+>")
# Classes of an article that tell of its state or subject, not that it is a comment or an advert.
STATES = re.compile(r"(?<!\S)(?:(?:has|with|no|category|tag|type|format|status)-\S+|\S+-(?:open|closed|enabled|disabled))(?!\S)", re.I)
ATTRIBUTE = re.compile(r"([^\s=/\"'][^\s=/]*+)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s>]++))?+")
# Words of an id that say nothing about what its element is.
NEUTRAL = frozenset("area bar block box container content global group inner left list main outer page primary right secondary section site top "
                    "bottom wrap wrapper".split())


class Element:
    __slots__ = ("tag", "parent", "skip", "children", "hash", "inside")

    def __init__(self, tag, parent, skip, inside):
        self.tag, self.parent, self.skip, self.inside = tag, parent, skip, inside
        self.children: list = []        # elements and strings
        self.hash = 0


def _marked(name: str, value: str, tag: str, inside: bool) -> bool:
    """Whether a class, id or role says that its element is not the article.

    Inside an article an id names what its element is about, often in words that
    are marks elsewhere (``notice-of-death``); it counts there only on containers
    and only if all its words are marks or neutral.
    """
    if inside and name == "id":
        words = [w for w in re.split(r"[\s_-]+", value) if w and not w.isdigit() and w.lower() not in NEUTRAL]
        return tag in CONTAINERS and bool(words) and all(MARKS.fullmatch(w) and "head" not in w.lower() for w in words)
    mark = MARKS.search(value)
    return mark is not None and not (inside and "head" in mark[0].lower())     # an article's own heading may stand in a header


def _unwanted(tag: str, attributes: str, inside: bool) -> bool:
    if tag in DROPPED or (tag == "header" and not inside):
        return True
    if not attributes or tag in ("html", "body"):
        return False
    seen = set()
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in seen:            # the first of a repeated attribute counts
            continue
        seen.add(name)
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True
        if name not in ("class", "id", "role") or tag == "main":
            continue
        if _marked(name, STATES.sub("", value) if tag == "article" else value, tag, inside):
            return True
    return False


def parse(page: str) -> Element:
    """The element tree of a page; missing and misplaced end tags are forgiven.

    Time is linear: a tag that never ends makes the rest be read without regard
    to quotes, and a count of open names tells whether there is anything to close.
    """
    root = here = Element("", None, False, False)
    at, n, last = 0, len(page), page.rfind(">")
    token, open_names = TOKEN, Counter()

    def close(e: Element, upto: Element) -> None:
        while e is not upto:
            open_names[e.tag] -= 1
            e = e.parent

    while at < n:
        begin = page.find("<", at)
        if begin < 0 or (begin > last and not page.startswith("<!--", begin)):
            here.children.append(page[at:])
            break
        m = token.match(page, begin)
        if m is None and token is TOKEN and page[begin + 1:begin + 3].lstrip("/")[:1].isalpha():
            token = PLAIN_TOKEN
            m = token.match(page, begin)
        if m is None:               # a sign, not a tag
            here.children.append(page[at:begin + 1])
            at = begin + 1
            continue
        if begin > at:
            here.children.append(page[at:begin])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:             # comment, doctype
            continue
        if m[1]:                # end tag: closes the nearest open element of that name, else nothing
            e = here if open_names[tag] else root
            while e is not root and e.tag != tag:
                if e.tag in ("td", "th", "table") and tag in INLINE:
                    e = root
                    break
                e = e.parent
            if e is not root:
                close(here, e.parent)
                here = e.parent
            continue
        ends = ENDS.get(tag, frozenset())
        if (tag in ENDS_P and open_names["p"]) or any(open_names[x] for x in ends):
            e, top = here, None
            while e is not root:
                if e.tag in ends or (e.tag == "p" and tag in ENDS_P):
                    top = e
                    if e.tag == "p":
                        break
                elif e.tag in BARRIERS:
                    break
                e = e.parent
            if top is not None:
                close(here, top.parent)
                here = top.parent
        e = Element(tag, here, _unwanted(tag, m[3], here.inside), here.inside or tag in ("article", "main"))
        here.children.append(e)
        if tag in VOID or m[3].endswith("/"):
            continue
        if tag in RAW:          # its content is no markup
            end = re.compile(f"</{re.escape(tag)}", re.I).search(page, at)
            e.children.append(page[at:end.start() if end else n])
            at = end.start() if end else n
            close_at = page.find(">", at)
            at = n if close_at < 0 else close_at + 1
            continue
        here = e
        open_names[tag] += 1
    return root


def _walk(root: Element):
    """Elements below ``root``, parents before children."""
    stack = [root]
    while stack:
        e = stack.pop()
        yield e
        stack.extend(c for c in reversed(e.children) if isinstance(c, Element))


def may_be_template(e: Element) -> bool:
    """Containers inside an article, any element with content outside."""
    return bool(e.children) and e.tag not in ("", "html", "head", "body", "article", "main") and (e.tag in CONTAINERS or not e.inside)


def hash_subtrees(root: Element) -> None:
    """Hash, from its tag and its children's text and hashes, of every element in a subtree that may be a template."""
    order, stack = [], [(root, False)]
    while stack:
        e, within = stack.pop()
        within = within or (not e.skip and may_be_template(e))
        if within:
            order.append(e)
        stack.extend((c, within) for c in e.children if isinstance(c, Element))
    for e in reversed(order):       # children before parents
        parts = [e.tag]
        for c in e.children:
            if not isinstance(c, Element):
                parts.append(SPACE.sub(" ", c).strip())
            elif not c.skip:        # a script's counter or an advert makes no other subtree
                parts.append(f"<{c.hash:x}>")
        e.hash = xxhash.xxh3_64_intdigest("\x00".join(parts).encode("utf-8", "surrogatepass"))


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _digest(texts: list[str]) -> int:
    """Hash of texts but for their white space; 0 without any."""
    text = SPACE.sub(" ", " ".join(texts)).strip(" ")
    return _signed(xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))) if text else 0


def subtrees(page: str) -> tuple[int, list[int], list[int], list[int]]:
    """The page's text as a hash, and in order of the page the subtrees that can be templates (those already unwanted aside).

    Subtree 0 is the page.  Lists: hash, number of the subtree around it, hash of the text that stands in no smaller subtree.
    """
    root = parse(page)
    hash_subtrees(root)
    hashes, around, own, words = [0], [-1], [[]], []
    stack: list = [(root, 0)]
    while stack:
        e, k = stack.pop()
        if isinstance(e, str):
            own[k].append(e)
            words.append(e)
            continue
        if e.skip:
            continue
        if may_be_template(e):
            hashes.append(_signed(e.hash))
            around.append(k)
            own.append([])
            k = len(own) - 1
        stack.extend((c, k) for c in reversed(e.children))
    return _digest(words), hashes, around, [_digest(x) for x in own]


def rest_of(hashes: list[int], around: list[int], own: list[int], gone: set[int]) -> int:
    """Hash of the page's text outside the subtrees ``gone``; 0 without any."""
    out, kept = [], []
    for h, k, x in zip(hashes, around, own):
        out.append(k >= 0 and (out[k] or h in gone))
        if x and not out[-1]:
            kept.append(f"{x:x}")
    return _digest(kept)


def _outermost(root: Element, want: str, barrier: str = "") -> list[Element]:
    """The outermost elements ``want`` below ``root``, those in a ``barrier`` aside."""
    found, stack = [], [c for c in reversed(root.children) if isinstance(c, Element)]
    while stack:
        e = stack.pop()
        if e.skip:
            continue
        if e.tag == want:
            found.append(e)
        elif e.tag != barrier:
            stack.extend(c for c in reversed(e.children) if isinstance(c, Element))
    return found


def _size(top: Element, without: tuple = ()) -> int:
    """Characters of text in an element, that in elements ``without`` aside."""
    n, stack = 0, list(top.children)
    while stack:
        e = stack.pop()
        if isinstance(e, str):
            n += len(e) if not e.isspace() else 0
        elif not e.skip and e.tag not in without:
            stack.extend(e.children)
    return n


def _content(root: Element) -> list[Element]:
    """Where the text is: main, else the body or all; of it the outermost articles, if they hold most of its text."""
    whole = [e for e in _outermost(root, "main", "article") if _size(e)] or _outermost(root, "body") or [root]
    articles = [a for e in whole for a in _outermost(e, "article")]
    for a in articles:
        nested = _outermost(a, "article")
        if nested and 2 * _size(a, ("article",)) >= _size(a):
            for e in nested:
                e.skip = True
    if articles:
        rest = sum(_size(e, ("a", "article")) for e in whole)
        if sum(_size(a, ("a",)) for a in articles) >= rest:
            return articles
    return whole


def extract(page: str | None, templates: frozenset = frozenset()) -> str:
    """Main text of a page: its blocks, white space made single spaces, joined by a blank line."""
    if not page:
        return ""
    root = parse(page)
    if templates:
        hash_subtrees(root)
        for e in _walk(root):
            if e.hash in templates and not e.skip and may_be_template(e):
                e.skip = True
    blocks: list[list[str]] = [[]]

    def cut():
        if blocks[-1]:
            blocks.append([])

    for top in _content(root):
        cut()
        stack: list = [top]
        while stack:
            e = stack.pop()
            if e is None:
                cut()
            elif isinstance(e, str):
                blocks[-1].append(e)
            elif e.skip:
                if e.tag not in INLINE and (e.tag not in DROPPED or e.tag in DROPPED_BLOCKS):
                    cut()
            elif e.tag in INLINE:
                if e.tag == "br":
                    blocks[-1].append(" ")
                stack.extend(reversed(e.children))
            else:
                cut()
                stack.append(None)
                stack.extend(reversed(e.children))
    out = (SPACE.sub(" ", html.unescape("".join(b))).strip(" ") for b in blocks)
    return "\n\n".join(b for b in out if b)


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[\s\S]*?://([^/?#]*)", 1))


_SUBTREES = "host string, tag long, content long, hashes array<long>, around array<long>, own array<long>"


def _subtrees(batches):
    for b in batches:
        rows = [subtrees(t or "") for t in b.column(2).to_pylist()]
        cols = [b.column(0), b.column(1), pa.array([r[0] for r in rows], pa.int64())]
        cols += [pa.array([r[k] for r in rows], pa.list_(pa.int64())) for k in (1, 2, 3)]
        yield pa.RecordBatch.from_arrays(cols, names=[x.split()[0] for x in _SUBTREES.split(", ")])


def _rests(batches):
    for b in batches:
        rows = zip(*(b.column(k).to_pylist() for k in range(1, 5)))
        rest = [rest_of(h, a, o, set(g)) for h, a, o, g in rows]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(4), pa.array(rest, pa.int64())], names=["host", "gone", "rest"])


def _found(rows: DataFrame, key: str, among: DataFrame, name: str) -> DataFrame:
    """host, key and the distinct hashes of the row that stand in ``among`` (host, hash); rows without any aside."""
    each = rows.select("host", key, F.explode(F.array_distinct(F.slice("hashes", 2, F.size("hashes")))).alias("hash"))
    return each.join(among, ["host", "hash"]).groupBy("host", key).agg(F.collect_list("hash").alias(name))


def site_templates(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, tag, templates): hashes of a page's subtrees that are templates of its host; ``tag`` is the html's xxhash64.

    A subtree is one if the pages it stands on have ``min_pages`` different
    texts besides the subtrees that recur on as many pages.  Pages without any are left out.
    """
    p = pages.select(host_of(F.col("url")).alias("host"), F.coalesce(F.col("html"), F.lit("")).alias("html"))
    seen = p.select("host", F.xxhash64("html").alias("tag"), "html").mapInArrow(_subtrees, _SUBTREES)
    lists = F.struct("hashes", "around", "own")
    seen = stage(seen.groupBy("host", "tag").agg(F.any_value(F.struct("content", lists.alias("lists"))).alias("x"))
                 .select("host", "tag", "x.content", "x.lists.*"), "subtrees")
    # pages of equal text count once
    once = stage(seen.groupBy("host", "content").agg(F.min_by(lists, "tag").alias("x")).select("host", "content", "x.*"), "page_texts")
    recurring = once.select("host", F.explode(F.array_distinct(F.slice("hashes", 2, F.size("hashes")))).alias("hash")) \
        .groupBy("host", "hash").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages).select("host", "hash")
    rests = once.join(_found(once, "content", recurring, "gone"), ["host", "content"]).select("host", "hashes", "around", "own", "gone") \
        .mapInArrow(_rests, "host string, gone array<long>, rest long")
    known = rests.where("rest <> 0").select("host", F.explode("gone").alias("hash"), "rest").distinct() \
        .groupBy("host", "hash").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages).select("host", "hash")
    return _found(seen, "tag", stage(known, "known_templates"), "templates")


def _extract(batches):
    names = ["page_id", "url", "text", "n_chars"]
    for b in batches:
        known: dict = {}
        texts = []
        for page, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
            key = tuple(t or ())
            if key not in known:
                known[key] = frozenset(x & ((1 << 64) - 1) for x in key)
            texts.append(extract(page, known[key]))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()),
                                          pa.array([len(t) for t in texts], pa.int64())], names=names)


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    known = stage(site_templates(pages), "site_templates")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("host"),
                        F.xxhash64(F.coalesce(F.col("html"), F.lit(""))).alias("tag"))
    return rows.join(known, ["host", "tag"], "left").select("page_id", "url", "html", "templates") \
        .mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
