"""Main-text extraction with wrappers inferred per host (operator 5).

A wrapper is a union-free regular expression over a host's page tokens: tags
(name with its class, id and role words), text slots, optional parts ``(...)?``
and repeated groups ``(...)+``.

*Inference.*  A page's token stream is read into nested groups; a run of equal
siblings becomes one repeated group, and siblings whose kinds come back after
others become a repeated group of optional kinds.  Aligning a wrapper with the
next page of the host resolves each mismatch: a text that differs becomes a
slot, a part that only one side has becomes optional, a longer run becomes
repeated.  Alignment of two wrappers is the same operation, so every task folds
all its pages into one wrapper per host, and partial wrappers of a host are
folded pairwise in rounds.  A wrapper's size depends on the template, not on the
number of pages; all pages of a host take part, whatever their number.

*Main region.*  Template are parts whose tag, role, whole class name, or whole id
of a plain container, names a menu, header, footer, sidebar, notice, advert,
form, script, style or comment, and hidden parts.  A mere word of a class or id is
a hint: the part is template if most of its text is in links or all of it is
constant on at least ``constant_pages`` pages.  html, body, article and main are
never template.  Text that is constant on all of at least
``constant_pages`` pages outside an article is template too.

The main region is chosen page by page: the parts of the page at the host's
article (else main) paths; a page that has none of them, the deepest part that
holds most of its text outside links, where each part that the page has counts
with its mean text over the host's pages that have it.  So every template of a
host keeps its own region.  What encloses the main region is not template: an
article inside a marked part is the main region if it holds more text than all
that is outside marked parts, and marks do not count where all text is in marked
parts.

*Extraction.*  Each page's groups are matched with its host's wrapper, and the
text of the main region is collected: character references decoded, white space
inside a block as one space, blocks in page order joined by one space.  Nothing
is capped.

Null or empty html: empty text.  Pages of null or relative url have no host in
common: each is its own wrapper.  A page
without any text in the main region has an empty text.  Truncated markup is read
as far as it goes; elements nested more than DEPTH deep are read as siblings.  Repeated rows are extracted each; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm import exchange as ex
from wattlake.llm import store as st

#: HTML's void elements, raw-text elements, and blocks (which separate text).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table"
    " tbody td tfoot th thead tr ul video".split())
#: A start tag of the key closes an open element of the values.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "body": {"head"}}
#: Start tags that end an open paragraph.
_ENDS_P = BLOCKS - frozenset("br body caption dd dt head html legend li option optgroup tbody td tfoot th thead tr summary".split())
#: Elements that bound the search for an element to close.
_SCOPE = frozenset("ul ol dl table td th article section div body select".split())

#: Tags and words of class, id and role that mark template parts.
SKIP_TAGS = frozenset(
    "head nav header footer aside form script style noscript template iframe svg button select textarea input label dialog menu"
    " object embed applet canvas audio video map noframes noembed xmp".split())
SKIP_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion promoted banner banners"
    " cookie cookies consent gdpr notice notices alert alerts popup modal overlay comment comments commentlist disqus reply replies"
    " respond sidebar aside menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer header masthead topbar toolbar"
    " share sharing social related recommended recommendations newsletter subscribe subscription signup login search searchbox form"
    " skip hidden print copyright widget contentinfo complementary".split())

#: Elements that are never template, and containers whose whole id names a role (ids of headings and sections come from their text).
REGIONS = frozenset("html body article main".split())
CONTAINERS = frozenset("div ul ol table tbody tr td".split())

#: Elements that are a line of text themselves, and words that name the layout around text: on such a line they are style.
LINES = frozenset("h1 h2 h3 h4 h5 h6 p pre blockquote figcaption caption".split())
LAYOUT_WORDS = frozenset("header footer form menu nav navigation aside sidebar masthead topbar toolbar print skip search banner widget".split())

#: A constant text longer than this is kept by its hash.
LONG_TEXT = 200

#: Elements nested deeper are read as siblings.
DEPTH = 200

_TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:-->|\Z)|<[!?](?P<decl>[^>]*)(?:>|\Z)|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?>=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|=\s*[^\s>\"'][^\s>]*|[^>])*+)(?:>|\Z)|(?P<text>[^<]+|<)", re.S)
_ATTR = re.compile(r"""([^\s>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"'][^\s>]*))?""")
_UNSEEN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b")
_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


class Node:
    """A group of tokens: an element of a page."""

    __slots__ = ("key", "tag", "children")

    def __init__(self, key: str, tag: str):
        self.key, self.tag, self.children = key, tag, []


def _key(tag: str, attrs: str) -> str:
    """Tag and the sorted letter words of class, id and role (numbers differ from page to page).

    Before them a mark: ``!`` template by its own role, ``+`` main region by its
    own role, ``?`` some word of a class or id hints at template.
    """
    if not attrs or "=" not in attrs and "hidden" not in attrs.lower():
        return tag
    given: dict[str, str] = {}
    for name, value in _ATTR.findall(attrs):
        given.setdefault(name.lower(), value.strip("\"'").lower())
    classes, own, role = (given.get(x, "").split() for x in ("class", "id", "role"))
    words = set(_WORDS.findall(" ".join(classes + own + role)))
    mark = ""
    if tag not in SKIP_TAGS and tag not in REGIONS:
        names = {*classes, *role, *(own if tag in CONTAINERS and "section" not in classes else ())}
        if tag in LINES:
            names -= LAYOUT_WORDS
        if "hidden" in given or _UNSEEN.search(given.get("style", "")):
            mark = "!"
        elif "main" in role or "main" in own:
            mark = "+"
        elif names & SKIP_WORDS:
            mark = "!"
        elif "main" in classes or "articlebody" in classes:
            mark = "+"
        elif words & SKIP_WORDS:
            mark = "?"
    return mark + ".".join([tag, *sorted(words)])


def read_page(text: str) -> Node:
    """The page's tokens as nested groups; a child is a Node or a text."""
    root = Node("", "")
    stack, at, n = [root], 0, len(text)
    while at < n:
        m = _TOKEN.match(text, at)
        at = m.end()
        kind = m.lastgroup if m.lastgroup != "attrs" else "tag"
        if kind == "text":
            stack[-1].children.append(m["text"])
        elif kind == "tag":
            tag = m["tag"].lower()
            if tag in _ENDS_P:
                _close(stack, {"p"})
            if tag in CLOSES:
                _close(stack, CLOSES[tag])
            node = Node(_key(tag, m["attrs"]), tag)
            stack[-1].children.append(node)
            if tag in RAW:
                end = re.compile(f"</{tag}[\\s/>]", re.I).search(text, at)
                body = text[at:end.start() if end else n]
                if tag in ("title", "textarea"):
                    node.children.append(body)
                at = n if end is None else (text.find(">", end.start()) + 1 or n)
            elif tag not in VOID and not m["attrs"].rstrip().endswith("/") and len(stack) < DEPTH:
                stack.append(node)
        elif kind == "end":
            tag = m["end"].lower()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
    return root


def _close(stack: list[Node], tags: set[str]) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            del stack[i:]
            return
        if stack[i].tag in _SCOPE and stack[i].tag not in tags:
            return


# A wrapper part: [key, pages with it, 1 or 2 (repeated), text (None, a constant, or 1 for a slot), slot text, link text, parts].
KEY, SEEN, REPEAT, TEXT, SLOT, LINK, PARTS = range(7)


def fold(node: Node, linked: bool = False) -> list:
    """The wrapper of one page's group."""
    linked = linked or node.tag == "a"
    w = [node.key, 1, 1, None, 0, 0, []]
    place: dict[str, int] = {}
    for c in node.children:
        if isinstance(c, str):
            t = _SPACE.sub(" ", c).strip()
            if t:
                w[TEXT] = t if w[TEXT] is None else 1
                w[LINK if linked else SLOT] += len(t)
            continue
        part = fold(c, linked)
        i = place.get(part[KEY])
        if i is None:
            place[part[KEY]] = len(w[PARTS])
            w[PARTS].append(part)
        else:  # an equal sibling: everything from its first place on repeats
            w[PARTS][i] = align(w[PARTS][i], part)
            w[PARTS][i][SEEN] = 1
            for p in w[PARTS][i:]:
                p[REPEAT] = 2
    if isinstance(w[TEXT], str) and len(w[TEXT]) > LONG_TEXT:
        w[TEXT] = "\0" + hashlib.blake2b(w[TEXT].encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
    return w


def align(a: list, b: list) -> list:
    """The wrapper of both: differing texts become slots, parts of one side optional, longer runs repeated."""
    text = a[TEXT] if a[TEXT] == b[TEXT] else 1
    out = [a[KEY], a[SEEN] + b[SEEN], max(a[REPEAT], b[REPEAT]), text, a[SLOT] + b[SLOT], a[LINK] + b[LINK], []]
    of_b = {p[KEY]: i for i, p in enumerate(b[PARTS])}
    done = 0
    for p in a[PARTS]:
        i = of_b.get(p[KEY])
        if i is None:
            out[PARTS].append(p)
            continue
        for j in range(done, i):  # parts of b before this one that a lacks
            if all(q[KEY] != b[PARTS][j][KEY] for q in a[PARTS]):
                out[PARTS].append(b[PARTS][j])
        done = max(done, i + 1)
        out[PARTS].append(align(p, b[PARTS][i]))
    have = {p[KEY] for p in out[PARTS]}
    out[PARTS] += [p for p in b[PARTS] if p[KEY] not in have]
    return out


def expression(w: list, above: int | None = None) -> str:
    """The wrapper as a union-free regular expression."""
    inner = ("#text " if w[TEXT] == 1 else repr(w[TEXT]) + " " if w[TEXT] is not None else "") + " ".join(
        expression(p, w[SEEN]) for p in w[PARTS])
    body = f"<{w[KEY]}> {inner}".rstrip()
    if w[REPEAT] == 2:
        return f"({body})+" if above is None or w[SEEN] >= above else f"(({body})+)?"
    return body if above is None or w[SEEN] >= above else f"({body})?"


def is_template(key: str, marks: bool = True) -> bool:
    """By its own role; without ``marks`` by its tag alone, and a form may enclose the page."""
    if key[0] in "!?+":
        return marks and key[0] == "!"
    tag = key.split(".", 1)[0]
    return tag in SKIP_TAGS and (marks or tag != "form")


def _is_region(key: str, names: tuple[str, ...]) -> bool:
    tag, *words = key.lstrip("!?+").split(".")
    if tag in names:
        return True
    return key[0] != "!" and "articlebody" in words or "main" in names and "main" in words and key[0] not in "!?" and tag not in SKIP_TAGS


def _hinted(p: list, constant_pages: int) -> bool:
    """Whether a part of which a word hints at template is one: mostly links, or nothing but constant text."""

    def total(x: list) -> tuple[int, int, bool]:
        text, link = x[SLOT], x[LINK]
        fixed = x[TEXT] is None or x[TEXT] != 1 and x[SEEN] >= constant_pages
        for c in x[PARTS]:
            t, k, f = total(c)
            text, link, fixed = text + t, link + k, fixed and f
        return text, link, fixed

    text, link, fixed = total(p)
    return fixed or link > text


def _hints(w: list, constant_pages: int, path: tuple[str, ...] = ()) -> set[tuple[str, ...]]:
    """Paths of the hinted parts that are template."""
    out = set()
    for p in w[PARTS]:
        at = (*path, p[KEY])
        if p[KEY][0] == "?" and _hinted(p, constant_pages):
            out.add(at)
        else:
            out |= _hints(p, constant_pages, at)
    return out


def _tagged(w: list, names: tuple[str, ...], path: tuple[str, ...], skip: set, marks: bool = True) -> list[tuple[tuple[str, ...], list]]:
    """Outermost parts of these kinds outside template parts, with their paths."""
    out = []
    for p in w[PARTS]:
        at = (*path, p[KEY])
        if _is_region(p[KEY], names):
            out.append((at, p))
        elif not is_template(p[KEY], marks) and not (marks and at in skip):
            out += _tagged(p, names, at, skip, marks)
    return out


def _weight(w: list, path: tuple[str, ...], skip: set, marks: bool = True) -> int:
    """Text outside links and template parts below a part."""
    return w[SLOT] - w[LINK] + sum(_weight(p, at, skip, marks) for p in w[PARTS] for at in [(*path, p[KEY])]
                                   if not is_template(p[KEY], marks) and not (marks and at in skip))


def _on_every_page(w: list, path: tuple[str, ...]) -> bool:
    pages, above = w[SEEN], 1
    for key in path:
        w = next(p for p in w[PARTS] if p[KEY] == key)
        if above == 2 or w[SEEN] < pages:  # inside a repeated part, pages are not counted
            return False
        above = w[REPEAT]
    return True


def rules(w: list, constant_pages: int = 5) -> dict:
    """What extraction needs of a host's wrapper: article and main paths, hinted template parts, and, unless every page
    has one of the paths, constant texts and each part's mean text outside links and whether it repeats."""
    skip = _hints(w, constant_pages)
    main = [_tagged(w, names, (), skip) for names in (("article",), ("main",))]
    out = {"main": [["/".join(at) for at, _ in found] for found in main], "template": ["/".join(x) for x in skip],
           "constant": [], "weight": {}}
    if any(_on_every_page(w, at) for found in main for at, _ in found):
        return out

    def walk(x: list, path: str, pages: int) -> None:
        same = isinstance(x[TEXT], str) and x[SEEN] >= constant_pages and x[REPEAT] == 1
        if same:
            out["constant"].append(path)
        pages = min(pages, x[SEEN])  # inside a repeated part, parts are seen more often than pages
        if x[TEXT] is not None or x[REPEAT] == 2:
            out["weight"][path] = [0 if same else round((x[SLOT] - x[LINK]) / pages, 1), x[REPEAT]]
        for c in x[PARTS]:
            walk(c, f"{path}/{c[KEY]}" if path else c[KEY], pages)

    walk(w, "", w[SEEN])
    return out


def _own_region(page: Node, rule: dict, most: float = 0.7) -> tuple[set[str], bool]:
    """Paths of the main region of a page that has none of its host's article and main paths, and whether marks count."""
    w, given, hinted = fold(page), rule["weight"], set(rule["template"])
    # a part of which the host knows nothing speaks for itself
    skip = {tuple(x.split("/")) for x in hinted} if given else _hints(w, 5)

    def mean(x: list, path: tuple[str, ...]) -> list:
        """The page's part, with the host's mean text and repetition."""
        size, repeat = given.get("/".join(path), (x[SLOT] - x[LINK], x[REPEAT]))
        return [x[KEY], 1, max(repeat, x[REPEAT]), x[TEXT], size, 0, [mean(c, (*path, c[KEY])) for c in x[PARTS]]]

    w = mean(w, ())
    outside = _weight(w, (), skip)
    for marks in (True, False):
        for names in (("article",), ("main",)):
            found = _tagged(w, names, (), skip, marks)
            if found and (marks or sum(_weight(p, at, skip) for at, p in found) > outside):
                return {"/".join(at) for at, _ in found}, True
    marks = outside > 0
    at, path = w, ()
    while True:  # down to the part that holds most of the text
        parts = [(_weight(p, (*path, p[KEY]), skip, marks), p) for p in at[PARTS]
                 if not is_template(p[KEY], marks) and not (marks and (*path, p[KEY]) in skip)]
        size, best = max(parts, key=lambda x: x[0], default=(0, None))
        if best is None or best[REPEAT] == 2 or size < most * max(1, _weight(at, path, skip, marks)):
            return {"/".join(path)}, marks
        at, path = best, (*path, best[KEY])


def extract(page: Node, rule: dict) -> str:
    """Text of the main region."""
    template = set(rule["template"])
    out: list[str] = []

    def collect(node: Node, path: str) -> None:
        skip = path in constant
        for c in node.children:
            if isinstance(c, str):
                if not skip:
                    out.append(html.unescape(c))
            elif not is_template(c.key, marks):
                at = f"{path}/{c.key}" if path else c.key
                if at in template and marks:
                    continue
                block = c.tag in BLOCKS
                if block:
                    out.append(" ")
                collect(c, at)
                if block:
                    out.append(" ")

    def find(node: Node, path: str) -> bool:
        """Whether the page has any of the paths."""
        if path in main:
            collect(node, path)
            out.append(" ")
            return True
        found = False
        for c in node.children:
            if isinstance(c, Node):
                at = f"{path}/{c.key}" if path else c.key
                if at in main or at in above:
                    found = find(c, at) or found
        return found

    marks, constant = True, set()
    for paths in map(set, rule["main"]):
        main, above = paths, _above(paths)
        if paths and find(page, ""):
            break
    else:
        main, marks = _own_region(page, rule)
        above = _above(main)
        constant = set(rule["constant"])
        find(page, "")
    # a decoded space is white space like any other
    return _SPACE.sub(" ", "".join(out)).strip()


def _above(paths: set[str]) -> set[str]:
    return {p[:i] for p in paths for i, x in enumerate(p) if x == "/"}


def host_of(url: str | None) -> str:
    m = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def _partial_wrappers(batches) -> Iterator[pa.RecordBatch]:
    """One wrapper per host over all pages of the task."""
    held: dict[str, list] = {}
    for b in batches:
        for url, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            h = host_of(url)
            if text and h:
                w = fold(read_page(text))
                held[h] = align(held[h], w) if h in held else w
        if len(held) > 20000:  # many hosts: pass on what is there
            yield _wrapper_rows(held)
            held = {}
    yield _wrapper_rows(held)


def _wrapper_rows(held: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"host": pa.array(list(held), pa.string()),
                                       "wrapper": pa.array([json.dumps(w) for w in held.values()], pa.string())})


def _merge_wrappers(batches) -> Iterator[pa.RecordBatch]:
    held: dict[str, list] = {}
    for b in batches:
        for h, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            w = json.loads(w)
            held[h] = align(held[h], w) if h in held else w
    yield _wrapper_rows(held)


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper as JSON) for every host of ``pages`` (url, html)."""
    n = st.shards_of(pages)
    part = pages.select("url", "html").mapInArrow(_partial_wrappers, "host string, wrapper string")
    # two rounds: a host's partial wrappers meet in up to 16 tasks, then in one
    part = part.repartition(n, "host", F.pmod(F.spark_partition_id(), F.lit(16))).mapInArrow(
        _merge_wrappers, "host string, wrapper string")
    return part.repartition(n, "host").mapInArrow(_merge_wrappers, "host string, wrapper string")


def _with_rules(batches, given: dict | None) -> Iterator[pa.RecordBatch]:
    own = {"main": [], "template": [], "constant": [], "weight": {}}  # no host: the page alone
    read = lru_cache(64)(json.loads)
    for b in batches:
        cols = {n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)}
        texts = []
        for i, (url, page) in enumerate(zip(cols["url"], cols["html"])):
            if not page:
                texts.append("")
                continue
            if given is not None:
                rule = given.get(host_of(url), own)
            else:
                rule = read(cols["rules"][i]) if cols["rules"][i] else own
            texts.append(extract(read_page(page), rule))
        yield pa.RecordBatch.from_pydict({
            "page_id": pa.array(cols["page_id"], pa.int64()), "url": pa.array(cols["url"], pa.string()),
            "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})


def _rule_rows(batches) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_pydict({
            "host": b.column(0), "rules": pa.array([json.dumps(rules(json.loads(w))) for w in b.column(1).to_pylist()], pa.string())})


def extract_pages(pages: DataFrame, broadcast_max: int = 16 << 20) -> DataFrame:
    """Per row of ``pages`` (page_id bigint, url string, html string): page_id, url, text, n_chars.

    The hosts' rules go to every task while they are at most ``broadcast_max``
    characters in all (counted first); beyond that pages and rules are joined by host.
    """
    store = st.new_store(pages.sparkSession, "wrappers")
    found = st.saved(infer_wrappers(pages).mapInArrow(_rule_rows, "host string, rules string"), store, "rules")
    size = found.agg(F.coalesce(F.sum(F.length("host") + F.length("rules")), F.lit(0))).first()[0]
    src = pages.select("page_id", "url", "html")
    out = "page_id long, url string, text string, n_chars long"
    if size <= broadcast_max:
        given = {r["host"]: json.loads(r["rules"]) for r in found.collect()}
        return src.mapInArrow(partial(_with_rules, given=given), out)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    joined = src.withColumn("host", host).join(found, "host", "left").drop("host")
    return joined.mapInArrow(partial(_with_rules, given=None), out)
