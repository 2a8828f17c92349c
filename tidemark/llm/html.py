"""Main text of web pages by templates deduced from equivalence classes.

A page's tokens are its tags, told apart by their path, and its text nodes. Over the
pages of a host every token has an occurrence vector: how often it stands on each page. Tokens of one
vector form a class. Classes that enough pages have, and that nest in one another from the root on, are
the host's template; what is left between them are slots. The varying text of the slots of the article is
the result; without an article, that of all slots but menus and notices.

An occurrence vector is kept as its number of pages, its sum and the XOR of the hashes of (page, count):
these can be summed up anywhere, so that the pages of a host are never brought together.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import by_batch, cut, small, table, text_of
from tidemark.llm.urls import host_and_path

#: A token of the template is on at least this share of the host's pages; text only from so many pages on.
SUPPORT, TEXT_PAGES = 0.5, 3
#: A slot with at least this share of its text in links, and so many links a page, is a menu.
LINK_SHARE, LINKS = 0.8, 3
#: An element that isn't an article by its tag is the article's slot with this share of the text that varies
#: and isn't linked, where articles by tag have less than TAGGED_SHARE of it.
SLOT_SHARE, TAGGED_SHARE = 0.9, 0.5
HOLDERS = set("div section td center table tbody tr dl".split())
#: Paths are spelled out to this depth; a deeper one is the hash of the path above and the last label.
DEPTH = 200

# Elements of HTML and names that pages give to what isn't the article.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style noscript template iframe svg math textarea select object canvas audio video".split()
BLOCK = set(
    "address article aside blockquote body br button center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frame h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
CLOSES_P = BLOCK - {"br", "body", "html", "head", "title", "option", "button"}
ALONE = {
    "li": "ul ol menu".split(), "dt": ["dl"], "dd": ["dl"], "tr": "table tbody thead tfoot".split(),
    "td": ["tr"], "th": ["tr"], "option": ["select"], "p": "div section article td th li body blockquote".split(),
}
PLAIN = set("head nav header footer aside form button menu dialog".split())
NAMES = set(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup "
    "promo promotion reply replies related respond share sharing sidebar signup social sponsor sponsored subscribe "
    "toolbar widget widgets complementary contentinfo search".split()
)
#: Of NAMES: what others say or sell, which varies from page to page. Other names are checked by the host's classes.
FIRM_NAMES = set(
    "ad ads advert advertisement adverts comment comments consent cookie cookies disqus newsletter popup related replies "
    "reply respond share sharing social sponsor sponsored".split()
)
#: Words beside a name that don't change what it says.
NEUTRAL = set("area bar bottom box container global inner left list main primary right secondary section site top wrap wrapper".split())
NEVER = {"html", "body", "main", "article"}

MARKUP = re.compile(
    r"<!--.*?(?:--\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>\"'<]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|</?[a-zA-Z][^<>]*>|<[!?][^>]*>|<[a-zA-Z/!?][^>]*\Z",
    re.S | re.I,
)
#: Where an element ends whose content is no markup of the page.
RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
#: Of these: what has no text of the page if it isn't closed; the text after it belongs to the page.
RAW_VOID = set("svg math iframe object canvas audio video noscript".split())
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
HEADING = re.compile(r"(^|/)h1(\.|/|$)")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


#: By tag or name for certain; by a tag or name that may be around the article as well; by a name to be confirmed.
FIRM, LOOSE, WEAK = 0, 1, 2


@dataclass(eq=False)
class Drop:
    """An element that isn't the article by its tag or name, the next one around it, whether it is in an article,
    and whether it holds one.
    """

    kind: int
    path: str
    inside: bool
    above: Drop | None
    holds: bool = False
    #: Whether an article in it has been noted here and above.
    noted: bool = False
    #: Found when the page is read: whether what is in it is boilerplate, whether an article in it isn't one of the
    #: page, and the nearest element from here on whose name is to be confirmed, with the next of that kind.
    out: bool = False
    hides: bool = False
    weak: Drop | None = None
    next_weak: Drop | None = None


def chain(weak: Drop | None, test: Callable[[Drop], bool], known: dict[int, bool]) -> bool:
    """Whether the test holds for an element whose name is to be confirmed or one of that kind around it.

    ``known`` keeps what was found, so that a page of nested elements takes one step for each.
    """
    seen, found = [], False
    while weak is not None:
        if id(weak) in known:
            found = known[id(weak)]
            break
        seen.append(id(weak))
        if test(weak):
            found = True
            break
        weak = weak.next_weak
    known.update(dict.fromkeys(seen, found))
    return found


@dataclass
class Node:
    """An open element and the nearest drop it is in or is itself."""

    tag: str
    path: str
    parent: Node | None
    depth: int
    drop: Drop | None
    article: bool
    link: bool


@dataclass
class Text:
    """A text node: its element, whether it is boilerplate, in an article, or a link; ``block`` starts a new block.

    ``weak`` is the nearest drop by a name that the template may confirm or refute.
    """

    node: Node
    text: str
    dropped: bool
    article: bool
    link: bool
    block: bool
    #: Whether the next text starts a new block too.
    whole: bool = False
    weak: Drop | None = None

    @property
    def path(self) -> str:
        return self.node.path


@dataclass
class Page:
    tags: dict[str, int] = field(default_factory=dict)
    #: Elements in page order, so that each comes after the one around it.
    nodes: list[Node] = field(default_factory=list)
    texts: list[Text] = field(default_factory=list)
    #: Each after those around it.
    drops: list[Drop] = field(default_factory=list)
    #: Whether it has an article, be it empty.
    article: bool = False


#: Ends the label of an element whose name is to be confirmed.
CHECKED = "~"


def path_hash(path: str) -> str:
    return f"#{xxhash.xxh64_hexdigest(path)}"


def element(parent: Node | None, tag: str, attributes: str) -> Node:
    names: list[list[str]] = []
    label = tag
    kind = None if tag not in PLAIN else FIRM if tag in ("nav", "aside", "footer") else LOOSE
    if attributes and ("=" in attributes or "hidden" in attributes):
        for m in ATTRIBUTE.finditer(attributes):
            value = m[2] or m[3] or m[4] or ""
            if m[1].lower() == "hidden":
                kind = FIRM
                continue
            values = [[w.lower() for w in NAME_PARTS.findall(v)] for v in value.split()]
            names += values
            if m[1].lower() == "class" and any(values):
                label = f"{tag}.{'-'.join(w for words in values for w in words)}"
    if kind is None:
        for words in names:
            if not NAMES.isdisjoint(words) and all(w in NAMES or w in NEUTRAL for w in words):
                kind = FIRM if kind == FIRM or not FIRM_NAMES.isdisjoint(words) else WEAK
    if tag in NEVER:
        kind = None
    if kind == WEAK:
        label += CHECKED
    depth = parent.depth + 1 if parent else 1
    above = "" if not parent else f"{parent.path}/" if depth <= DEPTH else f"{path_hash(parent.path)}/"
    path, within, drop = above + label, bool(parent and parent.article), parent.drop if parent else None
    article = tag in ("article", "main") or tag != "body" and kind is None and any(w == ["main"] or w == ["main", "content"] or "".join(w) == "articlebody" for w in names)
    outer = drop if article else None
    while outer is not None and not outer.noted:
        outer.holds, outer.noted = not outer.inside, True
        outer = outer.above
    if kind is not None:
        drop = Drop(kind, path, within, drop)
    return Node(tag, path, parent, depth, drop, within or article, tag == "a" or bool(parent and parent.link))


def read(source: str) -> Page:
    """The tags, by path, and the text nodes of a page. Unclosed and stray tags are taken as browsers do."""
    page, stack, at, block = Page(), Stack(), 0, True
    top = Node("", "", None, 0, None, False, False)
    last_end: dict[str, int] = {}

    def raw_end(tag: str, start: int) -> int | None:
        """Where an element ends whose content is skipped; none if it isn't closed."""
        if tag not in last_end:
            last_end[tag] = max((m.start() for m in RAW_END[tag].finditer(source)), default=-1)
        return RAW_END[tag].search(source, start).end() if last_end[tag] >= start else None

    def text(raw: str) -> None:
        nonlocal block
        inside = stack.nodes[-1] if stack.nodes else top
        found = entities.unescape(raw) if "&" in raw else raw
        if found:
            page.texts.append(Text(inside, found, False, inside.article, inside.link, block))
            block = False

    while m := MARKUP.search(source, at):
        if m.start() > at:
            text(source[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag, attributes = m[2].lower(), m[3]
        closed = attributes.endswith("/")
        if tag in RAW_END and not m[1] and not closed:
            if end := raw_end(tag, at):
                block, at = True, end
                continue
            closed = tag in RAW_VOID
        if tag in BLOCK:
            block = True
        if m[1]:
            block |= stack.close(tag)
            continue
        if tag in CLOSES_P:
            stack.close("p", ALONE["p"])
        if tag in ALONE:
            stack.close(tag, ALONE[tag])
        above = stack.nodes[-1] if stack.nodes else None
        node = element(above, tag, attributes)
        if tag in RAW_END and not closed and node.drop is (above.drop if above else None):  # up to the end of its parent
            node.drop = Drop(FIRM, node.path, bool(above and above.article), node.drop)
        if node.drop is not (above.drop if above else None):
            page.drops.append(node.drop)
        page.nodes.append(node)
        page.tags[node.path] = page.tags.get(node.path, 0) + 1
        if tag not in VOID and not closed:
            stack.push(node)
    if at < len(source):
        text(source[at:])
    for t, following in zip(page.texts, page.texts[1:]):
        t.whole = t.block and following.block
    if page.texts:
        page.texts[-1].whole = page.texts[-1].block
    # What holds all articles of a page isn't boilerplate; beside an article of its own, it holds others.
    clear = any(n.article and n.drop is None for n in page.nodes)
    for d in page.drops:
        counts = clear or d.kind == FIRM or not d.holds
        d.out = counts and d.kind != WEAK or d.above is not None and d.above.out
        d.hides = d.kind == FIRM or not d.holds or d.above is not None and d.above.hides
        around = d.above.weak if d.above else None
        d.weak, d.next_weak = (d, around) if counts and d.kind == WEAK else (around, None)
    for t in page.texts:
        if t.node.drop is not None:
            t.dropped, t.weak = t.node.drop.out, t.node.drop.weak
    page.article = clear or any(n.article and not n.drop.hides for n in page.nodes)
    return page


class Stack:
    """The open elements, and where those of each tag are."""

    def __init__(self) -> None:
        self.nodes: list[Node] = []
        self.at: dict[str, list[int]] = {}

    def push(self, node: Node) -> None:
        self.at.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def close(self, tag: str, within: list[str] = ()) -> bool:
        """Close the last open element of this tag, unless one that may hold another stands in between.

        Whether a block ended.
        """
        if not self.at.get(tag):
            return False
        last = self.at[tag][-1]
        if any(self.at.get(w) and self.at[w][-1] > last for w in within):
            return False
        ended = False
        while len(self.nodes) > last:
            gone = self.nodes.pop().tag
            self.at[gone].pop()
            ended |= gone in BLOCK
        return ended


def below(node: Node | None, paths: set[str], known: dict[int, bool]) -> bool:
    """Whether an element is, or is in, one of these paths. ``known`` keeps what was found for a page's elements."""
    seen = []
    while node and node.path and id(node) not in known and node.path not in paths:
        seen.append(id(node))
        node = node.parent
    found = bool(node and (known[id(node)] if id(node) in known else node.path in paths))
    known.update(dict.fromkeys(seen, found))
    return found


#: Before the key of a text that is a block of its own, outside an article.
WHOLE = "="


def text_key(text: Text) -> str:
    return f"{WHOLE if text.whole and not text.article else ''}{text.path} {xxhash.xxh64_hexdigest(' '.join(text.text.split()))}"


# -- templates

TOKEN = "host string, token string, kind int, pages long, total long, vector long, chars long, linked long, links long, sources long"
TAG, TEXT, PAGE = 0, 1, 2


def page_tokens(batch: pa.RecordBatch) -> dict:
    """The tokens of a batch, already summed up by host."""
    found: dict[tuple, list[int]] = {}

    def add(key: tuple, seed: int, count: int, chars: int = 0, linked: int = 0, links: int = 0) -> None:
        entry = found.setdefault(key, [0, 0, 0, 0, 0, 0, 0])
        entry[0] += 1
        entry[1] += count
        entry[2] ^= xxhash.xxh64_intdigest(count.to_bytes(8, "little"), seed)
        entry[3] += chars
        entry[4] += linked
        entry[5] += links
        entry[6] |= source_bit

    for page_id, host, source in zip(*(batch.column(i).to_pylist() for i in range(3))):
        page = read(source)
        seed = xxhash.xxh64_intdigest(f"{page_id} {source}")
        source_bit = 1 << xxhash.xxh64_intdigest(source) % 64
        texts: dict[str, list[int]] = {}
        sums = {id(n): [0, 0, 0] for n in page.nodes}
        for t in page.texts:
            size = len(t.text.strip())
            if (slot := sums.get(id(t.node))) and not t.dropped:
                slot[0] += size
                if t.link:
                    slot[1] += size
                    slot[2] += 1
            if size and not t.dropped:
                text = texts.setdefault(text_key(t), [0, 0])
                text[0] += 1
                text[1] += 0 if t.link else size
        slots: dict[str, list[int]] = {}
        for node in reversed(page.nodes):  # with what is in them
            own, slot, above = sums[id(node)], slots.setdefault(node.path, [0, 0, 0]), sums.get(id(node.parent))
            for i, value in enumerate(own):
                slot[i] += value
                if above:
                    above[i] += value
        for path, count in page.tags.items():
            add((host, path, TAG), seed, count, *slots[path])
        for key, (count, chars) in texts.items():
            add((host, key, TEXT), seed, count, chars)
        if page.tags or texts:
            add((host, "", PAGE), seed, 1)
    if not found:
        return {f.split()[0]: [] for f in TOKEN.split(", ")}
    rows = [(*key, *values) for key, values in found.items()]
    columns = list(zip(*rows))
    for i in (5, 9):
        columns[i] = [v - (1 << 64) if v >> 63 else v for v in columns[i]]
    return dict(zip((f.split()[0] for f in TOKEN.split(", ")), columns))


def deduce(pages: int, varied: bool, tokens: list[dict]) -> dict:
    """A host's template: the paths of its article, its menus, and its fixed texts.

    ``tokens`` are those on at least SUPPORT of the pages. Classes nest from the root: a tag's class
    belongs to the template if the path above the tag does. A text is fixed if it is of the class of such
    a tag, however often that stands on a page; outside an article also if it is a block of its own.
    """
    classes: dict[tuple, list[dict]] = {}
    for token in tokens:
        classes.setdefault((token["pages"], token["total"], token["vector"]), []).append(token)
    paths = {t["token"]: t for t in tokens if t["kind"] == TAG}
    inside: dict[str, list[str]] = {}
    above: dict[str, str] = {}
    for path in paths:
        inside.setdefault(path.rpartition("/")[0], []).append(path)
    template, found = set(), inside.get("", [])
    while found:
        template.update(found)
        for path in found:
            above.update((p, path) for key in (path, path_hash(path)) for p in inside.get(key, ()))
        found = [p for path in found for key in (path, path_hash(path)) for p in inside.get(key, ())]
    fixed = []
    for members in classes.values() if pages >= TEXT_PAGES and varied else ():
        of_template = any(t["kind"] == TAG and t["token"] in template for t in members)
        fixed += [t for t in members if t["kind"] == TEXT and (of_template or t["token"].startswith(WHOLE))]
    fixed_chars: dict[str, int] = {}
    for text in fixed:
        path = text["token"].removeprefix(WHOLE).rpartition(" ")[0]
        while path:
            fixed_chars[path] = fixed_chars.get(path, 0) + text["chars"]
            path = above.get(path, "")
    named = [p for p in template if re.match(r"(article|main)(\.|$)", p.rpartition("/")[2])]
    known = pages >= TEXT_PAGES and varied
    content = content_slot(template, above, paths, fixed_chars, named) if known else []
    # A name is confirmed by text that is fixed or linked for the most part.
    checked = {
        p: fixed_chars.get(p, 0) + paths[p]["linked"] >= SUPPORT * paths[p]["chars"]
        for p in sorted(template)
        if known and p.endswith(CHECKED) and paths[p]["chars"]
    }
    menus = []
    for path in template:
        chars, linked, links = (paths[path][k] for k in ("chars", "linked", "links"))
        if links >= LINKS * pages and linked >= LINK_SHARE * chars > 0 and not path.endswith("body") and "/" in path:
            menus.append(path)
    return {
        "articles": [] if content else sorted(named),
        "content": content,
        "menus": sorted(menus),
        "confirmed": [p for p, sure in checked.items() if sure],
        "refuted": [p for p, sure in checked.items() if not sure],
        "fixed": sorted(t["token"] for t in fixed),
    }


def content_slot(template: set[str], above: dict[str, str], paths: dict[str, dict], fixed_chars: dict[str, int], named: list[str]) -> list[str]:
    """The path of the innermost element with nearly all text that varies, unless articles by tag have it."""

    def around(path: str) -> Iterator[str]:
        while path := above.get(path, ""):
            yield path

    free = {p: paths[p]["chars"] - paths[p]["linked"] - fixed_chars.get(p, 0) for p in template}
    whole = sum(free[p] for p in template if p not in above)
    outer = set(named)
    tagged = sum(free[p] for p in named if not any(a in outer for a in around(p)))
    if whole <= 0 or named and tagged >= TAGGED_SHARE * whole:
        return []
    holders = {p for p in template if p.rpartition("/")[2].split(".")[0] in HOLDERS and free[p] >= SLOT_SHARE * whole}
    holders -= {a for p in named for a in around(p)}
    return sorted(holders, key=lambda p: (sum(1 for _ in around(p)), p))[-1:]


def templates(pages: DataFrame) -> DataFrame:
    """(host, template) of each host in rows (page_id, host, html); a template is JSON.

    Tokens on fewer than SUPPORT of a host's pages are left out before a host's are put together, so
    that these are at most a page's tokens divided by SUPPORT.
    """
    parts = by_batch(pages.select("page_id", "host", "html"), page_tokens, TOKEN)
    sums = parts.groupBy("host", "token", "kind").agg(
        F.sum("pages").alias("pages"),
        F.sum("total").alias("total"),
        F.bit_xor("vector").alias("vector"),
        F.sum("chars").alias("chars"),
        F.sum("linked").alias("linked"),
        F.sum("links").alias("links"),
        F.bit_or("sources").alias("sources"),
    )
    sums = cut(sums.where((F.col("kind") != TEXT) | (F.col("pages") >= TEXT_PAGES)))
    counts = sums.where(F.col("kind") == PAGE).select("host", F.col("pages").alias("all_pages"), F.bit_count("sources").alias("all_sources"))
    often = sums.where(F.col("kind") != PAGE).join(counts, "host").where(F.col("pages") >= F.col("all_pages") * SUPPORT)
    # A text of one page and its copies isn't shared, however many they are.
    often = often.where((F.col("kind") != TEXT) | (F.bit_count("sources") >= F.greatest(F.lit(2), F.col("all_sources") * SUPPORT)))
    names = ("token", "kind", "pages", "total", "vector", "chars", "linked", "links")
    variety = pages.groupBy("host").agg((F.min(F.xxhash64("html")) != F.max(F.xxhash64("html"))).alias("varied"))
    grouped = often.groupBy("host", "all_pages").agg(F.to_json(F.collect_list(F.struct(*names))).alias("tokens"))
    grouped = grouped.join(variety, "host")

    def run(batch: pa.RecordBatch) -> dict:
        rows = zip(*(batch.column(n).to_pylist() for n in ("host", "all_pages", "varied", "tokens")))
        made = [(host, json.dumps(deduce(n, varied, json.loads(tokens)))) for host, n, varied, tokens in rows]
        return {"host": [m[0] for m in made], "template": [m[1] for m in made]}

    return cut(by_batch(grouped, run, "host string, template string"))


# -- extraction


def slots(page: Page, template: dict) -> Iterator[tuple[Text, bool]]:
    """The text nodes in page order, and whether the template leaves them for the article."""
    articles, content, menus, fixed = (set(template.get(k, ())) for k in ("articles", "content", "menus", "fixed"))
    confirmed, refuted = set(template.get("confirmed", ())), set(template.get("refuted", ()))
    known_sure: dict[int, bool] = {}
    known_named: dict[int, bool] = {}
    sure = [chain(t.weak, lambda d: d.path in confirmed, known_sure) for t in page.texts]
    named = [t.dropped for t in page.texts]
    for t, certain in zip(page.texts, sure):
        t.dropped = t.dropped or certain or chain(t.weak, lambda d: not d.inside and d.path not in refuted, known_named)
    varies = [not fixed or text_key(t) not in fixed for t in page.texts]
    in_menu: dict[int, bool] = {}
    known: dict[int, bool] = {}
    kept = [not t.dropped and below(t.node, articles, known) for t in page.texts]
    if content:
        known = {}
        kept = [not (t.dropped or below(t.node, menus, in_menu)) and below(t.node, content, known) for t in page.texts]
        if any(k and v and t.text.strip() for k, v, t in zip(kept, varies, page.texts)):  # the heading belongs to it
            kept = [k or HEADING.search(t.path) is not None and not t.dropped for k, t in zip(kept, page.texts)]
        else:
            kept = [False] * len(kept)
    if not any(kept):  # not a page of the template
        kept = [t.article and not t.dropped for t in page.texts]
    if any(kept):
        left = [k and v for k, v in zip(kept, varies)]
        if any(k and t.text.strip() for k, t in zip(left, page.texts)):  # else nothing tells the article from notices
            kept = left
    elif not page.article:
        free = [v and not below(t.node, menus, in_menu) for v, t in zip(varies, page.texts)]
        kept = [f and not t.dropped for f, t in zip(free, page.texts)]
        if not any(k and t.text.strip() for k, t in zip(kept, page.texts)):  # a name alone doesn't empty a page
            kept = [f and not n and not c for f, n, c in zip(free, named, sure)]
    yield from zip(page.texts, kept)


def main_text(source: str, template: dict) -> str:
    """Blocks joined by one blank; white space inside a block is one blank."""
    out: list[str] = []
    block = True
    for t, keep in slots(read(source), template):
        block |= t.block
        if not keep:
            block = True
            continue
        if block or not out:
            out.append(" ")
        out.append(t.text)
        block = False
    return " ".join("".join(out).split())


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html).

    A null html is empty and has an empty text, as has a page without an article or other slots. Pages
    without a host in their url are one host. Rows repeated are repeated; an empty table gives no rows;
    further columns are ignored.
    """
    host, _ = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host.alias("host"), text_of("html").alias("html"))
    rows = rows.join(small(templates(rows)), "host", "left")
    known: dict[str, dict] = {}

    def run(batch: pa.RecordBatch) -> dict:
        texts = []
        for source, template in zip(batch.column("html").to_pylist(), batch.column("template").to_pylist()):
            template = template or '{"articles": [], "menus": [], "fixed": []}'
            if template not in known:
                if len(known) > 1000:
                    known.clear()
                known[template] = json.loads(template)
            texts.append(main_text(source, known[template]))
        return {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": texts, "n_chars": list(map(len, texts))}

    return by_batch(rows, run, "page_id long, url string, text string, n_chars long")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))
