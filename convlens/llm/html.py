"""Main text of HTML pages, by deducing each host's template.

Method: the tokens of a page are its elements, told apart by their path, and its blocks of text with
the path they lie on. A token's *occurrence vector* says how often it occurs on each page of the host;
tokens with equal vectors form an equivalence class. A class is valid if elements are in it: then its
texts come with these elements, on whatever pages these are, and where one lies within the other the
text is nested in the template and not a slot of it. So a notice on some of a host's pages is
template if the element around it is on just these pages, and a text on every page is nested in the
page's own skeleton. What is left are slots: the text of those that lie in the content
element, and outside the elements that HTML itself or their names mark as menus, adverts and the like,
is the main text.

Vectors are never gathered: a vector is a sum of hashes, one for each page and count, so that a host
with a third of all pages is summed up in the map tasks. A host's template is one small row.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convlens.llm.text import chunks
from convlens.runtime import cut

#: Pages on which a class must occur to be evidence of a template: on fewer, vectors agree by chance.
SUPPORT = 3
#: Hosts' templates that a task keeps at hand.
KEPT = 1_000
#: Share of the slots' text that a child element must hold for the content element to be inside it.
CONTENT_SHARE = 0.8

#: Elements whose content is no markup.
RAW = frozenset("script style textarea title noscript iframe template svg math noframes object select".split())
TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
#: What a tag has up to its end or to its next quote.
UNQUOTED = re.compile(r"""[^"'>]*""")
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

#: Elements that begin a block, those that hold no article text, those without an end.
BLOCKS = frozenset(
    "html body head article section main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th"
    " caption blockquote pre figure figcaption hr address details summary header footer nav aside form fieldset legend"
    " menu dialog center hgroup search".split()
)
ASIDE = frozenset("head nav footer aside form menu dialog button input label fieldset legend search".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that another one of their kind, or what holds them, ends.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"),
}
#: Parts of names and roles that mark an element as no part of an article.
MARKS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside complementary footer contentinfo ad ads advert"
    " adverts advertisement advertisements advertising adsense banner promo promotion promoted sponsor sponsored cookie cookies"
    " consent gdpr notice notices alert notification comment comments disqus reply replies respond share sharing social related"
    " recommended recommendations newsletter subscribe subscription signup login popup modal overlay widget widgets toolbar"
    " pagination pager masthead copyright search responses discussion".split()
)
#: Marks that are words of articles too; they mark an element only beside words of layout.
WEAK = frozenset(
    "alert notification notice notices search share sharing social related recommended promotion promoted banner popup modal"
    " overlay widget widgets toolbar reply replies respond responses discussion signup login subscribe subscription consent"
    " copyright menu aside complementary".split()
)
LAYOUT = frozenset(
    "area bar block body box btn button buttons card cards col column container content flex footer full grid group head header"
    " holder inline inner item items layout left link links list main message messages module outer page panel post posts"
    " primary right row secondary section site small text title top bottom view wrap wrapper entry article articles site page".split()
)
HEADS = frozenset("header masthead banner topbar".split())
#: Elements that may wrap an article; words that say of a wrapper what is in it, and those of
#: names that wrap an article together with what is beside it (as in content-sidebar-wrap).
WRAPPERS = frozenset("html body main article section div".split())
PLAIN = frozenset("html body article main".split())
STATES = frozenset("with has no without".split())
WHOLES, WRAPS = frozenset("main content article body".split()), frozenset("wrap wrapper container layout grid".split())
SIDES = frozenset("sidebar aside".split())
COMMENTS = frozenset("comment comments".split())


def marks(tag: str, name: str) -> set[str]:
    """The marks among the parts of one name of an element.

    On a wrapper, a mark does not count behind a word that says what the wrapper has (with-sidebar,
    no-ads), nor a side in the name of what wraps it together with the content; of comments on an
    element that is never a mere part, whether they are open does not count either.
    """
    parts = [p.lower() for p in NAME_PART.findall(name)]
    found = MARKS.intersection(parts)
    if found and not any(p in MARKS - WEAK for p in parts) and not all(p in MARKS or p in LAYOUT or p in STATES or p.isdigit() for p in parts):
        return set()  # alert-study is a study, search-term a term
    if not found or tag not in WRAPPERS:
        return found
    if not WHOLES.isdisjoint(parts) and not WRAPS.isdisjoint(parts):
        found -= SIDES
    said = {p for before, p in zip(parts, parts[1:]) if before in STATES}
    if tag in PLAIN:
        said |= {p for p, after in zip(parts, parts[1:]) if p in COMMENTS and after in ("open", "closed")}
    return found - said


class Element:
    """An open element: the one around it, its name, and what it and those around it say about its text.

    ``path`` names the elements down to this one; it is a hash, so that deep pages cost no more than flat ones.
    """

    __slots__ = ("article", "aside", "beyond", "depth", "headed", "heading", "main", "name", "number", "outer", "path", "tag")

    def __init__(self, tag: str, more: str, number: int, outer: Element | None):
        self.tag, self.number, self.outer = tag, number, outer
        self.name, self.aside, head = tag, tag in ASIDE, tag == "header"
        role = ""
        if more.strip(" /"):
            found = attributes(more)
            given = [name for k in ("class", "id", "role") for name in found.get(k, "").split()]
            names = [p.lower() for name in given for p in NAME_PART.findall(name)]
            marked = set() if MARKS.isdisjoint(names) else set().union(*(marks(tag, name) for name in given))
            plain = tag in PLAIN
            self.aside = hidden(found) or tag in ASIDE or bool(marked & COMMENTS if plain else marked)
            head = tag == "header" or not HEADS.isdisjoint(names) and not plain
            role = ".main" if found.get("role", "").lower() == "main" else ""
            classes = "".join("." + c for c in sorted(set(found.get("class", "").split())))
            self.name = tag + role + classes + ("#" + found["id"] if found.get("id") else "")
        self.path = path_id(self.name, outer.path if outer else 0)
        self.depth = outer.depth + 1 if outer else 1
        # Whether this or one around it is set aside, or a head; and the outermost article and main element around.
        self.beyond = self.aside or outer is not None and outer.beyond
        self.headed = head or outer is not None and outer.headed
        self.article = outer.article if outer else None
        if self.article is None and tag == "article" and not self.beyond:
            self.article = self
        self.main = outer.main if outer else None
        if self.main is None and (tag == "main" or role) and not self.beyond:
            self.main = self
        self.heading = tag in ("h1", "h2") or outer is not None and outer.heading


@dataclass
class Block:
    """A run of text between block tags: the innermost element around it (None: none), and the text."""

    inner: Element | None
    text: str


def path_id(name: str, outer: int = 0) -> int:
    return xxhash.xxh64_intdigest(f"{outer}>{name}") - (1 << 63)


def attributes(more: str) -> dict[str, str]:
    return {k.lower(): (v or "").strip("\"'") for k, v in ATTRIBUTE.findall(more)}


def hidden(found: dict[str, str]) -> bool:
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return True
    return "display:none" in re.sub(r"\s", "", found.get("style", "")).lower()


def scan(page: str) -> Iterator[tuple[str, str, str]]:
    """The page's text and tags in order, as ``(kind, name, rest)``: kind is text, start or end.

    Comments, declarations and what raw elements hold are passed over. The page is read once: what is
    looked for and does not follow is not looked for again. A tag that does not end is text; after a quote that
    does not end, quotes of its kind are letters, and all are after a tag that ends within quotes only.
    """
    at, size, never, letters = 0, len(page), set(), set()

    def find(what: str, start: int) -> int:
        if what in never:
            return -1
        place = page.find(what, start)
        if place < 0:
            never.add(what)
        return place

    def tag_end(start: int) -> int:
        here = start
        while True:
            here = UNQUOTED.match(page, here).end()
            if here >= size:
                return -1
            if page[here] == ">":
                return here
            quote = page[here]
            close = here if quote in letters else find(quote, here + 1)
            if close < 0:
                letters.add(quote)
                return tag_end(start) if len(letters) < 3 else -1
            here = close + 1

    while at < size:
        open_ = page.find("<", at)
        if open_ < 0 or find(">", open_) < 0 and not page.startswith("<!--", open_):
            yield "text", "", page[at:]
            return
        if open_ > at:
            yield "text", "", page[at:open_]
        if page.startswith("<!--", open_):
            close = find("-->", open_ + 4)
            at = size if close < 0 else close + 3
        elif page.startswith("<![CDATA[", open_) and (close := find("]]>", open_)) >= 0:
            at = close + 3
        elif page.startswith(("<!", "<?"), open_):
            at = find(">", open_) + 1
        elif (found := TAG.match(page, open_)) is None:
            yield "text", "", "<"
            at = open_ + 1
        else:
            end = tag_end(found.end())
            if end < 0:  # no quotes make sense of what is left
                letters.update("\"'")
                end = find(">", open_)
            name, more = found[1].lower(), page[found.end() : end]
            at = end + 1
            closed = page[open_ + 1] == "/"
            if name in RAW and not closed:
                if not (name in ("svg", "math") and more.endswith("/")):
                    over = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(page, at) if name not in never else None
                    if over is None:
                        never.add(name)
                    at = size if over is None else over.end()
            else:
                yield "end" if closed else "start", name, more


class _Stack:
    """The open elements, and where in the stack each kind of element is open."""

    def __init__(self):
        self.open: list[Element] = []
        self.places: dict[str, list[int]] = {}

    @property
    def top(self) -> Element | None:
        return self.open[-1] if self.open else None

    def push(self, e: Element) -> None:
        self.places.setdefault(e.tag, []).append(len(self.open))
        self.open.append(e)

    def cut(self, place: int) -> None:
        while len(self.open) > place:
            self.places[self.open.pop().tag].pop()

    def last(self, *tags: str) -> int:
        """The place of the innermost open element of these kinds, or -1."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)


def parse(page: str) -> tuple[list[Block], list[Element]]:
    """The text blocks of a page, and its elements but for inline ones, in order."""
    stack, blocks, elements = _Stack(), [], []
    pieces: list[tuple[str, bool]] = []  # text, and whether an inline element's name sets it aside
    inline: list[tuple[str, bool]] = []  # open inline elements that matter, and whether they are hidden

    def finish() -> None:
        inline.clear()
        # A word with such a name within a sentence is a word; what stands by itself is not.
        if any(text.strip() for text, named in pieces if not named):
            text = "".join(text for text, _ in pieces)
            text = " ".join((unescape(text) if "&" in text else text).split())
            if text:
                blocks.append(Block(stack.top, text))
        pieces.clear()

    for kind, tag, more in scan(page):
        if kind == "text":
            if not any(gone for _, gone in inline):
                pieces.append((more, bool(inline)))
            continue
        if tag == "br":
            pieces.append((" ", bool(inline)))
            continue
        block = tag in BLOCKS
        if kind == "end":
            if (place := stack.last(tag)) >= 0:
                if block or stack.top.aside:
                    finish()
                stack.cut(place)
            elif block:
                finish()
            elif any(t == tag for t, _ in inline):
                while inline.pop()[0] != tag:
                    pass
            continue
        if not block and tag not in ASIDE:  # inline: only its names matter
            if tag not in VOID and more.strip(" /") and not more.rstrip().endswith("/"):
                found = attributes(more)
                gone = hidden(found)
                given = [name for k in ("class", "id", "role") for name in found.get(k, "").split()]
                if gone or any(marks(tag, name) for name in given):
                    inline.append((tag, gone))
                elif inline:
                    inline.append((tag, False))
            elif inline and tag not in VOID and not more.rstrip().endswith("/"):
                inline.append((tag, False))
            continue
        finish()
        if block and (place := stack.last("p")) > stack.last("table", "div", "section", "article", "li", "td"):
            stack.cut(place)  # a paragraph ends where a block begins
        for other in CLOSES.get(tag, ()):
            if (place := stack.last(other)) > stack.last("ul", "ol", "dl", "table"):
                stack.cut(place)
        if tag not in VOID:
            elements.append(Element(tag, more, len(elements), stack.top))
            stack.push(elements[-1])
    finish()
    return blocks, elements


def _is_slot(block: Block) -> bool:
    """Whether nothing around a block sets it aside, nor is a site's head."""
    return block.inner is None or not (block.inner.beyond or block.inner.headed)


def _within(blocks: list[Block], content: int) -> list[Block]:
    """The blocks below an element of this path that nothing sets aside."""
    known: dict[int, bool] = {}
    chosen = []
    for b in blocks:
        e, way = b.inner, []
        while e is not None and e.number not in known and e.path != content:
            way.append(e.number)
            e = e.outer
        inside = e is not None and (e.path == content or known[e.number])
        known.update(dict.fromkeys(way, inside))
        if inside and not b.inner.beyond:
            chosen.append(b)
    return chosen


def content_blocks(blocks: list[Block], content: int | None) -> list[Block]:
    """The blocks of the page's main element, else of its articles, else of the template's content element.

    What stands in the main element beside articles, such as title and lead, belongs to it, and sibling
    articles are parts of one text. An element that only holds what is set aside is not the one that is meant.
    """
    open_ = [b for b in blocks if b.inner is not None and not b.inner.beyond]
    return (
        [b for b in open_ if b.inner.main is not None]
        or [b for b in open_ if b.inner.article is not None]
        or (_within(blocks, content) if content is not None else [])
        or [b for b in blocks if _is_slot(b)]
    )


def extract(
    page: str | None, content: int | None = None, texts: dict[int, int] | None = None, paths: dict[int, int] | None = None
) -> str:
    """Main text of a page of a host whose content element and template are known.

    ``texts`` and ``paths``: the class of each text and element path of the template. Where the template
    would leave less than it takes, the host's pages are copies of each other, of which vectors say nothing.
    """
    blocks, _ = parse(page or "")
    chosen = content_blocks(blocks, content)
    slots = [b for b in chosen if not _nested(b, texts, paths or {})] if texts else chosen
    if 2 * sum(len(b.text) for b in slots) < sum(len(b.text) for b in chosen):
        slots = chosen
    return "\n\n".join(b.text for b in slots)


def _nested(block: Block, texts: dict[int, int], paths: dict[int, int]) -> bool:
    """Whether a text lies within an element of its own class."""
    own = texts.get(_token(block))
    e = block.inner if own is not None else None
    while e is not None:
        if paths.get(e.path) == own:
            return True
        e = e.outer
    return False


def _token(block: Block) -> int:
    return xxhash.xxh64_intdigest(f"{block.inner.path if block.inner else 0}\0{block.text}") - (1 << 63)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page and token: how often it occurs, and of an element path its last name, depth, and slots' text."""
    for chunk in chunks(batches, "html"):
        rows: dict[str, list] = {k: [] for k in ("host", "token", "name", "depth", "times", "chars", "heading", "vector")}
        for host, key, page in zip(*(chunk.column(c).to_pylist() for c in ("host", "page_key", "html"))):
            blocks, elements = parse(page or "")
            chars, heading = [0] * len(elements), [0] * len(elements)
            texts: Counter = Counter()
            for b in blocks:
                if _is_slot(b):
                    texts[_token(b)] += 1
                    if b.inner is not None:
                        chars[b.inner.number] += len(b.text)
                        heading[b.inner.number] += len(b.text) * b.inner.heading
            paths: dict[int, list] = {}
            for e in reversed(elements):  # what is in an element is in the one around it
                if e.outer is not None:
                    chars[e.outer.number] += chars[e.number]
                    heading[e.outer.number] += heading[e.number]
                own = paths.setdefault(e.path, [e.name, e.depth, 0, 0, 0])
                own[2:] = own[2] + 1, own[3] + chars[e.number], own[4] + heading[e.number]
            for path, (name, depth, times, inside, title) in paths.items():
                _add(rows, host, path, name, depth, times, inside, title, key)
            for token, times in texts.items():
                _add(rows, host, token, None, 0, times, 0, 0, key)
        yield pa.record_batch(
            {
                "host": pa.array(rows["host"], pa.string()), "token": pa.array(rows["token"], pa.int64()), "name": pa.array(rows["name"], pa.string()),
                **{k: pa.array(rows[k], pa.int64()) for k in ("depth", "times", "chars", "heading", "vector")},
            }
        )


def _add(rows: dict[str, list], host: str, token: int, name: str | None, depth: int, times: int, chars: int, heading: int, key: int) -> None:
    vector = xxhash.xxh64_intdigest(b"%d %d" % (key, times)) >> 24  # 40 bits, to be summed
    for column, value in zip(rows, (host, token, name, depth, times, chars, heading, vector), strict=True):
        rows[column].append(value)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def templates(pages: DataFrame) -> DataFrame:
    """``(host, content, texts, paths)``: each host's content element, and the texts and element paths of
    its template, each followed by its class.

    An equivalence class is a set of a host's tokens with one vector; the skeleton is the class of
    the ``body`` (or outermost) element. From there the content element is the child in the
    skeleton's class that holds most of the slots' text and all headings, and so on inwards.
    The template's classes are those with texts and elements both, on ``SUPPORT`` pages or more.
    """
    tokens = pages.mapInArrow(_tokens, "host string, token long, name string, depth long, times long, chars long, heading long, vector long")
    summed = cut(
        tokens.groupBy("host", "token").agg(
            F.max("name").alias("name"),
            F.max("depth").alias("depth"),
            F.count("*").alias("pages"),
            F.sum(F.col("vector").cast("decimal(38,0)")).alias("vector"),
            F.sum("chars").alias("chars"),
            F.sum("heading").alias("heading"),
        )
    )
    skeleton = (
        summed.where("name is not null")
        .groupBy("host")
        .agg(F.max_by(F.struct("pages", "vector", "chars", "heading"), F.struct("pages", "chars", -F.col("depth"), "token")).alias("s"))
        .select("host", "s.*")
    )
    classed = summed.join(
        skeleton.withColumnsRenamed({"pages": "s_pages", "vector": "s_vector", "chars": "s_chars", "heading": "s_heading"}), "host"
    )
    content = (
        classed.where(
            f"name is not null and pages = s_pages and vector = s_vector and chars >= {CONTENT_SHARE} * s_chars and heading = s_heading"
            r" and regexp_like(name, '^(body|div|section|article|main|td|table)\\b')"
        )
        .groupBy("host")
        .agg(F.max_by("token", F.struct("depth", "token")).alias("content"))
    )
    often = summed.where(F.col("pages") >= SUPPORT).select(
        "host", F.xxhash64("pages", "vector").alias("class"), "token", F.col("name").isNull().alias("is_text")
    )
    mixed = often.groupBy("host", "class").agg(F.min("is_text").alias("some"), F.max("is_text").alias("all")).where("some <> all")
    members = often.join(mixed.select("host", "class"), ["host", "class"], "left_semi")

    def listed(which: Column) -> Column:
        held = F.sort_array(F.collect_set(F.when(which, F.struct("token", "class"))))
        return F.flatten(F.transform(held, lambda m: F.array(m["token"], m["class"])))

    template = members.groupBy("host").agg(listed(F.col("is_text")).alias("texts"), listed(~F.col("is_text")).alias("paths"))
    return cut(skeleton.select("host").join(content, "host", "left").join(template, "host", "left"))


def main_text(pages: DataFrame) -> DataFrame:
    """``pages(url, html, ...)`` with ``text``: the blocks of the main text, joined by two line ends.

    Hosts are told apart by url; pages without one share the empty host. A NULL or empty page has an
    empty text; repeated pages count as pages of their host each and get a text each; an empty table
    gives an empty one. Broken markup is read as far as it goes, and any page in time and memory that
    follow its length, however long or deeply nested. Columns other than ``html`` are kept, whatever
    their names (one called ``text`` is replaced).
    """
    html, url = F.coalesce(F.col("html").cast("string"), F.lit("")), F.col("url").cast("string")
    slim = pages.select(host_of(url).alias("host"), F.xxhash64(url, html).alias("page_key"), html.alias("html"))
    known = templates(slim)
    rest = [c for c in pages.columns if c not in ("html", "text")]
    own = [f"c{i}" for i in range(len(rest))]
    ready = pages.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(rest, own, strict=True)], html.alias("html"), host_of(url).alias("host"))
    ready = ready.join(known, "host", "left").select(*own, "html", "content", "texts", "paths")
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in ready.schema if f.name in own), "text string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, dict[int, int]] = {}

        def table(flat: list[int] | None) -> dict[int, int]:
            key = tuple(flat or ())
            if key not in known:
                if len(known) > KEPT:
                    known.clear()
                known[key] = dict(zip(key[::2], key[1::2], strict=True))
            return known[key]

        for chunk in chunks(batches, "html"):
            rows = zip(*(chunk.column(c).to_pylist() for c in ("html", "content", "texts", "paths")))
            found = [extract(page, content, table(texts), table(paths)) for page, content, texts, paths in rows]
            columns = [chunk.column(chunk.schema.get_field_index(c)) for c in own]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.string())], names=[*own, "text"])

    return ready.mapInArrow(run, schema).toDF(*rest, "text")
