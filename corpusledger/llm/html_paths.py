"""HTML extraction by consensus of a host's pages on the path of the main text.

1. Every page's containers are scored by the text of their blocks, without links and boilerplate,
   and the page votes for its best container's generalised path: tags with their classes, digits
   taken out, from the root down.
2. Spark adds up the votes per host and path and joins them with the paths that have text on each
   page. Pages of a host with the same paths share a signature, so the join sees each set once.
3. Every page is extracted again: from its elements on the path with most votes of the host that has
   text on the page, or from its own best container where none has.

Boilerplate is marked by tag, role and words in classes and ids. A mark is undone only over a wrapper of
the article: what holds ``main``; what holds an article or something named as one, or is named as a
wrapper itself, and covers most of the page's unlinked text; a form of prose rather than controls. While an
article, or something named as one, has text outside of marks, no other mark is undone, however much
longer a sidebar, notice or menu is; and a page with comments, adverts or cookie notices alone has no text.
Words after has-, no- or with- mark nothing. A marked path has a key of its own, so the votes of pages
that undid the mark count for pages that did not.

Articles side by side in one ``main`` are one text if the others are not much shorter than the best.

A page that is odd by itself (a long notice, a short article) thus follows its host. All votes count,
however many paths a host has. Paths travel as digests of host and path.

Defined cases: null or empty html gives an empty text; a null or odd url belongs to the host of no
name; pages are handled row by row, so repeated rows and null ids stay as they are; nesting may be of any
depth; unclosed and
misnested tags are closed as browsers do in the common cases; tags and quotes that never end take time
in proportion to the page, as all else does; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusledger.llm.common import staged

# What HTML elements are; the page itself is the container without a name.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object select".split())
DROPPED = frozenset("nav footer aside form button dialog menu fieldset label figure audio video canvas".split())
CONTAINERS = frozenset("html body main article section div td center blockquote details".split()) | {""}
BLOCKS = CONTAINERS - {""} | DROPPED | frozenset(
    "header address dd dl dt figcaption h1 h2 h3 h4 h5 h6 head hr li ol p pre table tbody tfoot thead tr th ul"
    " caption summary hgroup".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu".split())
#: Words in classes and ids that mark what is not the article.
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie"
    " cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup"
    " login sidebar sidebars aside rail widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs"
    " footer foot header masthead share sharing social related recommended recommendations comment comments"
    " commentlist disqus respond reply replies reviews testimonials form search pagination pager copyright legal hidden".split()
)
#: Words that mark the article.
ARTICLE = frozenset("article content entry main post story text body".split())
#: Words that also name how a page is laid out; a wrapper may bear them.
LAYOUT = frozenset(
    "aside sidebar sidebars rail widget widgets menu menus nav navbar navigation header masthead banner footer foot"
    " form search notice notices modal overlay share sharing social legal hidden".split()
)
#: Names that say an element wraps others, if no boilerplate word is in the same name.
WRAPPERS = frozenset("page wrap wrapper container site layout outer root".split())
MODIFIERS = frozenset("has no with without not hide".split())
CONTROLS = frozenset("input select textarea button".split())
#: How sure a mark is. On a wrapper, one by layout is undone over so many times the unmarked text, one by
#: another word where no text is unmarked; both over so much text at least.
BY_LAYOUT, BY_WORD, BY_TAG = 1, 2, 3
TIMES, LEAST = 3, {BY_LAYOUT: 80, BY_WORD: 200}
#: Characters of prose per control (and one) that make a form text.
PROSE = 100
#: An article's share of the best one's text from which it belongs to the same text.
SIBLING = 0.25
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
}
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"[>\"']")
_RAW_END = {tag: re.compile(rf"</{tag}\b", re.I) for tag in RAW}
_ATTRIBUTE = re.compile(
    r"(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))|\b(hidden)\b", re.S
)
_REFERENCE = re.compile(r"&#(?:0*+([0-9]{8,})|[xX]0*+([0-9a-fA-F]{7,}));?")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class _Element:
    __slots__ = (
        "tag", "step", "key", "parent", "holder", "dropped", "inside", "score", "mark", "near", "story", "form",
        "controls", "named", "article", "wrapper",
    )

    def __init__(self, tag, step, key, parent, dropped, inside, mark=0, story=0):
        self.tag, self.step, self.key, self.parent = tag, step, key, parent
        self.dropped, self.inside, self.score = dropped, inside, 0.0
        #: How sure it is boilerplate; the next marked element; 1 in an article, 2 in main, below that mark.
        self.mark, self.near, self.story = mark, None, story
        self.form = self if tag == "form" else parent and parent.form
        self.controls, self.named = 0, False
        #: Whether it or what it is in is an article or named as one, and whether it is named a wrapper.
        self.article, self.wrapper = parent is not None and parent.article, False
        #: The next container, this element included.
        self.holder = self if tag in CONTAINERS else parent.holder

    @property
    def path(self) -> str:
        """The steps from the root down; ``key`` is the digest of host and path."""
        steps, element = [], self
        while element.parent is not None:
            steps.append(element.step)
            element = element.parent
        return ">".join(reversed(steps))


def _digest(*parts: bytes) -> bytes:
    return blake2b(b"".join(parts), digest_size=16).digest()


def _marks(names: str) -> tuple[set[str], bool, bool, bool]:
    """Boilerplate words of the names, whether there are article words, and names with these, or with
    wrapper words, alone."""
    marks, article, alone, wrapper = set(), False, False, False
    for name in names.split():
        parts = []
        for part in _NAME_PARTS.findall(name):
            if part.lower() in MODIFIERS:
                break
            parts.append(part.lower())
        own = BOILERPLATE.intersection(parts)
        marks |= own
        article = article or not ARTICLE.isdisjoint(parts)
        alone = alone or not own and not ARTICLE.isdisjoint(parts)
        wrapper = wrapper or parts[-1:] == ["layout"] or not own and not WRAPPERS.isdisjoint(parts)
    return marks, article, alone, wrapper


class _Tags:
    """Where the tags of a page end, each character looked at a bounded number of times.

    Quotes hide a ``>``. Where one that is not closed follows, the tag ends at the next ``>`` all the
    same; quotes from which a walk came to nothing are remembered, as any other walk does there too.
    """

    def __init__(self, page: str) -> None:
        self.page, self.last, self.dead = page, page.rfind(">"), set()

    def end(self, at: int) -> int:
        """The place of the ``>`` of the tag whose name ends at ``at``; there is one behind it."""
        walked, place = [], at
        while stop := _STOP.search(self.page, place):
            place = stop.start()
            if stop[0] == ">":
                return place
            closed = -1 if place in self.dead else self.page.find(stop[0], place + 1)
            walked.append(place)
            if closed < 0:
                break
            place = closed + 1
        self.dead.update(walked)
        return self.page.find(">", at)

    def next(self, at: int) -> tuple[int, int, re.Match | None] | None:
        """The next tag, comment or declaration: its start, its end, and a tag's name."""
        page = self.page
        while (start := page.find("<", at)) >= 0:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, end + 3 if end >= 0 else len(page), None
            if page.startswith(("<!", "<?"), start):
                end = page.find(">", start + 2)
                return start, end + 1 if end >= 0 else len(page), None
            if start < self.last and (name := _TAG.match(page, start)):
                return start, self.end(name.end()) + 1, name
            at = start + 1
        return None

    def raw_end(self, tag: str, at: int) -> int:
        """The end of an element whose content is no markup."""
        ended = _RAW_END[tag].search(self.page, at)
        end = self.page.find(">", ended.end()) if ended else -1
        return end + 1 if end >= 0 else len(self.page)


def _plain(raw: str) -> str:
    """Character references decoded; a number beyond all characters stands for an unknown one."""

    def small(match):
        decimal, hexadecimal = match.groups()
        number = decimal or hexadecimal
        value = 0x110000 if len(number) > 10 else int(number, 10 if decimal else 16)
        return "\ufffd" if value >= 0x110000 else f"&#{value};"

    if "&" not in raw:
        return raw
    return entities.unescape(_REFERENCE.sub(small, raw) if "&#" in raw else raw)


def _described(tag: str, attributes: str, parent: _Element) -> _Element:
    """The element with its generalised path, and whether it is boilerplate."""
    classes, names, hidden, role = "", "", False, ""
    if attributes.strip():
        for name, *values, bare in _ATTRIBUTE.findall(attributes):
            value = "".join(values)
            name = (name or bare).lower()
            if name == "class":
                classes, names = value, f"{names} {value}"
            elif name == "id":
                names += " " + value
            elif name == "role" and value.strip().lower() in ROLES:
                role = value.strip().lower()
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                hidden = True
            elif name == "style" and "display:none" in value.replace(" ", "").lower():
                hidden = True
    marks, article, alone, wrapper = _marks(names)
    inside = parent.inside or tag in ("article", "main")
    story = 2 if tag == "main" else max(1, parent.story) if tag == "article" and not marks else parent.story
    if tag in ("html", "body", "main", "article"):
        marks = set()
    elif inside or article:
        marks -= {"header", "banner"}
    if tag == "form":
        marks.discard("form")
    mark = 0
    if tag in DROPPED and tag not in ("form", "fieldset") or role and role not in ("form", "search"):
        mark = BY_TAG
    elif marks - LAYOUT and not alone:
        mark = BY_WORD
    elif marks or role or tag in ("form", "fieldset") or tag == "header" and not inside:
        mark = BY_LAYOUT
    if mark:
        story = 2 if tag == "main" else 1 if tag == "article" else 0
    step = ".".join([tag, *sorted({re.sub(r"\d+", "0", c) for c in classes.lower().split()})])
    told = f"{step}\n{role} {' '.join(sorted(marks))}" if marks or role else step
    key = _digest(parent.key, told.encode("utf-8", "surrogatepass"))
    element = _Element(tag, step, key, parent, parent.dropped or hidden, inside, mark, story)
    element.near, element.named = element if mark else parent.near, bool(marks or role)
    element.article = not mark and (parent.article or tag in ("article", "main") or alone)
    element.wrapper = wrapper or alone
    return element


def _settle(elements: list[_Element], blocks: list) -> None:
    """Undo the marks that cover the page's text."""

    def weighed():
        net, stories, named = Counter(), {}, set()
        for element, text, linked in blocks:
            worth = max(0, len(text) - 2 * linked)
            if worth:
                net[element.near] += worth
                stories[element.near] = max(element.story, stories.get(element.near, 0))
                if element.article:
                    named.add(element.near)
        return net, stories, named

    def marked(element):
        while element is not None:
            yield element
            element = element.parent and element.parent.near

    def undo(undone):
        for element in undone:
            element.mark = 0
        for element in elements:  # parents come first
            element.near = element if element.mark else element.parent.near

    net, stories, named = weighed()
    if not any(element is not None for element in net):
        return
    undone = {above for element, story in stories.items() if element and story == 2 for above in marked(element)}
    for form, worth in net.items():
        plain = form is not None and form.tag == "form" and form.mark == BY_LAYOUT and not form.named
        if plain and worth >= PROSE * (form.controls + 1):
            undone.add(form)
    if undone:
        undo(undone)
        net, stories, named = weighed()
    rest = net.pop(None, 0)
    total = net.total()
    if not net or None in named:
        return
    element, worth = net.most_common(1)[0]
    chain = list(marked(element))
    sure = max(above.mark for above in chain)
    wraps = stories[element] or element in named or element.tag == "form" or all(above.wrapper for above in chain)
    if not wraps:
        return
    if sure == BY_LAYOUT and stories[element]:
        enough = worth > rest
    elif sure == BY_LAYOUT:
        # A form that is no prose by its controls is text only if there is no other.
        enough = (not rest if element.tag == "form" else worth > TIMES * rest) and worth >= LEAST[sure]
    else:
        enough = sure == BY_WORD and not rest and worth >= LEAST[sure]
    if enough and 2 * worth >= total:
        undo(chain)


def parse(page: str, host: str = "") -> list[tuple[_Element, str, int]]:
    """The page's blocks of text in order, boilerplate too: (element, text, characters inside links)."""
    root = _Element("", "", _digest(host.encode("utf-8", "surrogatepass")), None, False, False)
    stack, blocks, text, linked = [root], [], [], 0
    elements: list[_Element] = []
    #: How many of each tag are open, so that a stray end tag costs nothing.
    opened: Counter = Counter()
    links = 0

    def end_block():
        nonlocal text, linked
        if text:
            whole = " ".join("".join(text).split())
            if whole:
                blocks.append((stack[-1], whole, linked))
        text, linked = [], 0

    def add(raw: str):
        nonlocal linked
        if raw and not stack[-1].dropped:
            plain = _plain(raw)
            text.append(plain)
            if links:
                linked += len(plain.strip())

    def pop() -> str:
        tag = stack.pop().tag
        opened[tag] -= 1
        return tag

    def close(tag: str):
        if opened[tag]:
            end_block()
            while pop() != tag:
                pass

    at, tags = 0, _Tags(page)
    while found := tags.next(at):
        start, end, name = found
        add(page[at:start])
        at = end
        if name is None:
            continue
        slash, tag, attributes = name[1], name[2].lower(), page[name.end():end - 1]
        if tag in CONTROLS and not slash and stack[-1].form and "hidden" not in attributes:
            stack[-1].form.controls += 1
        if tag == "br":
            add(" ")
        elif slash:
            if tag == "a":
                links = max(0, links - 1)
            elif tag == "p" and not opened["p"]:
                end_block()
            elif tag in BLOCKS:
                close(tag)
        elif tag in RAW:
            if not attributes.endswith("/"):
                at = tags.raw_end(tag, at)
            if tag in ("textarea", "select", "iframe"):
                add(" ")
        elif tag == "a":
            links += 1
        elif tag in BLOCKS:
            end_block()
            if stack[-1].tag == "p":
                pop()
            shut = CLOSED_BY.get(tag)
            while shut and stack[-1].tag in shut:
                pop()
            if tag not in VOID:
                stack.append(_described(tag, attributes, stack[-1]))
                elements.append(stack[-1])
                opened[tag] += 1
                links = 0
        elif tag in ("td", "th", "option"):
            add(" ")
    add(page[at:])
    end_block()
    _settle(elements, blocks)
    return blocks


def _containers(blocks) -> list[_Element]:
    """Scored containers: a block's unlinked text counts for its container and half for the next."""
    found: dict[int, _Element] = {}
    for element, text, linked in blocks:
        if element.near is not None:
            continue
        worth, part, at = max(0, len(text) - 2 * linked), 1.0, element.holder
        while at is not None and part > 0.2:
            bonus = 1.5 if at.tag in ("article", "main") else 1.0
            found[id(at)] = at
            at.score += worth * part * bonus
            part /= 2
            at = at.parent and at.parent.holder
    return list(found.values())


def _best(blocks) -> _Element | None:
    """The page's own best container, the first of equals; ``main`` for its articles of several kinds."""
    found = _containers(blocks)
    best = max(found, key=lambda e: e.score, default=None)
    if best is None or best.score <= 0:
        return None
    main = best.parent and best.parent.holder
    if best.tag == "article" and main is not None and main.tag == "main":
        for other in found:
            beside = other.tag == "article" and other is not best and other.parent.holder is main
            if beside and other.key != best.key and other.score >= SIBLING * best.score:
                return main
    return best


def best_path(page: str) -> tuple[str, float] | None:
    """The path a page votes for, with its score; None without text outside of boilerplate."""
    best = _best(parse(page))
    return best and (best.path, best.score)


def present(blocks) -> list[bytes]:
    """The keys of all containers that have text on the page, not below a mark inside them."""
    seen, keys = set(), set()
    for element, _, _ in blocks:
        while element is not None and id(element) not in seen:
            seen.add(id(element))
            if element.tag in CONTAINERS:
                keys.add(element.key)
            element = None if element.mark else element.parent
    return sorted(keys)


def main_text(page: str, keys: list[bytes], host: str = "") -> tuple[str, str | None]:
    """The text under the first of ``keys`` that has some, or under the page's own best container."""
    blocks = parse(page, host)
    own = _best(blocks)
    for key in [*keys, *([own.key] if own else [])]:
        under, path = _under(blocks, key)
        if under:
            return "\n\n".join(under), path
    return "", None


def _under(blocks, key: bytes) -> tuple[list[str], str | None]:
    """The texts under elements with the key, not below a mark inside them, and their path."""
    known: dict[int, bool] = {}
    texts, path = [], None
    for element, text, _ in blocks:
        passed, at = [], element
        while at is not None and id(at) not in known and at.key != key:
            passed.append(id(at))
            at = None if at.mark else at.parent
        hit = at is not None and known.get(id(at), True)
        known.update(dict.fromkeys(passed, hit))
        if hit:
            path = at.path if path is None else path
            texts.append(text)
    return texts, path


def host_of(url: str = "url"):
    address = F.lower(F.coalesce(F.col(url), F.lit("")))
    return F.regexp_extract(address, r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)


def _signed(blocks) -> tuple[bytes, list[bytes]]:
    keys = present(blocks)
    return _digest(*keys), keys


def _vote(batches):
    """A row with a path per vote; per new signature, rows with the keys it stands for."""
    known = set()
    for batch in batches:
        keys, paths, signatures = [], [], []
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
            blocks = parse(page.as_py() or "", host)
            best = _best(blocks)
            if best:
                keys.append(best.key)
                paths.append(best.path)
                signatures.append(None)
            signature, own = _signed(blocks)
            if signature not in known:
                known.add(signature)
                keys += own
                paths += [None] * len(own)
                signatures += [signature] * len(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(paths, pa.string()), pa.array(signatures, pa.binary())],
            names=["key", "path", "signature"],
        )


def chosen(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(signature, key): of the paths present on pages with a signature, the one most pages of the host chose."""
    cast = staged(
        pages.select(host_of(url).alias("host"), F.col(html)).mapInArrow(
            _vote, "key binary, path string, signature binary"
        ),
        "votes",
    )
    votes = staged(
        cast.where(F.col("path").isNotNull()).groupBy("key").agg(
            F.count(F.lit(1)).alias("pages"), F.min("path").alias("path")
        ),
        "counted",
    )
    held = cast.where(F.col("path").isNull()).select("signature", "key").distinct()
    order = F.struct(-F.col("pages"), F.length("path"), "path", "key")
    best = held.join(votes, "key").groupBy("signature").agg(F.min(order).alias("best"))
    return best.select("signature", "best.key")


def extract(pages: DataFrame, identity: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(identity, url, text, n_chars, host, path) of every page."""
    best = staged(chosen(pages, url, html), "paths")
    best = best.select(F.col("signature").alias("__signature"), F.col("key").alias("__key"))
    rows = pages.select(F.col(identity), F.col(url), host_of(url).alias("__host"), F.col(html).alias("__html"))
    kind = f"{identity} {dict(pages.dtypes)[identity]}, {url} string"
    schema = f"{kind}, text string, n_chars bigint, host string, path string"

    def sign(batches):
        for batch in batches:
            signatures = [
                _signed(parse(page.as_py() or "", host))[0]
                for host, page in zip(batch.column(2).to_pylist(), batch.column(3))
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(signatures, pa.binary())], names=[*batch.schema.names, "__signature"]
            )

    def again(batches):
        for batch in batches:
            found = [
                main_text(page.as_py() or "", [key] if key else [], host)
                for host, page, key in zip(batch.column(2).to_pylist(), batch.column(3), batch.column(4).to_pylist())
            ]
            texts = [text for text, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(text) for text in texts], pa.int64()), batch.column(2),
                 pa.array([path for _, path in found], pa.string())],
                names=[identity, url, "text", "n_chars", "host", "path"],
            )

    signed = rows.mapInArrow(sign, f"{kind}, __host string, __html string, __signature binary")
    joined = signed.join(best, "__signature", "left").drop("__signature")
    return staged(joined.mapInArrow(again, schema), "extracted")
