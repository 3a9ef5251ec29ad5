"""Chapters from HTML pages. A tree is needed, so pages go through Python with the standard parser."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.rules import UI_KEYWORDS, UI_TAGS
from folioforge.functions.text import squeeze

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)
_SPACE = re.compile(r"\s+")
_BARE = re.compile(r"&(?!#?\w+;)")


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs=(), parent=None):
        self.tag, self.attrs, self.children, self.parent = tag, dict(attrs), [], parent

    def walk(self):
        """This element and those below it, in document order."""
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def find_all(self, *tags: str) -> list[Node]:
        return [n for n in self.walk() if n is not self and n.tag in tags]

    def strings(self) -> list[str]:
        """Texts below, without scripts and styles, trimmed, without empty ones."""
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                if node.strip():
                    out.append(node.strip())
            elif node.tag not in ("script", "style"):
                stack.extend(reversed(node.children))
        return out

    def text(self, joiner: str = " ") -> str:
        return joiner.join(self.strings())


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("")

    def handle_starttag(self, tag, attrs):
        if tag in _CLOSES_P:
            self._close("p", stop=_CLOSES_P - {"p"})
        node = Node(tag, attrs, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.at = self.at.parent

    def handle_endtag(self, tag):
        self._close(tag)

    def _close(self, tag, stop=frozenset()):
        node = self.at
        while node is not None and node.tag != tag and node.tag not in stop:
            node = node.parent
        if node is not None and node.tag == tag:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str, *, whole: bool = False) -> Node:
    """The tree. With ``whole`` a character reference without its semicolon, as of a text cut short, stays as it is."""
    builder = _Builder()
    builder.feed(_BARE.sub("&amp;", html or "") if whole else html or "")
    builder.close()
    return builder.root


def squeezed(text: str) -> str:
    return _SPACE.sub(" ", text).strip()


def select_one(root: Node, selector: str) -> Node | None:
    """First element of a selector "tag", ".class", "#id", "tag.class", or such parts one below the other."""
    found = [root]
    for part in selector.split():
        m = re.fullmatch(r"([\w-]*)((?:[.#][\w-]+)*)", part)
        if not m:
            return None
        tag, marks = m[1], re.findall(r"([.#])([\w-]+)", m[2])

        def fits(n: Node, tag=tag, marks=marks) -> bool:
            classes = (n.attrs.get("class") or "").split()
            return (not tag or n.tag == tag) and all(v in classes if k == "." else n.attrs.get("id") == v for k, v in marks)

        found = [n for top in found for n in top.walk() if n is not top and fits(n)]
    return found[0] if found else None


def find_heading(root: Node) -> Node | None:
    """The first h1, then h2, that says "chapter"; else the first of either."""
    heads = [*root.find_all("h1"), *root.find_all("h2")]
    named = [h for h in heads if "chapter" in h.text().lower()]
    either = root.find_all("h1", "h2")
    return named[0] if named else either[0] if either else None


def title_and_number(heading: str, expected: int | None = None) -> tuple[str, int | None]:
    m = re.search(r"Chapter\s+(\d+)", heading, re.IGNORECASE)
    return heading, int(m[1]) if m else expected


def is_ui(node: Node) -> bool:
    marks = f"{node.attrs.get('id') or ''} {node.attrs.get('class') or ''}".lower()
    return node.tag in UI_TAGS or any(k in marks for k in UI_KEYWORDS)


def _loose(node: Node) -> list[str]:
    chunks = (c.strip() for c in node.text("\n").split("\n"))
    return [squeezed(c) for c in chunks if len(c) >= 2]


def paragraphs_of(node: Node) -> list[str]:
    """Texts of the <p> elements; without any, the lines of the text with two characters or more."""
    ps = node.find_all("p")
    if not ps:
        return _loose(node)
    return [t for t in (squeezed(p.text()) for p in ps) if t]


def body(root: Node, heading: Node | None, selectors: tuple[str, ...], least: int = 200) -> list[str]:
    """A selector's element with enough text; else, without heading, the longest block that has and is no
    page furniture; else what follows the heading up to page furniture."""
    for selector in selectors:
        node = select_one(root, selector)
        if node is not None:
            found = paragraphs_of(node)
            if len(" ".join(found)) > least:
                return found
    if heading is None:
        blocks = sorted(root.find_all("article", "section", "div"), key=lambda n: -len(n.text()))
        for node in blocks[:5]:
            found = [] if is_ui(node) else paragraphs_of(node)
            if len(" ".join(found)) > least:
                return found
        return []
    out, beside = [], heading.parent.children
    place = next(i for i, n in enumerate(beside) if n is heading)
    for node in beside[place + 1 :]:
        if isinstance(node, str):
            if node.strip():
                out.append(squeezed(node))
        elif is_ui(node):
            break
        elif node.tag != "p" and not node.find_all("p"):
            out += _loose(node)
        else:
            out += [squeezed(node.text())] if node.tag == "p" else paragraphs_of(node)
    return [p for p in out if len(p) > 1]


def extract_chapters(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html", selectors: tuple[str, ...] = ("article.chapter",), least: int = 200, whole: bool = False) -> DataFrame:
    """id, heading, number, paragraphs, is_short for every page; ``whole`` as in ``parse``. Only the HTML goes to Python; ids of any type stay as they are."""

    def chapters(pages: pa.Array) -> pa.Array:
        rows = []
        for html in pages.to_pylist():
            root = parse(html, whole=whole)
            heading = find_heading(root)
            title, number = title_and_number(squeezed(heading.text())) if heading is not None else (None, None)
            found = body(root, heading, selectors, least)
            rows.append({"heading": title, "number": number, "paragraphs": found, "is_short": len("\n\n".join(found)) < least})
        return pa.array(rows, type=pa.struct([("heading", pa.string()), ("number", pa.int64()), ("paragraphs", pa.list_(pa.string())), ("is_short", pa.bool_())]))

    read = F.arrow_udf(chapters, "heading string, number long, paragraphs array<string>, is_short boolean")
    return pages.select(F.col(id_col), read(F.col(html_col)).alias("_chapter")).select(id_col, "_chapter.*")


def marked_text(part: Column) -> Column:
    """Text of a part of a page: tags are cut, the references of HTML's own signs read, spaces squeezed; JVM side."""
    bare = F.regexp_replace(part, "<[^>]+>", "")
    for name, sign in (("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        bare = F.replace(bare, F.lit(f"&{name};"), F.lit(sign))
    return F.regexp_replace(F.regexp_replace(bare, r"[\t\n\f\r ]+", " "), r"\A\p{Zs}+|\p{Zs}+\z", "")


def marked_chapters(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html", least: int = 200) -> DataFrame:
    """id, heading, number, paragraphs, is_short by marks alone, JVM side: the first h1, and from the first article what begins with <p> and
    ends with </p> or the next. For pages of a known build; an article without end has no paragraphs, unlike in ``extract_chapters``."""
    part = lambda tag: F.regexp_extract(html_col, rf"(?is)<{tag}(?![0-9A-Za-z_])[^>]*>(.*?)</{tag}>", 1)
    pieces = F.split(F.coalesce(part("article"), F.lit("")), r"(?i)<p(?![0-9A-Za-z_])[^>]*>", -1)
    texts = F.transform(F.slice(pieces, 2, F.size(pieces)), lambda x: marked_text(F.regexp_replace(x, r"(?is)</p>.*", "")))
    found = pages.select(id_col, marked_text(part("h1")).alias("heading"), F.filter(texts, lambda x: F.length(x) > 1).alias("paragraphs"))
    number = F.nullif(F.regexp_extract("heading", r"(?i)Chapter[\t\n\f\r ]+([0-9]+)", 1), F.lit("")).try_cast("long")
    return found.select(id_col, "heading", number.alias("number"), "paragraphs", (F.length(F.array_join("paragraphs", "\n\n")) < least).alias("is_short"))


def visible_text(html: Column) -> Column:
    """Text without comments, scripts, styles and tags; JVM side."""
    bare = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", " ")
    return squeeze(F.regexp_replace(bare, r"(?s)<[^>]+>", " "))


def total_count(html: Column) -> Column:
    """Number before the word "Chapters", else the first number near it."""
    text = visible_text(html)
    first = F.regexp_extract(text, r"(?i)(\d{1,5})\s+Chapters\b", 1)
    near = F.regexp_extract(text, r"(?i)Chapters\D{0,20}(\d{1,5})", 1)
    return F.coalesce(F.nullif(first, F.lit("")), F.nullif(near, F.lit(""))).try_cast("int")


def first_heading(html: Column) -> Column:
    """Text of the first h1; JVM side, for pages whose headings hold no blocks."""
    raw = F.regexp_extract(html, r"(?is)<h1\b[^>]*>(.*?)</h1>", 1)
    return squeeze(F.regexp_replace(raw, r"<[^>]+>", " "))


def chapter_number(heading: Column, expected: Column | None = None) -> Column:
    found = F.nullif(F.regexp_extract(heading, r"(?i)Chapter\s+(\d+)", 1), F.lit("")).try_cast("int")
    return found if expected is None else F.coalesce(found, expected)
