"""Scalar text functions as Column expressions (JVM side, no Python rows)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioforge.functions.rules import ACCENT_PAIRS, PUNCTUATION, SKIP_LINES, UI_KEYWORDS, UI_TAGS

SPACE = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
CJK = r"[\x{4e00}-\x{9fff}\x{3400}-\x{4dbf}]+"


#: The characters of SPACE one by one, for trims.
BLANKS = "".join(chr(i) for i in [*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])


def strip(c: Column) -> Column:
    """Both ends without Unicode white space; Spark's trim alone knows only the space."""
    return F.btrim(c, F.lit(BLANKS))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(BLANKS))


def squeeze(c: Column) -> Column:
    """White space runs become one space, ends are cut."""
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def lines(c: Column) -> Column:
    """Lines without their ends: all Unicode line ends count, a closing one opens no further line."""
    cut = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
    parts = F.split(F.coalesce(c, F.lit("")), cut, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def slugify(c: Column, most: int = 40) -> Column:
    """Upper-case ASCII letters and digits joined by "_", cut to ``most``; nothing else survives."""
    joined = F.regexp_replace(strip(c), "[^A-Za-z0-9]+", "_")
    return F.substring(F.upper(F.regexp_replace(joined, "^_+|_+$", "")), 1, most)


def strip_accents(c: Column) -> Column:
    """Letters of any script without their marks, and no combining marks."""
    return F.regexp_replace(F.translate(c, *ACCENT_PAIRS), r"\p{Mn}+", "")


def normalize_punctuation(c: Column) -> Column:
    """Typographic quotes, dashes and spaces become ASCII; "..." for the ellipsis; byte-order marks go."""
    single = {k: v for k, v in PUNCTUATION.items() if len(v) == 1}
    out = F.translate(c, "".join(single), "".join(single.values()))
    for k, v in PUNCTUATION.items():
        if len(v) != 1:
            out = F.replace(out, F.lit(k), F.lit(v))
    return out


def strip_bom(c: Column) -> Column:
    return F.regexp_replace(c, r"^\x{feff}", "")


def remove_cjk(c: Column) -> Column:
    return F.regexp_replace(c, CJK, "")


def drop_ellipsis_paragraphs(c: Column, separator: str = "\n\n") -> Column:
    """Without paragraphs of three or more dots, ellipses or middle dots and nothing else."""
    kept = F.filter(F.split(c, separator, -1), lambda p: ~strip(p).rlike(r"^[.…·。]{3,}\n?$"))
    return F.array_join(kept, separator)


def rewrite(c: Column, rules: list[tuple[str, str]]) -> Column:
    """Regex rules one after the other; a later one sees what an earlier one wrote."""
    for pattern, replacement in rules:
        c = F.regexp_replace(c, pattern, replacement)
    return c


def cleanup_paragraph(c: Column, rules: list[tuple[str, str]] = (), separator: str = "\n\n") -> Column:
    """CJK, ellipsis paragraphs, rules, runs of spaces and of blank lines, ends: in this order."""
    out = rewrite(drop_ellipsis_paragraphs(remove_cjk(c), separator), rules)
    return strip(F.regexp_replace(F.regexp_replace(out, " {2,}", " "), r"\n{3,}", "\n\n"))


def drop_bracketed_notes(c: Column, words: list[str]) -> Column:
    """Without bracketed remarks that hold one of the words, in either case, and the space before them."""
    any_of = "|".join(words)
    return F.regexp_replace(c, rf"(?iu)\s*[（(][^）)]*?(?:{any_of})[^）)]*?[）)]", "")


def numbered_title(text: Column, file_name: Column, word: str = r"Cap[ií]tulo", label: str = "Capítulo") -> Column:
    """struct(number, title): the first of ten lines with "word N: title", else the number in the file name.

    Without a title of its own the title is "label N"; without a number both are null.
    """
    pattern = rf"(?iu){word}\s+(\d+)(?::|\s+)?\s*(.*)"
    head = F.transform(F.slice(F.split(F.coalesce(text, F.lit("")), "\n", -1), 1, 10), strip)
    hit = F.get(F.filter(head, lambda x: x.rlike(pattern)), F.lit(0))
    inside = F.regexp_extract(hit, pattern, 1)
    named = F.regexp_extract(file_name, r"(?:^|cn_)(\d+)(?:_es)?", 1)
    number = F.coalesce(F.try_to_number(F.nullif(inside, F.lit("")), F.lit("999999999999")), F.try_to_number(F.nullif(named, F.lit("")), F.lit("999999999999"))).cast("long")
    title = F.nullif(strip(F.regexp_extract(hit, pattern, 2)), F.lit(""))
    return F.struct(number.alias("number"), F.coalesce(title, F.concat(F.lit(f"{label} "), number.cast("string"))).alias("title"))


def escape_html(c: Column) -> Column:
    """&, < and > only; quotes stay."""
    out = F.replace(c, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(out, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def to_latin1(c: Column) -> Column:
    """Characters beyond Latin-1 become "?"."""
    return F.regexp_replace(c, r"[^\x{00}-\x{ff}]", "?")


def accent_insensitive(phrase: str) -> str:
    """A pattern for the phrase in which vowels match with and without acute accent, in either case."""
    classes = {}
    for plain, marked in zip("aeiou", "áéíóú", strict=True):
        classes[plain] = classes[marked] = f"[{plain}{marked}]"
    return "(?iu)" + "".join(classes.get(ch) or (ch if ch.isalnum() or ch == "_" or ord(ch) > 127 else "\\" + ch) for ch in phrase)


def strip_possessive(c: Column) -> Column:
    return F.regexp_replace(c, "['’]s$", "")


def is_entity(c: Column) -> Column:
    """Longer than two characters and begins in upper case."""
    return (F.length(c) > 2) & c.rlike(r"^\p{Lu}")


def html_paragraphs(c: Column) -> Column:
    """The lines after the first, trimmed, without blank ones, each as a <p> element."""
    body = F.filter(F.transform(F.slice(lines(c), 2, F.greatest(F.size(lines(c)), F.lit(1))), strip), lambda x: x != "")
    return F.array_join(F.transform(body, lambda x: F.concat(F.lit("<p>"), x, F.lit("</p>"))), "")


def keyword_contexts(c: Column, keyword: str, width: int = 100, most: int = 3) -> Column:
    """struct(n, contexts): how often a keyword occurs, in either case, and the first contexts of it.

    A context has ``width`` characters on either side; line ends become spaces. Places come from the
    lengths of the pieces between matches.
    """
    pattern = "(?iu)" + re.escape(keyword)
    pieces = F.split(c, pattern, -1)
    found = F.regexp_extract_all(c, F.lit(pattern), F.lit(0))
    n = F.size(found)

    def place(i: Column) -> Column:
        before = F.aggregate(F.slice(pieces, 1, i + 1), F.lit(0), lambda s, p: s + F.length(p))
        return before + F.aggregate(F.slice(found, 1, i), F.lit(0), lambda s, p: s + F.length(p))

    def context(i: Column) -> Column:
        start = F.greatest(place(i) - width, F.lit(0))
        end = place(i) + F.length(F.get(found, i)) + width
        return F.regexp_replace(F.substring(c, start + 1, end - start), "\n", " ")

    first = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.least(n, F.lit(most)) - 1), context))
    return F.struct(n.alias("n"), F.coalesce(first, F.array().cast("array<string>")).alias("contexts"))


def json_in_text(c: Column) -> Column:
    """Map of the string members of the first JSON object in a text, fences or prose around it or not.

    Objects may nest once; members that aren't strings are dropped. Null where nothing parses.
    """
    bare = F.regexp_replace(c, r"```(?:json)?", "")
    body = F.regexp_extract(bare, r"(?s)\{(?:[^{}]|\{[^{}]*\})*\}", 0)
    parsed = F.from_json(F.nullif(body, F.lit("")), "map<string,variant>")
    strings = F.map_filter(parsed, lambda k, v: F.schema_of_variant(v) == "STRING")
    return F.transform_values(strings, lambda k, v: F.try_variant_get(v, "$", "string"))


def retry_delay(c: Column, default: float = 30.0, least: float = 10.0) -> Column:
    """Seconds that an error message asks to wait: "retry in N", else "retryDelay ... 'Ns'"."""
    first = F.regexp_extract(c, r"retry in ([\d.]+)s", 1)
    second = F.regexp_extract(c, r"retryDelay[^\d]*(\d+)s", 1)
    asked = F.coalesce(F.nullif(first, F.lit("")), F.nullif(second, F.lit(""))).try_cast("double")
    return F.greatest(F.coalesce(asked, F.lit(default)), F.lit(least))


def drop_suffix_number(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)_\d+\b", "")


def is_split_part(c: Column) -> Column:
    """Whether "(2)" to "(9)" stands in the first fifteen lines."""
    return F.array_join(F.slice(lines(c), 1, 15), "\n").rlike(r"\([2-9]\)")


def drop_lines_with(c: Column, *literals: str) -> Column:
    def clean(x: Column) -> Column:
        keep = F.lit(True)
        for literal in literals:
            keep = keep & ~F.contains(x, F.lit(literal))
        return keep

    return F.array_join(F.filter(F.split(c, "\n", -1), clean), "\n")


def map_segments(c: Column, mapping: dict[str, str]) -> Column:
    """Every segment between "_" replaced by the mapping, else kept."""
    if not mapping:
        return c
    held = F.create_map(*(F.lit(x) for kv in mapping.items() for x in kv))
    return F.array_join(F.transform(F.split(c, "_", -1), lambda s: F.coalesce(F.try_element_at(held, s), s)), "_")


def is_ui_block(tag: Column, attributes: Column) -> Column:
    """Whether an element is navigation or the like: by its tag, or a keyword anywhere in id and classes."""
    hit = tag.isin(*UI_TAGS)
    for word in UI_KEYWORDS:
        hit = hit | F.contains(F.lower(F.coalesce(attributes, F.lit(""))), F.lit(word))
    return hit


def is_skipped_line(line: Column) -> Column:
    hit = F.lit(False)
    for pattern in SKIP_LINES:
        hit = hit | line.rlike(pattern)
    return hit


def total_length(paragraphs: Column) -> Column:
    return F.aggregate(paragraphs, F.lit(0).cast("long"), lambda s, p: s + F.length(p))


def is_short(body: Column, least: int = 200) -> Column:
    return F.length(body) < least


def split_paragraphs(c: Column, separator: str = "\n\n") -> Column:
    """Paragraphs, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(c, separator, -1), strip), lambda p: p != "")


def truncate(c: Column, most: int) -> Column:
    return F.substring(c, 1, most)
