"""Writers: chapter texts, JSON Lines, combined texts, EPUB files, the reader's index."""

from __future__ import annotations

import io
import zipfile
from html import escape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def chapter_text(title: Column, paragraphs: Column) -> Column:
    """Title, blank line, paragraphs with blank lines between, line end."""
    return F.concat(title, F.lit("\n\n"), F.array_join(paragraphs, "\n\n"), F.lit("\n"))


def chapter_text_spaced(title: Column, paragraphs: Column) -> Column:
    """The form with three line ends and more after the title: title and an empty paragraph lead the list."""
    return F.concat(F.array_join(F.concat(F.array(title, F.lit("")), paragraphs), "\n\n"), F.lit("\n"))


def append_json_lines(df: DataFrame, folder: str) -> None:
    df.write.mode("append").json(folder)


def combined(chapters: DataFrame, block: str, number: str, text: str) -> DataFrame:
    """(block, text): "Chapter n", the text, and a line of forty "=", in order of number."""
    piece = F.concat(F.lit("Chapter "), F.col(number).cast("string"), F.lit("\n"), F.col(text), F.lit("\n" + "=" * 40 + "\n"))
    ordered = F.sort_array(F.collect_list(F.struct(F.col(number).alias("n"), piece.alias("p"))))
    return chapters.groupBy(block).agg(F.array_join(F.transform(ordered, lambda x: x["p"]), "").alias("text"))


def reader_index(chapters: DataFrame, folder: str | None = None) -> DataFrame:
    """(number, title, file) in order of number; written as JSON if a folder is given."""
    index = chapters.select("number", "title", "file").orderBy("number", "file")
    if folder:
        index.write.mode("overwrite").json(folder)
    return index


def epub_bytes(title: str, author: str, chapters: list[tuple[int, str, list[str]]]) -> bytes:
    """An EPUB 2 file: stored mimetype first, container, package with spine, contents, a page for each chapter."""
    t, a = escape(title, quote=False), escape(author, quote=False)
    pages = [(f"chapter_{i:04d}.xhtml", escape(name, quote=False), paragraphs) for i, (_, name, paragraphs) in enumerate(chapters, 1)]
    items = "".join(f'<item id="c{i}" href="{f}" media-type="application/xhtml+xml"/>' for i, (f, _, _) in enumerate(pages, 1))
    spine = "".join(f'<itemref idref="c{i}"/>' for i in range(1, len(pages) + 1))
    points = "".join(f'<navPoint id="n{i}" playOrder="{i}"><navLabel><text>{n}</text></navLabel><content src="{f}"/></navPoint>' for i, (f, n, _) in enumerate(pages, 1))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:

        def put(name: str, data: str, how: int = zipfile.ZIP_DEFLATED) -> None:
            info = zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0))
            info.compress_type = how
            z.writestr(info, data)

        put("mimetype", "application/epub+zip", zipfile.ZIP_STORED)
        put("META-INF/container.xml", '<?xml version="1.0"?><container version="1.0" xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="OEBPS/content.opf" media-type="application/oebps-package+xml"/></rootfiles></container>')
        put("OEBPS/content.opf", f'<?xml version="1.0" encoding="utf-8"?><package version="2.0" unique-identifier="id" xmlns="http://www.idpf.org/2007/opf"><metadata xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:title>{t}</dc:title><dc:creator>{a}</dc:creator><dc:language>es</dc:language><dc:identifier id="id">{t}</dc:identifier></metadata><manifest><item id="ncx" href="toc.ncx" media-type="application/x-dtbncx+xml"/>{items}</manifest><spine toc="ncx">{spine}</spine></package>')
        put("OEBPS/toc.ncx", f'<?xml version="1.0" encoding="utf-8"?><ncx version="2005-1" xmlns="http://www.daisy.org/z3986/2005/ncx/"><head/><docTitle><text>{t}</text></docTitle><navMap>{points}</navMap></ncx>')
        for file, name, paragraphs in pages:
            body = "".join(f"<p>{escape(p, quote=False)}</p>" for p in paragraphs)
            put(f"OEBPS/{file}", f'<?xml version="1.0" encoding="utf-8"?><html xmlns="http://www.w3.org/1999/xhtml"><head><title>{name}</title></head><body><h1>{name}</h1>{body}</body></html>')
    return out.getvalue()


def epubs(chapters: DataFrame, block: str, title: str, author: str = "") -> DataFrame:
    """(block, n_chapters, content) for (block, number, title, paragraphs); a block is a book and fits a task."""

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        rows = sorted(((int(n), t or "", list(p)) for n, t, p in zip(pdf.number, pdf.title, pdf.paragraphs, strict=True)), key=lambda r: r[:2])
        return pd.DataFrame([(key[0], len(rows), epub_bytes(f"{title} {key[0]}", author, rows))], columns=["block", "n_chapters", "content"])

    named = chapters.select(F.col(block).cast("long").alias("block"), "number", "title", "paragraphs")
    return named.groupBy("block").applyInPandas(one, "block long, n_chapters long, content binary")
