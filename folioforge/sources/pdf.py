"""A small PDF 1.4 writer for chapter blocks: title page, running head, page numbers, Latin-1 core font."""

from __future__ import annotations

import textwrap

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDTH, LINES, LEADING = 92, 52, 14


def _latin1(text: str) -> str:
    return text.encode("latin-1", "replace").decode("latin-1")


def _string(text: str) -> str:
    return "(" + _latin1(text).replace("\\", "\\\\").replace("(", "\\(").replace(")", "\\)") + ")"


def _page(lines: list[tuple[int, str]], head: str, foot: str) -> bytes:
    """A content stream; lines: (font size, text). Head and foot are set in small type."""
    out = ["BT", "/F1 8 Tf", "50 810 Td", f"{_string(head)} Tj", "ET", "BT", "/F1 8 Tf", "290 25 Td", f"{_string(foot)} Tj", "ET", "BT", "50 785 Td", f"{LEADING} TL"]
    for size, text in lines:
        out += [f"/F1 {size} Tf", f"{_string(text)} Tj", "T*"]
    return "\n".join([*out, "ET"]).encode("latin-1")


def pdf_bytes(title: str, author: str, chapters: list[tuple[str, list[str]]]) -> bytes:
    """Chapters (title, paragraphs) as one file; each begins on a new page."""
    pages = [_page([(24, title), (14, ""), (14, author)], "", "")]
    for name, paragraphs in chapters:
        lines = [(16, name), (11, "")]
        for p in paragraphs:
            lines += [(11, x) for x in textwrap.wrap(p, WIDTH) or [""]] + [(11, "")]
        for k in range(0, len(lines), LINES):
            pages.append(_page(lines[k : k + LINES], title, str(len(pages))))
    kids = " ".join(f"{4 + 2 * i} 0 R" for i in range(len(pages)))
    objects = [
        b"<< /Type /Catalog /Pages 2 0 R >>",
        f"<< /Type /Pages /Kids [{kids}] /Count {len(pages)} >>".encode(),
        b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica /Encoding /WinAnsiEncoding >>",
    ]
    for i, content in enumerate(pages):
        objects.append(f"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 595 842] /Resources << /Font << /F1 3 0 R >> >> /Contents {5 + 2 * i} 0 R >>".encode())
        objects.append(b"<< /Length %d >>\nstream\n" % len(content) + content + b"\nendstream")
    out, places = bytearray(b"%PDF-1.4\n"), []
    for i, body in enumerate(objects, 1):
        places.append(len(out))
        out += b"%d 0 obj\n" % i + body + b"\nendobj\n"
    start = len(out)
    out += b"xref\n0 %d\n0000000000 65535 f \n" % (len(objects) + 1)
    out += b"".join(b"%010d 00000 n \n" % p for p in places)
    out += b"trailer\n<< /Size %d /Root 1 0 R >>\nstartxref\n%d\n%%%%EOF\n" % (len(objects) + 1, start)
    return bytes(out)


def pdfs(chapters: DataFrame, block: str, title: str, author: str = "") -> DataFrame:
    """(block, n_chapters, content) for (block, number, title, paragraphs); a block is a book and fits a task."""

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        rows = sorted((int(n), t or "", list(p)) for n, t, p in zip(pdf.number, pdf.title, pdf.paragraphs, strict=True))
        return pd.DataFrame([(key[0], len(rows), pdf_bytes(f"{title} {key[0]}", author, [r[1:] for r in rows]))], columns=["block", "n_chapters", "content"])

    named = chapters.select(F.col(block).cast("long").alias("block"), "number", "title", "paragraphs")
    return named.groupBy("block").applyInPandas(one, "block long, n_chapters long, content binary")
