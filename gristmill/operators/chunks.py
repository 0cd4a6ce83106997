"""Splitting pages and texts into overlapping chunks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windows(text: str, size: int, overlap: int) -> list[tuple[int, int]]:
    """(start, end) of windows of at most size characters. A window that isn't the last ends at a space of its second half, if
    there is one; the next begins overlap characters before that, past white space."""
    out, start, n = [], 0, len(text)
    while start < n:
        end = min(start + size, n)
        if end < n:
            space = text.rfind(" ", start + size // 2, end)
            end = space if space > start else end
        out.append((start, end))
        if end == n:
            break
        start = max(start + 1, end - overlap)
        while start < n and text[start].isspace():
            start += 1
    return out


def chunked(docs: DataFrame, id_col: str, text_col: str, size: int, overlap: int, most: int | None = None) -> DataFrame:
    """(id, chunk, text) of each document's non-blank windows, at most so many. Null texts have none."""
    if not 0 <= overlap < size:
        raise ValueError("the overlap has to be smaller than the chunk")

    @F.pandas_udf("array<string>")
    def cut(x: pd.Series) -> pd.Series:
        return x.map(lambda t: [s for a, b in windows(t or "", size, overlap) if (s := t[a:b].strip())][:most])

    return docs.select(id_col, F.posexplode(cut(F.col(text_col))).alias("chunk", "text"))


def chunked_pages(docs: DataFrame, id_col: str, pages_col: str, size: int, overlap: int) -> DataFrame:
    """(id, chunk, first_page, last_page, text) of documents' pages (array of page, text), joined by blank lines."""

    @F.pandas_udf("array<struct<first_page:int,last_page:int,text:string>>")
    def cut(x: pd.Series) -> pd.Series:
        def one(pages) -> list[dict]:
            spans, parts, at = [], [], 0
            for p in pages if pages is not None else []:
                text = p["text"] or ""
                spans.append((at, at + len(text), p["page"]))
                parts.append(text)
                at += len(text) + 2
            whole, out = "\n\n".join(parts), []
            for a, b in windows(whole, size, overlap):
                on = [p for s, e, p in spans if e > a and s < b]
                if on and (t := whole[a:b].strip()):
                    out.append({"first_page": min(on), "last_page": max(on), "text": t})
            return out

        return x.map(one)

    return docs.select(id_col, F.posexplode(cut(F.col(pages_col))).alias("chunk", "c")).select(id_col, "chunk", "c.*")
