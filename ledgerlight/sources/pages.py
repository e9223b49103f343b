"""Part documents as page items: the words, characters and ruling lines that layout operators take.

An archive's members are read by a page reader, a function from a member's bytes to items. The one here reads the page
layouts that this library writes and tests with, JSON of ``{"pages": [{"page_no", "words", "chars", "edges"}]}``, and PDF files
where the optional pdfplumber package is installed.
"""

from __future__ import annotations

import io
import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: file, member, page, kind (word, char or edge), place in the page, and what the kind has of the rest.
ITEMS = "file string, member string, page_no int, kind string, idx long, text string, x0 double, x1 double, top double, bottom double, fontname string, orientation string"
_FIELDS = {"text": pa.string(), "x0": pa.float64(), "x1": pa.float64(), "top": pa.float64(), "bottom": pa.float64(), "fontname": pa.string(), "orientation": pa.string()}
_KINDS = (("word", "words"), ("char", "chars"), ("edge", "edges"))

PageReader = Callable[[bytes], Iterator[dict]]


def read_pages(content: bytes) -> Iterator[dict]:
    """Pages, as dicts of page_no and lists of words, chars and edges, of a member."""
    if not content.startswith(b"%PDF"):
        yield from json.loads(content)["pages"]
        return
    try:
        import pdfplumber
    except ImportError as missing:
        raise RuntimeError("PDF parts need the pdfplumber package, or a page reader of your own") from missing
    with pdfplumber.open(io.BytesIO(content)) as document:
        for number, page in enumerate(document.pages, 1):
            yield {"page_no": number, "words": page.extract_words(extra_attrs=["fontname"]), "chars": page.chars, "edges": page.edges}


def page_items(members: DataFrame, reader: PageReader = read_pages) -> DataFrame:
    """Items of members(file, member, content). A page at a time in memory; a member is read by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, member, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                for page in reader(content.as_py()):
                    for kind, name in _KINDS:
                        rows = page.get(name) or []
                        if rows:
                            n = len(rows)
                            same = [pa.array([file] * n, pa.string()), pa.array([member] * n, pa.string()), pa.array([page["page_no"]] * n, pa.int32()), pa.array([kind] * n), pa.array(range(n), pa.int64())]
                            yield pa.RecordBatch.from_arrays([*same, *[pa.array([r.get(f) for r in rows], t) for f, t in _FIELDS.items()]], ["file", "member", "page_no", "kind", "idx", *_FIELDS])

    return members.mapInArrow(run, ITEMS)
