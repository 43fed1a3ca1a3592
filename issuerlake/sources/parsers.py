"""Task-side parsers of nested markup, for what regular expressions cannot tell apart.

The module is pickled by value, so executors need pyarrow but not this package.
"""

from __future__ import annotations

import html
import re
import sys
from collections import Counter
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The elements that hold an embedded file and its name.
PAYLOAD, PAYLOAD_NAME = "ImagemObjetoArquivoPdf", "NomeArquivoPdf"
# Quoted values may hold ">" but no "<"; what is not closed by the end of the text is taken to reach there, or is no tag.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[?!][^>]*(?:>|\Z)"
    r"|<(?P<close>/)?(?P<name>[^\s/><!?]++)(?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*?(?P<empty>/)?>", re.S
)


def parse_column(df: DataFrame, column: str, fields: str, parse: Callable[[str | None], list]) -> DataFrame:
    """The other columns plus ``fields``, whose values ``parse`` gives for the text of ``column``."""
    keep = [c for c in df.columns if c != column]
    schema = StructType([*df.select(*keep).schema.fields, *StructType.fromDDL(fields).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = zip(*(parse(x) for x in batch.column(0).to_pylist())) if batch.num_rows else [[] for _ in arrow][len(keep) :]
            new = [pa.array(list(v), t.type) for v, t in zip(made, list(arrow)[len(keep) :])]
            yield pa.RecordBatch.from_arrays([*(c.cast(t.type) for c, t in zip(batch.columns[1:], arrow)), *new], schema=arrow)

    return df.select(column, *keep).mapInArrow(run, schema)


def records(text: str | None, sep: str) -> list[str] | None:
    """Lines of a delimited text, where a line break inside a quoted cell ends none. A cell is quoted if it begins with a quote."""
    if text is None:
        return None
    other = re.escape(sep)
    cell = re.compile(rf'(?:"[^"]*(?:""[^"]*)*(")?)?[^{other}\n]*')
    out, start, at = [], 0, 0
    while True:
        m = cell.match(text, at)
        if text.startswith('"', at) and m[1] is None:
            raise ValueError(f"a quoted cell is not closed: {text[at:at + 60]!r}")
        at = m.end()
        if at == len(text) or text[at] == "\n":
            out.append(text[start:at].removesuffix("\r"))
            start = at + 1
            if at == len(text):
                return out
        at += 1


def quoted_records(sep: str) -> Callable[[pd.Series], pd.Series]:
    def split(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: records(t, sep))

    return split


class ListingParser(HTMLParser):
    """Cells of the tables of one class. A nested table belongs to the cell that holds it."""

    def __init__(self, table_class: str):
        super().__init__(convert_charrefs=True)
        self.table_class = table_class
        self.tables: list[bool] = []  # of open tables: listed or not
        self.rows: list[list[dict]] = []
        self.cell: dict | None = None
        self.depth = 0  # open tables when the current listing began
        self.link = False

    def at_listing(self) -> bool:
        return bool(self.tables) and len(self.tables) == self.depth

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            listed = self.table_class in (dict(attrs).get("class") or "").split()
            if listed and self.cell is None:
                self.depth = len(self.tables) + 1
            self.tables.append(listed)
        elif self.at_listing() and tag == "tr":
            self.end_cell()
            self.rows.append([])
        elif self.at_listing() and tag in ("td", "th"):
            self.end_cell()
            if not self.rows:
                self.rows.append([])
            self.cell = {"tag": tag, "text": [], "link": None}
        elif tag == "a" and self.cell is not None and self.cell["link"] is None:
            self.cell["link"] = []
            self.link = True

    def handle_endtag(self, tag):
        if tag == "table" and self.tables:
            if self.at_listing():
                self.end_cell()
                self.depth = 0
            self.tables.pop()
        elif tag in ("td", "th", "tr") and self.at_listing():
            self.end_cell()
        elif tag == "a":
            self.link = False

    def handle_data(self, data):
        if self.cell is not None:
            self.cell["text"].append(data)
            if self.link:
                self.cell["link"].append(data)

    def end_cell(self):
        if self.cell is not None:
            if self.cell["tag"] == "td":
                self.rows[-1].append(self.cell)
            self.cell, self.link = None, False


def listing_rows(page: str | None, table_class: str, min_cells: int) -> list[dict]:
    """Code, issuer and status of the listing's rows; rows without a code or with too few cells are left out."""
    parser = ListingParser(table_class)
    parser.feed(page or "")
    parser.close()
    parser.end_cell()
    out = []
    for cells in parser.rows:
        if len(cells) >= min_cells:
            code, issuer, situation = ("".join(x or []).strip() for x in (cells[1]["link"], cells[2]["text"], cells[4]["text"]))
            if code:
                out.append({"asset_code": code, "issuer": issuer, "situation": situation})
    return out


def payloads(xml: str | None) -> tuple[list[dict], list[tuple[int, int]]]:
    """(embedded files, places of their text): tag of the parent, name in the same parent or None, base64 text.

    Elements may stand at any depth, in any order and with attributes. An element without text is no file.
    """
    source = xml or ""
    root = {"tag": None, "name": None, "files": []}
    stack, done, places = [root], [], []
    opened: Counter = Counter()

    def close():
        node = stack.pop()
        opened[node["tag"]] -= 1
        done.extend(node["files"])
        for f in node["files"]:
            f["file_name"], f["tag"] = node["name"], node["tag"]
        if node["tag"] == PAYLOAD_NAME and stack[-1]["name"] is None:
            stack[-1]["name"] = html.unescape(node["text"])
        if node["tag"] == PAYLOAD and node["text"].strip():
            stack[-1]["files"].append({"order": len(places), "text": node["text"].strip()})
            places.append((node["start"], node["end"]))

    at = 0
    for m in TOKEN.finditer(source):
        if "text" in stack[-1]:
            stack[-1]["text"] += source[at : m.start()] + (m["cdata"] or "")
        at = m.end()
        name = m["name"]
        if not name:
            continue
        if m["close"]:
            if opened[name]:
                while stack[-1]["tag"] != name:
                    stack[-1]["end"] = m.start()
                    close()
                stack[-1]["end"] = m.start()
                close()
        elif not m["empty"]:
            node = {"tag": name, "name": None, "files": [], "start": m.end(), "end": len(source)}
            if name in (PAYLOAD, PAYLOAD_NAME):
                node["text"] = ""
            stack.append(node)
            opened[name] += 1
    while len(stack) > 1:
        close()
    done.extend(root["files"])
    for f in root["files"]:
        f["file_name"], f["tag"] = root["name"], None
    return sorted(done, key=lambda f: f["order"]), places


def embedded_files(xml: str | None) -> list[dict]:
    return [{"tag": f["tag"], "file_name": f["file_name"], "text": f["text"]} for f in payloads(xml)[0]]


def without_payloads(xml: str | None) -> str | None:
    """The text with exactly the payloads of ``embedded_files`` blanked."""
    if xml is None:
        return None
    out, at = [], 0
    for start, end in sorted(payloads(xml)[1]):
        out.append(xml[at:start])
        at = end
    return "".join([*out, xml[at:]])
