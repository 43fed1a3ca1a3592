"""Rows and stamps out of HTML, payloads out of XML: by parsers where markup nests, else by regular expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from issuerlake.functions.clean import strip
from issuerlake.operators.common import unnest
from issuerlake.schemas import LISTING_TABLE_CLASS
from issuerlake.sources.parsers import embedded_files, listing_rows, parse_column, without_payloads

# Entities that occur in the listings.
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


def inner_text(c: Column) -> Column:
    """Markup removed, common entities decoded, ends stripped."""
    out = F.regexp_replace(c, "(?s)<[^>]*>", "")
    for entity, char in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return strip(out)


def extract_rows(
    pages: DataFrame, html: str = "html", table_class: str = LISTING_TABLE_CLASS, min_cells: int = 5
) -> DataFrame:
    """Listing rows: code from the link in the second cell, issuer in the third, status in the fifth.

    Only tables of ``table_class`` and rows with at least ``min_cells`` cells count; rows without a
    code are dropped. Quoted or not, nested or not, with any character references.
    """
    keep = [c for c in pages.columns if c != html]
    fields = "_rows array<struct<asset_code: string, issuer: string, situation: string>>"
    parsed = parse_column(pages, html, fields, lambda page: [listing_rows(page, table_class, min_cells)])
    return unnest(parsed, keep, F.col("_rows"), "_r").select(
        *keep, *[strip(F.col(f"_r.{c}")).alias(c) for c in ("asset_code", "issuer", "situation")]
    ).filter(F.col("asset_code") != "")


def extract_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """List items that are links: position, target and text."""
    keep = [c for c in pages.columns if c != html]
    item = r"""(?is)<li[^>]*>\s*(<a\b[^>]*>.*?</a>)\s*</li>"""
    return unnest(pages, keep, F.regexp_extract_all(html, F.lit(item), F.lit(1)), "_a", "position").select(
        *keep,
        "position",
        F.regexp_extract("_a", r"""(?is)^<a\b[^>]*href=["']([^"']*)["']""", 1).alias("href"),
        inner_text(F.col("_a")).alias("label"),
    )


def extract_stamp(pages: DataFrame, html: str = "html", zone: str = "America/Sao_Paulo") -> DataFrame:
    """Last-update stamp of a page in local time, as text; null when the page has none.

    The span in the "Última Atualização" row wins over the first span of the class anywhere, and
    its data-datetime attribute over ISO text inside it.
    """
    span = r"""<span[^>]*class=["'][^"']*\bautomatic-local-datetime\b[^"']*["'][^>]*>.*?</span>"""
    labelled = r"(?is)<th[^>]*>[^<]*Última Atualização[^<]*</th>"
    table_rows = F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>.*?</tr>"), F.lit(0))
    row = F.get(F.filter(table_rows, lambda r: r.rlike(labelled)), F.lit(0))
    found = F.coalesce(
        F.nullif(F.regexp_extract(row, f"(?is)({span})", 1), F.lit("")),
        F.nullif(F.regexp_extract(html, f"(?is)({span})", 1), F.lit("")),
    )
    iso = r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:[+-]\d{2}:?\d{2}|Z)?"
    text = F.coalesce(
        F.nullif(strip(F.regexp_extract("_span", r"""(?is)^<span[^>]*data-datetime=["']([^"']*)["']""", 1)), F.lit("")),
        F.nullif(F.regexp_extract("_span", iso, 0), F.lit("")),
    )
    offset = F.regexp_extract("_iso", r"([+-]\d{2}):?(\d{2})$", 1)
    minutes = F.regexp_extract("_iso", r"([+-]\d{2}):?(\d{2})$", 2)
    # Zone-free timestamps, so the result does not depend on the session time zone.
    local = F.try_to_timestamp(F.substring("_iso", 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss")).cast("timestamp_ntz")
    source_zone = F.when(offset == "", "+00:00").otherwise(F.concat(offset, F.lit(":"), minutes))
    keep = [c for c in pages.columns if c != html]
    return (
        pages.select(*keep, found.alias("_span"))
        .select(*keep, text.alias("_iso"))
        .select(
            *keep,
            F.date_format(F.convert_timezone(source_zone, F.lit(zone), local), "yyyy-MM-dd'T'HH:mm:ss").alias(
                "last_update"
            ),
        )
    )


def extract_payloads(docs: DataFrame, xml: str = "xml") -> DataFrame:
    """Embedded PDFs: parent tag, file name stated in the same parent, bytes, hash and size.

    Every payload element with text counts, wherever it stands; without a name beside it the name is
    null, and broken base64 gives null bytes. ``ordinal`` numbers the files of a document.
    """
    keep = [c for c in docs.columns if c != xml]
    fields = "_files array<struct<tag: string, file_name: string, text: string>>"
    parsed = parse_column(docs, xml, fields, lambda text: [embedded_files(text)])
    return (
        unnest(parsed, keep, F.col("_files"), "_f", "ordinal")
        .select(*keep, "ordinal", "_f.tag", "_f.file_name", F.try_to_binary(strip(F.col("_f.text")), F.lit("base64")).alias("content"))
        .withColumns({"file_hash": F.sha2("content", 256), "n_bytes": F.octet_length("content")})
    )


def strip_payloads(docs: DataFrame, xml: str = "xml") -> DataFrame:
    """The same XML with the text of every extracted payload blanked, and nothing else."""
    blanked = parse_column(docs, xml, "_blanked string", lambda text: [without_payloads(text)])
    return blanked.select(*[F.col("_blanked").alias(c) if c == xml else F.col(c) for c in docs.columns])
