"""Column-level cleaning. Every function takes and returns a Column (or a name)
and stays inside whole-stage codegen; none needs a Python worker."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whitespace as Python's str.split / str.strip see it. Java's plain \s and SQL trim() are narrower.
WS = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
WS_CHARS = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
NOT_WS = WS.replace("[", "[^", 1)

# Text standing for a missing value, and the letters folded in source column names.
NULL_TOKENS = ["nan", "None", "-", ""]
ACCENTED = "áàãâéêíóôõúüç"
FOLDED = "aaaaeeiooouuc"


def strip(c: Column) -> Column:
    """Both ends stripped, without a regular expression: most values have nothing to strip."""
    return F.btrim(c, F.lit(WS_CHARS))


def collapse_ws(c: Column) -> Column:
    """Null becomes '', ends are stripped, inner whitespace runs become one space."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), f"{WS}+", " "))


def _number(text: Column, raw: Column) -> Column:
    """``text`` as a double where ``raw`` has none of the letters of 'nan', 'inf', '1d', '1f' and '0x1p3'.

    A bare cast would read those too. The test is on the raw column and small on purpose: nothing
    derived is computed twice, and a projection over many columns stays below the method size up to
    which the JVM compiles.
    """
    return F.when(~raw.rlike("[nNfFdDxX]"), text.try_cast("double"))


def numeric_lenient(c: Column) -> Column:
    """Decimal text -> double, anything else -> null."""
    c = c.cast("string")
    return _number(c, c)


def br_number(c: Column) -> Column:
    """'1.234,56' -> 1234.56; anything unreadable -> null."""
    c = c.cast("string")
    return _number(F.replace(F.replace(c, F.lit("."), F.lit("")), F.lit(","), F.lit(".")), c)


def feed_number(c: Column) -> Column:
    """Text with a comma has the Brazilian format, any other a decimal point."""
    c = c.cast("string")
    return F.when(F.contains(c, F.lit(",")), br_number(c)).otherwise(numeric_lenient(c))


def br_number_for(field: T.StructField) -> Column:
    """Numeric columns pass through unchanged, text goes through ``br_number``."""
    c = F.col(f"`{field.name}`")
    return c.cast("double") if isinstance(field.dataType, T.NumericType) else br_number(c)


def date_strict(c: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Fails the job on a value that does not have the format (ANSI mode).

    A plain ISO date is cast, which takes a fraction of the time that reading by a format does.
    """
    if fmt != "yyyy-MM-dd":
        return F.to_date(c, fmt)
    day = c.try_cast("date")
    return F.when((F.length(c) == 10) & (day.cast("string") == c), day).otherwise(F.to_date(c, fmt))


def date_lenient(c: Column, fmt: str = "dd/MM/yyyy") -> Column:
    return F.try_to_timestamp(c, F.lit(fmt)).cast("date")


def null_token(c: Column) -> Column:
    s = strip(c)
    return F.when(~s.isin(NULL_TOKENS), s)


def null_tokens(df: DataFrame) -> DataFrame:
    """Strip every string column and turn missing-value tokens into null, in one projection."""
    return df.select(
        *[
            null_token(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def snake_name(name: str) -> str:
    """Source column header -> snake_case identifier."""
    low = name.lower().translate(str.maketrans(ACCENTED, FOLDED))
    kept = re.sub(r"[^\w\s/()-]+", "", low)
    return re.sub(r"[\s/()_-]+", "_", kept).strip("_")


def snake_col(c: Column) -> Column:
    """The same folding applied to values."""
    low = F.translate(F.lower(c), ACCENTED, FOLDED)
    kept = F.regexp_replace(low, r"(?U)[^\w\s/()-]+", "")
    return F.regexp_replace(F.regexp_replace(kept, r"(?U)[\s/()_-]+", "_"), "^_|_$", "")


def halve_doubled(c: Column) -> Column:
    """First half of a text the source repeats twice (odd lengths round down)."""
    return F.substr(c, F.lit(1), F.floor(F.length(c) / 2).cast("int"))


def cnpj_digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def cnpj_format(digits: Column) -> Column:
    """14 digits -> 00.000.000/0000-00; any other length -> null."""
    d = cnpj_digits(digits)
    return F.when(
        F.length(d) == 14, F.regexp_replace(d, r"^(\d{2})(\d{3})(\d{3})(\d{4})(\d{2})$", r"$1.$2.$3/$4-$5")
    )


def quarter_label(d: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(d).cast("string"))


def map_labels(c: Column, mapping: dict[str, str], strict: bool = False) -> Column:
    """Label lookup. Unmapped labels give null, or fail the job in strict mode."""
    keys = list(mapping)
    out = F.when(c == keys[0], F.lit(mapping[keys[0]]))
    for k in keys[1:]:
        out = out.when(c == k, F.lit(mapping[k]))
    if strict:
        out = out.otherwise(F.raise_error(F.concat(F.lit("unmapped label: "), F.coalesce(c, F.lit("null")))).cast("string"))
    return out


def pick_filled(*cs: Column) -> Column:
    """The larger of several readings of which one is filled; nulls are skipped."""
    return F.greatest(*cs)


def tokens(c: Column) -> Column:
    """Lower-cased runs of letters and digits, as an array."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def words(c: Column) -> Column:
    """Whitespace words, as an array; blank text has none."""
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(NOT_WS + "+"), F.lit(0))


def n_words(c: Column) -> Column:
    return F.regexp_count(c, F.lit(NOT_WS + "+"))


def object_path(layer, source, doc_type, *, agg=None, version=None, extra=None, ref_date, ext) -> Column:
    """layer/source/TYPE[_agg][_version][_extra]-ref_date.ext; null parts are left out."""
    optional = [F.lit(None).cast("string") if p is None else p.cast("string") for p in (agg, version, extra)]
    stem = F.concat_ws("_", doc_type, *[F.replace(p, F.lit(" "), F.lit("_")) for p in optional])
    return F.concat_ws("/", layer, source, F.concat(stem, F.lit("-"), ref_date.cast("string"), F.lit("."), ext))
