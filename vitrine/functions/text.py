"""Cleaning of text and markup with native string expressions."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCRIPT_BLOCK = r"(?s)<script[^>]*>.*?</script>"
STYLE_BLOCK = r"(?s)<style[^>]*>.*?</style>"
COMMENT = r"(?s)<!--.*?-->"
EVENT_HANDLER = r'on\w+="[^"]*"'
TAG = r"<[^>]*>"
# One JSON literal, folded to a map when the query is planned.
NAMED_REFERENCES = json.dumps({name[:-1]: value for name, value in html5.items() if name.endswith(";")})
# References 128 to 159 mean the characters that Windows has there, where it has any.
WINDOWS_REFERENCES = json.dumps({str(b): bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(128, 160)})
ENTITY = r"&(?:#\d+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"


def strip(text: Column) -> Column:
    """Drop leading and trailing white space of any kind, not only blanks."""
    return F.regexp_replace(text, r"(?U)^\s+|(?<!\s)\s++$", "")


def collapse_whitespace(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"(?U)\s+", " "))


def _code_point(number: Column) -> Column:
    valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))


def unescape_entities(text: Column) -> Column:
    """Replace named, decimal and hexadecimal character references.

    The text is cut at the references, each is resolved by itself, and the pieces are
    joined again, so '&amp;lt;' becomes '&lt;' and is not unescaped twice. Text without
    '&' is passed through.
    """
    names = F.from_json(F.lit(NAMED_REFERENCES), "map<string,string>")

    def resolve(ref: Column) -> Column:
        body = F.regexp_replace(F.substring_index(F.substring(ref, 2, 1 << 30), ";", 1), "^(#[xX]?)0+(?=.)", "$1")
        # the largest code point has six hexadecimal and seven decimal digits
        short = lambda digits, most: F.when(F.length(digits) <= most, digits)
        hexadecimal = F.conv(short(F.substring(body, 3, 1 << 30), 6), 16, 10).try_cast("bigint")
        decimal = short(F.substring(body, 2, 1 << 30), 7).try_cast("bigint")
        number = F.when(body.rlike("^#[xX]"), hexadecimal).otherwise(decimal)
        windows = F.element_at(F.from_json(F.lit(WINDOWS_REFERENCES), "map<string,string>"), number.cast("string"))
        known = (
            F.when(F.startswith(body, F.lit("#")), F.coalesce(windows, _code_point(number)))
            .otherwise(F.element_at(names, body))
        )
        return F.coalesce(known, ref)

    pieces = F.split(text, ENTITY)
    refs = F.transform(F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)), resolve)
    joined = F.array_join(F.zip_with(pieces, refs, lambda p, r: F.concat(p, F.coalesce(r, F.lit("")))), "")
    return F.when(F.contains(text, F.lit("&")), joined).otherwise(text)


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, TAG, "")


def visible_text(markup: Column) -> Column:
    """Markup to plain text: tags out, references resolved, white space normalised."""
    return plain_text(F.regexp_replace(markup, TAG, " "))


def plain_text(text: Column) -> Column:
    """Text without tags: references resolved, white space normalised."""
    return collapse_whitespace(unescape_entities(text))


def sanitize(text: Column) -> Column:
    """Drop script blocks, event handlers and all other markup, then strip."""
    for pattern in (SCRIPT_BLOCK, STYLE_BLOCK, COMMENT, EVENT_HANDLER, TAG):
        text = F.regexp_replace(text, pattern, "")
    return strip(unescape_entities(text))


def _sanitize_value(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return sanitize(value)
    if isinstance(kind, T.StructType):
        fields = [_sanitize_value(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType) and _holds_text(kind):
        return F.transform(value, lambda x: _sanitize_value(x, kind.elementType))
    if isinstance(kind, T.MapType) and _holds_text(kind.valueType):
        return F.transform_values(value, lambda _, v: _sanitize_value(v, kind.valueType))
    return value


def _holds_text(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_text(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _holds_text(kind.elementType)
    if isinstance(kind, T.MapType):
        return _holds_text(kind.valueType)
    return isinstance(kind, T.StringType)


def sanitize_strings(df: DataFrame) -> DataFrame:
    """Sanitize every string at any depth; the expression is built from the schema."""
    return df.select(*[_sanitize_value(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])
