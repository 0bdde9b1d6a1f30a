"""Text expressions: whitespace, escaping, hashes, lenient numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The code points treated as whitespace (ASCII and its separators,
# then the Unicode spaces), as characters and as a regular expression.
WHITESPACE_CHARS = "".join(
    chr(c)
    for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680]
    + [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
WHITESPACE = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE_CHARS) + "]"


def strip(col: Column) -> Column:
    """Cuts whitespace at both ends; unlike a pattern it never scans the middle."""
    return F.btrim(col, F.lit(WHITESPACE_CHARS))


def collapse(col: Column) -> Column:
    """Runs of whitespace become one space; none at either end."""
    return F.trim(F.regexp_replace(col, f"{WHITESPACE}+", " "))


def document_text(title: Column, body: Column) -> Column:
    return F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.coalesce(body, F.lit("")))


def content_hash(title: Column, body: Column) -> Column:
    """Identity of the text to embed; unlike payload_hash it ignores scores."""
    return F.md5(document_text(title, body))


def embedding_text(title: Column, body: Column) -> Column:
    return strip(document_text(title, body))


def split_version(native_id: Column) -> tuple[Column, Column]:
    """``2601.00001v2`` is (``2601.00001``, ``v2``); without a suffix, (id, NULL)."""
    pattern = r"(?s)^(.*)v([0-9]+)$"
    matched = native_id.rlike(pattern)
    base = F.when(matched, F.regexp_extract(native_id, pattern, 1)).otherwise(native_id)
    version = F.when(matched, F.concat(F.lit("v"), F.regexp_extract(native_id, pattern, 2)))
    return base, version


def lenient_int(col: Column, to: str = "int") -> Column:
    """Text to integer; fractions are rounded, anything else is NULL."""
    return F.coalesce(
        col.try_cast(to),
        F.round(col.try_cast("double")).try_cast(to),
    )


def escape_markup(col: Column) -> Column:
    """``&`` goes first, or it would escape the entities made after it."""
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        col = F.replace(col, F.lit(char), F.lit(entity))
    return col


def escape_link_label(col: Column) -> Column:
    # A plain bar would end the label inside <url|label>.
    return F.replace(escape_markup(col), F.lit("|"), F.lit("｜"))
