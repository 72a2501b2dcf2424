"""Text bounding, truncation and escaping as Column expressions.

Everything here stays in the JVM except Unicode normalisation and full case
folding, which Spark has no built-ins for; those steps are Arrow UDFs fed only
the rows that need them.
"""

from __future__ import annotations

from unicodedata import is_normalized, normalize

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.bounds import MAX_MESSAGE_CHARS, MIN_MESSAGE_CHARS
from ledgerloom.functions.once import bind

# The Unicode white space that stripping and collapsing act on.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE_CLASS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

# Most characters are printable ASCII; one range tells them before the many of a class are tried.
_NO_ASCII_SIGN = "(?=[^!-~])"
_NO_ASCII = "(?=[^ -~])"

# Any run but a lone space: two spaces or more, or one at most and then another kind.
_RUN_TO_COLLAPSE = (
    _NO_ASCII_SIGN
    + r"(?: {2,}| ?[\t-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}])"
    + WHITESPACE_CLASS
    + "*"
)

# Code points that never appear in excerpts or accepted text.
INVISIBLE_CLASS = r"[\x{200b}-\x{200f}\x{202a}-\x{202e}\x{2066}-\x{2069}]"
FORBIDDEN_CLASS = (
    r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f\x{200b}-\x{200f}\x{202a}-\x{202e}\x{2066}-\x{2069}]"
)

# Markers and the Markdown characters that get a backslash.
TRUNCATION_MARKER = "\n[truncated locally]"
ELLIPSIS = "…"
MARKDOWN_CLASS = r"([\\`*_{}\[\]<>()#+\-.!|])"

# Below this code point every string is already in NFC.
_ABOVE_LATIN = r"[^\x00-\x{2ff}]"


@F.arrow_udf(T.StringType())
def _nfc(values: pa.Array) -> pa.Array:
    # Arrow's own utf8_normalize leaves NFC text decomposed, so Python's is used.
    normal = [None if text is None else normalize("NFC", text) for text in values.to_pylist()]
    return pa.array(normal, pa.string())


@F.arrow_udf(T.BooleanType())
def _equals_nfc(values: pa.Array) -> pa.Array:
    equal = [None if text is None else is_normalized("NFC", text) for text in values.to_pylist()]
    return pa.array(equal, pa.bool_())


@F.arrow_udf(T.StringType())
def _folded(values: pa.Array) -> pa.Array:
    folded = [None if text is None else text.casefold() for text in values.to_pylist()]
    return pa.array(folded, pa.string())


def nfc(text: Column) -> Column:
    """NFC form of ``text``."""
    needs = text.rlike(_ABOVE_LATIN)
    return F.when(needs, _nfc(F.when(needs, text))).otherwise(text)


def is_nfc(text: Column) -> Column:
    """Whether ``text`` is in NFC. Rows below U+0300 send no bytes to Python."""
    return F.coalesce(_equals_nfc(F.when(text.rlike(_ABOVE_LATIN), text)), text.isNotNull())


def casefold(text: Column) -> Column:
    """Full Unicode case folding; rows of ASCII send no bytes to Python."""
    wide = text.rlike(r"[^\x00-\x7f]")
    return F.when(wide, _folded(F.when(wide, text))).otherwise(F.lower(text))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def collapse_whitespace(text: Column) -> Column:
    """White space runs as one space, ends stripped; single spaces need no replacing."""
    return strip(F.regexp_replace(text, _RUN_TO_COLLAPSE, " "))


def bounded_text(text: Column, max_chars: int = MAX_MESSAGE_CHARS) -> Column:
    """Message text without NUL, stripped, at most ``max_chars`` code points."""
    if max_chars < MIN_MESSAGE_CHARS:
        raise ValueError(f"max_chars must be at least {MIN_MESSAGE_CHARS}")
    keep = max_chars - len(TRUNCATION_MARKER)

    def cut(cleaned: Column) -> Column:
        return F.when(F.char_length(cleaned) <= max_chars, cleaned).otherwise(
            F.concat(F.substring(cleaned, 1, keep), F.lit(TRUNCATION_MARKER))
        )

    return bind(strip(F.replace(text, F.lit("\x00"), F.lit(""))), cut)


def truncate_utf8(text: Column, max_bytes: int) -> Column:
    """Longest whole-character prefix that fits with an ellipsis in ``max_bytes``.

    Text that already fits is unchanged. A byte prefix of valid UTF-8 is valid
    only at a character boundary, so at most four lengths have to be tried.
    """
    available = max_bytes - len(ELLIPSIS.encode("utf-8"))

    def prefix(value: Column, back: int) -> Column:
        head = F.substring(value.cast("binary"), 1, max(available - back, 0))
        return F.try_validate_utf8(head.cast("string"))

    def cut(value: Column) -> Column:
        if available < 0:
            shorter = F.lit("")
        else:
            longest = F.coalesce(*[prefix(value, back) for back in range(4)])
            shorter = F.concat(F.rtrim(longest, F.lit(WHITESPACE)), F.lit(ELLIPSIS))
        return F.when(F.octet_length(value) <= max_bytes, value).when(value.isNotNull(), shorter)

    return bind(text, cut)


def escape_markdown(text: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return F.regexp_replace(text, MARKDOWN_CLASS, r"\\$1")


def _visible_head(text: Column, count: int) -> Column:
    """The text up to its ``count``-th visible character that is no white space."""
    skipped = INVISIBLE_CLASS[1:-1] + WHITESPACE_CLASS[1:-1]
    return F.regexp_extract(text, rf"\A(?:[{skipped}]*+[^{skipped}]){{0,{count}}}+", 0)


def excerpt(text: Column, max_bytes: int) -> Column:
    """One-line inert excerpt. Escaping comes before the byte cut.

    Every visible character gives a byte at least, so what lies past one more than
    ``max_bytes`` of them cannot be in the excerpt and is not looked at.
    """
    visible = F.regexp_replace(_visible_head(text, max_bytes + 1), _NO_ASCII + INVISIBLE_CLASS, "")
    return truncate_utf8(escape_markdown(collapse_whitespace(visible)), max_bytes)


def inert_markdown(text: Column) -> Column:
    """One-line inert Markdown of the whole text."""
    allowed = F.regexp_replace(nfc(text), _NO_ASCII + FORBIDDEN_CLASS, "")
    return escape_markdown(collapse_whitespace(allowed))


def is_safe_text(
    text: Column, max_bytes: int, max_chars: int | None = None, single_line: bool = False
) -> Column:
    """Non-blank NFC text without control, zero-width or direction characters."""
    ok = (
        (strip(text) != "")
        & ~text.rlike(_NO_ASCII + FORBIDDEN_CLASS)
        & (F.octet_length(text) <= max_bytes)
        & is_nfc(F.when(F.octet_length(text) <= max_bytes, text))
    )
    if max_chars is not None:
        ok = ok & (F.char_length(text) <= max_chars)
    if single_line:
        ok = ok & ~text.rlike(r"[\n\r\t]")
    return F.coalesce(ok, F.lit(False))
