"""Bytes of pages as text: content encodings, charsets, composed characters."""

from __future__ import annotations

import gzip
import re
import unicodedata
import zlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .charsets import SURE, guess
from .values import CHARSETS, TRIED_ENCODINGS

META_CHARSET = re.compile(rb"<meta[^>]*charset\s*=\s*[\"']?([^\"'>\s]+)", re.I)


def unpacked(raw: bytes, encoding: str | None) -> bytes:
    """Decompressed bytes; as they are where that fails or no decoder is installed."""
    encoding = (encoding or "").lower()
    if "br" in encoding:
        try:
            import brotli
        except ImportError:
            return raw
        try:
            return brotli.decompress(raw)
        except brotli.error:
            return raw
    if "gzip" in encoding:
        try:
            return gzip.decompress(raw)
        except (OSError, EOFError, zlib.error):
            return raw
    return raw


def declared(raw: bytes) -> str | None:
    found = META_CHARSET.search(raw[:8192])
    return CHARSETS.get(name := found[1].decode("latin-1").lower(), name) if found else None


def marked(text: str) -> bool:
    return "<html" in text.lower() or "<!doctype" in text.lower()


def tried(raw: bytes) -> str:
    """The first encoding that reads the bytes as a page, else utf-8."""
    for name in TRIED_ENCODINGS:
        try:
            if marked(raw.decode(name)):
                return name
        except UnicodeDecodeError:
            pass
    return "utf-8"


def page_text(raw: bytes | None, charset: str | None = None, encoding: str | None = None) -> str | None:
    """A page's text in composed characters: by its own charset, else the header's, else the likeliest, else by trial; null for null."""
    if raw is None:
        return None
    raw = unpacked(bytes(raw), encoding)
    name = declared(raw) or charset
    if not name or name.lower() == "iso-8859-1":
        likely, sure = guess(raw)
        name = likely if sure > SURE else tried(raw)
    try:
        text = raw.decode(name, errors="replace")
    except LookupError:
        text = ""
    return unicodedata.normalize("NFC", text if marked(text) else raw.decode("utf-8", errors="replace"))


@F.pandas_udf(StringType())
def _decoded(raw: pd.Series, charset: pd.Series, encoding: pd.Series) -> pd.Series:
    return pd.Series([page_text(r, c or None, e or None) for r, c, e in zip(raw, charset, encoding)], dtype=object)


def decoded(raw: Column, charset: Column | None = None, encoding: Column | None = None) -> Column:
    """Pages' bytes as text, given the header's charset and content encoding where they are known."""
    none = F.lit(None).cast("string")
    return _decoded(raw, none if charset is None else charset, none if encoding is None else encoding)


@F.pandas_udf(StringType())
def nfc(texts: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else unicodedata.normalize("NFC", t) for t in texts], dtype=object)


def sound(text: Column) -> Column:
    """Whether a page has 100 characters or more, space at its ends aside, and a tag that opens one."""
    return (F.length(F.regexp_replace(text, r"^\s+|\s+$", "")) >= 100) & F.lower(text).rlike("<html|<!doctype|<body")
