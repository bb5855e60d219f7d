"""Character references of HTML as text, in one pass over a text's tokens."""

from __future__ import annotations

from html.entities import html5

from .dialect import Spark

#: Between entries, and between a name and its characters: no entity stands for them.
ENTRY, PAIR = "\x01", "\x02"
#: Found first, since an engine may search a map from its start; then the names that need no semicolon, then the others.
COMMON = ("amp;", "nbsp;", "lt;", "gt;", "quot;", "copy;")
#: Names that count without a semicolon, longer ones first.
BARE = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
#: What the numbers 128 to 159 stand for: windows-1252, themselves where it has none.
C1 = "".join(bytes([n]).decode("cp1252", errors="ignore") or chr(n) for n in range(128, 160))
TOKEN = "&#[xX][0-9a-fA-F]+;?|&#[0-9]+;?|&[A-Za-z][A-Za-z0-9]*;?|[^&]+|&"


def names() -> str:
    rank = {n: i for i, n in enumerate((*COMMON, *BARE))}
    return ENTRY.join(n + PAIR + html5[n] for n in sorted(html5, key=lambda n: (rank.get(n, len(rank)), n)))


def numeric(d: Spark, n: str) -> str:
    """The character of a number; U+FFFD for what is none, nothing for controls and for points that are no characters."""
    return f"""CASE WHEN {n} IS NULL OR {n} = 0 OR {n} > 1114111 OR {n} BETWEEN 55296 AND 57343 THEN '�' WHEN {n} BETWEEN 128 AND 159 THEN substring('{C1}', CAST({n} - 127 AS INT), 1)
        WHEN {n} BETWEEN 1 AND 8 OR {n} = 11 OR {n} BETWEEN 14 AND 31 OR {n} = 127 OR {n} BETWEEN 64976 AND 65007 OR {n} % 65536 >= 65534 THEN '' ELSE {d.character(n)} END"""


def unescaped(d: Spark, x: str) -> str:
    """x with its references decoded, each once: &amp;lt; gives &lt;. Null for null."""
    table = d.map_of(names(), ENTRY, PAIR)
    bare = d.find("x", f"^&({'|'.join(BARE)})")
    decimal, hexadecimal = d.number(d.find("x", "^&#0*([0-9]{1,9});?$")), d.hex_number(d.find("x", "^&#[xX]0*([0-9a-fA-F]{1,7});?$"))
    named = f"coalesce({d.at(table, 'substring(x, 2)')}, CASE WHEN {bare} <> '' THEN concat({d.at(table, bare)}, substring(x, length({bare}) + 2)) END, x)"
    one = f"CASE WHEN substring(x, 1, 1) <> '&' OR x = '&' THEN x WHEN {d.matches('x', '^&#[xX]')} THEN {numeric(d, hexadecimal)} WHEN substring(x, 2, 1) = '#' THEN {numeric(d, decimal)} ELSE {named} END"
    return f"CASE WHEN contains({x}, '&') THEN {d.join(d.each(d.find_all(x, TOKEN, 0), one), '')} ELSE {x} END"
