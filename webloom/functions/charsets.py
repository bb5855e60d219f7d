"""Which charset bytes are in, told by what they would say in each: its common characters against its odd ones."""

from __future__ import annotations

import codecs
import re

#: Byte order marks.
MARKS = ((codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF32_LE, "utf-32"), (codecs.BOM_UTF32_BE, "utf-32"), (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16"))
#: A guess counts above this.
SURE = 0.7
#: JIS X 0208: the kanji of level 1 are in daily use, those of level 2 are rare.
LEVEL_1 = "".join(bytes([row, cell]).decode("euc_jp", errors="ignore") for row in range(0xB0, 0xD0) for cell in range(0xA1, 0xFF))
#: Weight of characters of a class in Japanese text; others count 0. Halfwidth kana are what EUC-JP looks like as Shift_JIS.
JAPANESE = ((1.0, re.compile("[、。「-』・ーぁ-ゖァ-ヺ！-～　]+")), (0.95, re.compile(f"[{LEVEL_1}]+")), (0.4, re.compile(f"(?:(?![{LEVEL_1}])[一-鿿])+")), (0.2, re.compile("[｡-ﾟ]+")))
#: The same for western text: accented letters beside plain ones, the French word à, and marks of print.
WESTERN = ((0.95, re.compile("(?<=[A-Za-z])[À-ÖØ-öø-ÿŒœŠšŽž]{1,2}|[À-ÖØ-öø-ÿŒœŠšŽž]{1,2}(?=[A-Za-z])")), (0.95, re.compile(r"(?<![^\W\d_])[àÀ](?![^\W\d_])")), (0.9, re.compile("[‘-„–—…•€™\u00a0©«®°·»]")))
HIGH = re.compile(r"[^\x00-\x7f]")
TRIED = (("euc_jp", JAPANESE), ("cp932", JAPANESE), ("cp1252", WESTERN))


def guess(raw: bytes) -> tuple[str, float]:
    """The likeliest charset and how likely it is, from 0 to 1. Bytes without any sign of one are utf-8, surely.

    Few characters beyond ASCII make a guess less sure. All bytes are looked at.
    """
    for mark, name in MARKS:
        if raw.startswith(mark):
            return name, 1.0
    if raw.isascii():
        if b"\x1b$" in raw and decodes(raw, "iso2022_jp") is not None:
            return "iso2022_jp", 0.99
        return "utf-8", 1.0
    text = decodes(raw, "utf-8")
    if text is not None:  # other charsets' text hardly ever is valid utf-8
        return "utf-8", certainty(len(HIGH.findall(text)))
    best = ("utf-8", 0.0)
    for name, classes in TRIED:
        text = decodes(raw, name)
        if text is not None:
            n = len(HIGH.findall(text))
            found = certainty(n) * sum(w * sum(map(len, c.findall(text))) for w, c in classes) / n
            best = max(best, (name, found), key=lambda x: x[1])
    return best


def certainty(n: int) -> float:
    return 1 - 0.5 ** (n + 1)


def decodes(raw: bytes, name: str) -> str | None:
    try:
        return raw.decode(name)
    except UnicodeDecodeError:
        return None
