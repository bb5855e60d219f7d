"""Charsets of made-up pages: how many are told, and that none is told wrongly where the guess says that it is sure."""

import random

import pytest

from webloom.functions import charsets
from webloom.functions.encoding import page_text

WORDS = {
    "ja": "会社 概要 お問い合わせ サービス 東京都 診療 時間 のご案内 です。 について、 ホームページ 製品 「新着」 情報 ありがとう カフェ メニュー 美容室 予約 する 日本語 学校".split(),
    "fr": "déjà société où être français garçon élève l’été café à côté naïf – œuvre «salut» nous sommes ici avec".split(),
    "de": "Größe für Straße schön Mädchen über Öffnungszeiten „Haus“ und wir sind hier Äpfel".split(),
}
KINDS = [("ja", "utf-8"), ("ja", "cp932"), ("ja", "euc_jp"), ("ja", "iso2022_jp"), ("fr", "cp1252"), ("de", "cp1252"), ("fr", "utf-8")]


def page(rng, language, n):
    said = ("" if language == "ja" else " ").join(rng.choices(WORDS[language], k=n))
    return f"<html><head><title>{said[:20]}</title></head><body class='a b'><p>{said}</p></body></html>"


@pytest.mark.parametrize("language, name", KINDS)
def test_made_up_pages(language, name):
    rng = random.Random(7)
    texts = [page(rng, language, n) for n in (10, 50, 400) for _ in range(100)] + [page(rng, language, 3) for _ in range(100)]
    told = [page_text(t.encode(name)) for t in texts[:300]]
    right = sum(a == b for a, b in zip(told, texts))
    sure = [(charsets.guess(t.encode(name)), t) for t in texts]
    wrong = [g for g, t in sure if g[1] > charsets.SURE and t.encode(name).decode(g[0]) != t]
    assert right >= 297 and not wrong, (right, wrong[:5])  # of three words there may be too little to tell


@pytest.mark.parametrize("raw, name", [(b"", "utf-8"), (b"plain", "utf-8"), ("﻿x".encode("utf-16"), "utf-16"), (b"\xef\xbb\xbfx", "utf-8-sig"), (b"\x1b$B", "iso2022_jp"), (b"\xff\xfe\xfd", None), (b"\x81", "utf-8"), ("é".encode() * 200_000, "utf-8")])
def test_odd_bytes(raw, name):
    found, sure = charsets.guess(raw)
    assert 0 <= sure <= 1 and (name is None or found == name)
