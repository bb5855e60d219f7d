"""A list and a web, as fetchers of tests: importable wherever tasks run."""

from webloom.sources.web import Reply

ITEM = '<li class="c-post-list__item"><a class="c-post-list__title-link" href="/d/{n}">x</a><a class="c-post-list__link" href="https://s{n}.jp/">s</a></li>'
FILLED = "<p>" + "words of a page " * 10 + "</p>"
PAGE = f"""<html><head><link rel="stylesheet" href="/m.css"><link rel="stylesheet" href="/x/m.css"><style>b{{}}</style><style>c{{}}</style>
<script src="/a.js"></script><script>run()</script></head><body><img src="/i.png"><img src="/t.png">{FILLED}</body></html>"""


def listing(start: int, size: int) -> str | None:
    return {0: ITEM.format(n=1) + ITEM.format(n=2), 20: ITEM.format(n=3) + ITEM.format(n=1), 40: "no items"}.get(start)


def web(url: str) -> Reply | None:
    if "s2.jp" in url or url.endswith("/m.css") and "/x/" not in url:
        raise OSError(url)
    if url.endswith(".css"):
        return Reply(b"a{}")
    if url.endswith(".js"):
        return Reply(b"js")
    if url.endswith(".png"):
        return Reply(b"\x89\xff", content_type="image/png" if "i.png" in url else "text/html")
    if "/d/3" in url:
        return None
    return Reply(PAGE.encode("shift_jis"), "shift_jis")


def gaps(start: int, size: int) -> str | None:
    """Pages 0 and 1, two empty ones, page 4, then nothing any more: what comes after three empty ones is never asked for."""
    return {0: ITEM.format(n=0), 1: ITEM.format(n=1), 4: ITEM.format(n=4), 9: ITEM.format(n=9)}.get(start // size, " ")


def model(prompt: str) -> str | None:
    """Answers for one kind of site alone."""
    if "Categories: beauty, web\n" in prompt and "CSS files: 1 file(s)" in prompt and "Layout: Grid-based" in prompt:
        return " - answered\n"
    raise RuntimeError("no answer")
