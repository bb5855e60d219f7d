"""Labelled findings for secret scans: made-up lines around made-up secrets, and around what only looks like one.

No real secret is in them. A line's label says what its maker made, not what a pattern finds in it.
"""

from __future__ import annotations

import random
import string
import uuid
from collections.abc import Callable
from typing import NamedTuple

LOWER, UPPER, DIGITS = string.ascii_lowercase, string.ascii_uppercase, string.digits
ALNUM, HEX = LOWER + UPPER + DIGITS, "0123456789abcdef"
#: Words that names, paths and lines are made of, beside those of the corpus.
WORDS = tuple(
    "user account settings image header request session service client server config project module public private local common shared build release version update create delete "
    "value index table column number count limit price order status error message event handler manager factory provider context default custom search result content page title "
    "footer button layout style theme large small primary secondary main login password secret token access key api auth credential profile report data model test example sample".split()
)
#: What stands before a secret or, of the second kind, before a harmless number of the same look.
CUES = ("token", "api_key", "apikey", "secret", "client_secret", "access_token", "auth", "password", "passwd", "pwd", "private_key", "secret_key", "bearer", "credential")
HARMLESS = ("commit", "revision", "sha1", "sha256", "md5", "checksum", "etag", "digest", "hash", "uuid", "request_id", "trace_id", "build", "merge", "version", "tree", "fingerprint", "object")


class Finding(NamedTuple):
    """A line of text, those of its runs that are labelled, the label (1 a secret, 0 none), and how it was made."""

    text: str
    runs: tuple[str, ...]
    label: int
    family: str


class Maker:
    """Makes findings; the same for the same seed and words."""

    def __init__(self, words: list[str], seed: int):
        self.rng, self.words = random.Random(seed), [*WORDS, *words]

    def of(self, letters: str, n: int, most: int | None = None) -> str:
        return "".join(self.rng.choices(letters, k=self.rng.randint(n, most or n)))

    def word(self) -> str:
        return self.rng.choice(self.words)

    def prose(self, n: int) -> str:
        return " ".join(self.word() for _ in range(self.rng.randint(0, n)))

    def host(self) -> str:
        return f"https://{self.word()}.example.{self.rng.choice(('com', 'org', 'net'))}"

    def said(self, cues: tuple[str, ...], run: str) -> str:
        """run, given to one of the cues in one of the ways in which that is written."""
        cue = self.rng.choice(cues)
        cue = self.rng.choice((cue, cue.upper(), cue.title(), f"{self.word()}_{cue}", f"{cue} "))
        form = self.rng.choice(('{c}={r}', '{c} = "{r}"', "{c}: {r}", '"{c}": "{r}",', "{c}:{r}", "export {c}='{r}'", "{c} {r}", "{r} ({c})", "<{c}>{r}</{c}>", "?{c}={r}&x=1", '{{"{n}":"x","{c}":"{r}","y":1}}', "{{{n}:1,{c}:'{r}'}}"))
        return form.format(c=cue, r=run, n=self.rng.choice((self.word(), f"{self.word()}_{self.word()}_{self.rng.choice((self.word(), *HARMLESS))}")))

    def secret_key(self) -> str:
        return self.rng.choice((lambda: self.of(HEX, 32), lambda: self.of(HEX, 40), lambda: self.of(HEX, 64), lambda: self.of(HEX.upper(), 40), lambda: self.of(ALNUM, 20, 44), lambda: self.of(ALNUM + "+/", 40), lambda: self.of(ALNUM + "-_", 22, 64)))()

    # each of the following returns the text around which prose goes, and its runs

    def assigned(self) -> tuple[str, ...]:
        run = self.secret_key()
        return self.said(CUES, run), run

    def password(self) -> tuple[str, ...]:
        chosen = "".join(self.rng.choice((self.word(), self.word().title())) + self.of(DIGITS, 0, 3) for _ in range(self.rng.randint(3, 4)))
        run = self.rng.choice((self.of(ALNUM + "_-+", 16, 26), chosen.ljust(16, "7")))
        return self.said(("password", "passwd", "pwd", "pass"), run), run

    def cloud_id(self) -> tuple[str, ...]:
        run = "AKIA" + self.of(UPPER + DIGITS, 16)
        return self.rng.choice((run, self.said(("aws_access_key_id", "key", "id"), run), f"'{run}'", f"{run},")), run

    def prefixed(self) -> tuple[str, ...]:
        start, n = self.rng.choice((("ghp_", 36), ("gho_", 36), ("ghs_", 36), ("sk_live_", 24), ("pk_live_", 24), ("AIza", 35), ("glpat-", 20), ("npm_", 36), ("SG_", 40)))
        run = start + self.of(ALNUM, n)
        return self.rng.choice((run, f"{self.host()}/?{self.word()}={run}", self.said(CUES, run), f"{run}.")), run

    def chat_token(self) -> tuple[str, ...]:
        run = f"xoxb-{self.of(DIGITS, 10, 12)}-{self.of(DIGITS, 10, 12)}-{self.of(ALNUM, 24)}"
        return self.rng.choice((run, self.said(CUES, run))), run

    def web_token(self) -> tuple[str, ...]:
        runs = "eyJ" + self.of(ALNUM, 17, 40), "eyJ" + self.of(ALNUM + "-_", 40, 160), self.of(ALNUM + "-_", 43)
        return self.rng.choice(("{}", "Authorization: Bearer {}", "cookie: session={}", '"{}"')).format(".".join(runs)), *runs

    def in_url(self) -> tuple[str, ...]:
        run = self.of(ALNUM, 18, 40)
        return self.rng.choice((f"{self.host().replace('://', f'://{self.word()}:{run}@')}/{self.word()}", f"{self.host()}/{self.word()}?{self.rng.choice(CUES)}={run}", f"{self.host()}/hooks/{run}?{self.rng.choice(CUES)}=1")), run

    def pair(self) -> tuple[str, ...]:
        a, b = "AKIA" + self.of(UPPER + DIGITS, 16), self.of(ALNUM, 36, 40)
        return f"{a}{self.rng.choice((':', ',', ' ', ';'))}{b}", a, b

    def listed(self) -> tuple[str, ...]:
        a, b = self.secret_key(), self.secret_key()
        return self.said(CUES, a + self.rng.choice(('","', "','", ",", '", "', ";")) + b), a, b

    def key_lines(self) -> tuple[str, ...]:
        runs = tuple(self.of(ALNUM + "+/", 64) for _ in range(2))
        return f"-----BEGIN {self.rng.choice(('RSA ', 'EC ', ''))}PRIVATE KEY----- {' '.join(runs)}", *runs

    def uuids(self) -> tuple[str, ...]:
        run = str(uuid.UUID(int=self.rng.getrandbits(128)))
        return self.rng.choice((run, self.said(HARMLESS, run), f"{self.host()}/{self.word()}/{run}", f'"id":"{run}"', f"{{{run}}}", f"{self.word()} {run}")), run

    def sums(self) -> tuple[str, ...]:
        run = self.of(HEX, self.rng.choice((32, 40, 64)))
        return self.rng.choice((self.said(HARMLESS, run), f"{run}  {self.word()}.zip", f"{self.host()}/{self.word()}/commit/{run}", f"{self.word()}@sha256:{run}", f"index {run} {self.word()}", f"{self.word()} {run} {self.word()}")), run

    def integrity(self) -> tuple[str, ...]:
        run = f"sha{self.rng.choice((256, 384, 512))}-{self.of(ALNUM + '+/', 43, 88)}"
        return f'integrity="{run}"', f"{run}"

    def images(self) -> tuple[str, ...]:
        run = self.rng.choice(("iVBORw0KGgo", "R0lGODlh", "/9j/4AAQSk")) + self.of(ALNUM + "+/", 40, 200)
        return f"url(data:image/png;base64,{run})", run

    def paths(self) -> tuple[str, ...]:
        run = "/".join(self.word() + self.rng.choice(("", "", "-" + self.word(), self.of(DIGITS, 1, 2))) for _ in range(self.rng.randint(3, 7)))
        return self.rng.choice((f"/{run}", f"{self.host()}/{run}.html", f"./{run}.py", run, f"see {run}")), run

    def names(self) -> tuple[str, ...]:
        parts = [self.word() for _ in range(self.rng.randint(3, 6))]
        parts += self.rng.choice(([], [], [self.of(DIGITS, 1, 4)], ["2024"], ["v2"]))
        camel = parts[0] + "".join(p.title() for p in parts[1:])
        run = self.rng.choice(("_".join(parts), "-".join(parts), camel, camel[:1].upper() + camel[1:], "_".join(parts).upper()))
        return self.rng.choice((run, f"{run}()", f"{run}=true", f"{self.host()}/{run}", f'"{run}": "x"', self.said(HARMLESS, run), f".{run} {{", f"utm_campaign={run}")), run

    def long_words(self) -> tuple[str, ...]:
        run = "".join(self.word() for _ in range(self.rng.randint(3, 6)))
        return self.rng.choice((run, run.title(), run.upper(), f"{run},")), run

    def foreign_words(self) -> tuple[str, ...]:
        pick = self.rng.choice
        run = "".join(pick(("b", "ch", "d", "f", "g", "h", "k", "l", "m", "n", "p", "r", "s", "sch", "st", "t", "th", "tr", "v", "w", "z")) + pick("aeiouy") + pick(("", "", "u", "i", "ch", "l", "n", "ng", "nd", "r", "s", "ss", "t", "tz")) for _ in range(8))
        return pick((run, run.title(), run.upper(), f"{run}.")), run

    def numbers(self) -> tuple[str, ...]:
        run = self.rng.choice((self.of(DIGITS, 16, 22), f"{self.of(DIGITS, 4)}-{self.of(DIGITS, 4)}-{self.of(DIGITS, 4)}-{self.of(DIGITS, 4)}", f"+49-{self.of(DIGITS, 4)}-{self.of(DIGITS, 8)}", f"2024-0{self.of('1234', 1)}-1{self.of(DIGITS, 1)}T10-2{self.of(DIGITS, 1)}-00"))
        return self.rng.choice((run, self.said(("number", "phone", "isbn", "order", "card", "time"), run))), run

    def lines(self) -> tuple[str, ...]:
        run = self.rng.choice("-=_+/") * self.rng.randint(16, 80)
        return run, run


SECRETS: tuple[Callable[[Maker], tuple[str, ...]], ...] = (Maker.assigned, Maker.assigned, Maker.password, Maker.cloud_id, Maker.prefixed, Maker.chat_token, Maker.web_token, Maker.in_url, Maker.pair, Maker.listed, Maker.key_lines)
PLAIN: tuple[Callable[[Maker], tuple[str, ...]], ...] = (Maker.uuids, Maker.sums, Maker.sums, Maker.integrity, Maker.images, Maker.paths, Maker.names, Maker.names, Maker.long_words, Maker.foreign_words, Maker.foreign_words, Maker.numbers, Maker.lines)


def made(words: list[str], n: int, seed: int, without: tuple[str, ...] = ()) -> list[Finding]:
    """n findings, half of either label, by all families in turn but those in `without`."""
    maker, out = Maker(words, seed), []
    for label, makers in ((1, SECRETS), (0, PLAIN)):
        makers = [m for m in makers if m.__name__ not in without]
        for i in range(n // 2):
            text, *runs = makers[i % len(makers)](maker)
            out.append(Finding(" ".join(filter(None, (maker.prose(4), text, maker.prose(4)))), tuple(runs), label, makers[i % len(makers)].__name__))
    return out
