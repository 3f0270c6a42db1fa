"""Personal data by anchor expansion: an Aho-Corasick pass finds anchors, local parsers grow and check spans there.

Anchors are at-signs, plus signs, digits, `://` and cues such as `IBAN`. Base kinds are what the patterns below match,
leftmost and without overlap within a kind; a match that fails its check is dropped and not tried again at a later
start. Kinds of the method's own come from schemes and cues and never take the place of a base span:

* `login`: the user and password of an address, `scheme://user:password@host`;
* `iban`: letters and digits after a cue whose check number is right;
* `account`: 6 to 17 digits after a cue.

Spans count code points, end exclusive. A null text is empty and has no spans. Repeated rows are searched one by one.
Texts are read whole; a text's work is linear in its length.
"""

from __future__ import annotations

import hashlib
import re
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from barsieve.llm.common import add_columns

# What a base span is.
BASE = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

ADDED = ("login", "iban", "account")
CUES = {
    "iban": ("IBAN", "Iban", "iban"),
    "account": ("account", "Account", "ACCOUNT", "acct", "Acct", "Konto", "konto", "cuenta", "Cuenta", "compte", "Compte"),
}
_LOGIN = re.compile(r"[^\s/@:]{1,256}:[^\s/@]{1,256}@(?=[A-Za-z0-9-])")
_IBAN = re.compile(r"[\s:#.]{0,4}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})")
_ACCOUNT = re.compile(r"(?:\x20?(?:number|no\.?|nummer|Nr\.?))?[\s:#]{0,4}([0-9]{6,17})(?![0-9])")

Span = tuple[str, int, int]


@cache
def _anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, words in {"at": "@", "plus": "+", "digit": "0123456789", "login": ("://",), **CUES}.items():
        for word in words:
            found.add_word(word, kind)
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right."""
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isascii() and c.isdigit())


def iban_length(text: str) -> int:
    """How much of a text, from its start, is an account number with a right check number; 0 if none."""
    plain, ends = "", []
    for k, c in enumerate(text):
        if c != " ":
            plain += c
            ends.append(k + 1)
    for n in range(min(34, len(plain)), 14, -1):
        moved = plain[4:n] + plain[:4]
        if int("".join(str(int(c, 36)) for c in moved)) % 97 == 1:
            return ends[n - 1]
    return 0


class _Search:
    """The spans of one text; `after` is where the last match of each kind ended, kept or not."""

    def __init__(self, text: str):
        self.text = text
        self.after = dict.fromkeys((*BASE, *ADDED), 0)
        self.spans: list[Span] = []

    def take(self, kind: str, start: int, end: int, valid: bool = True) -> None:
        self.after[kind] = end
        if valid:
            self.spans.append((kind, start, end))

    def at(self, i: int) -> None:
        start, low = i, self.after["email"]
        while start > low and self.text[start - 1] in _LOCAL:
            start -= 1
        if low <= start < i and (m := _DOMAIN.match(self.text, i + 1)):
            self.take("email", start, m.end())

    def plus(self, i: int) -> None:
        if i >= self.after["phone"] and (m := _PHONE.match(self.text, i)):
            self.take("phone", i, m.end(), 9 <= len(_digits(m[0])) <= 15)

    def digit(self, i: int) -> None:
        first = not (i and self.text[i - 1] in "0123456789")
        if first and i >= self.after["ip"] and (m := _IP.match(self.text, i)):
            self.take("ip", i, m.end(), all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")))
        if i >= self.after["card"] and (m := _CARD.match(self.text, i)):
            digits = _digits(m[0]) if m.end() - i <= 64 else ""
            self.take("card", i, m.end(), 12 <= len(digits) <= 19 and luhn(digits))

    def login(self, i: int) -> None:
        if m := _LOGIN.match(self.text, i + 3):
            self.take("login", i + 3, m.end() - 1)

    def iban(self, end: int) -> None:
        m = _IBAN.match(self.text, end)
        if m and m.start(1) >= self.after["iban"] and (n := iban_length(m[1])):
            self.take("iban", m.start(1), m.start(1) + n)

    def account(self, end: int) -> None:
        m = _ACCOUNT.match(self.text, end)
        if m and m.start(1) >= self.after["account"]:
            self.take("account", m.start(1), m.end(1))


def find(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans, of a text; by start, then by kind as listed."""
    if not text:
        return [], []
    search = _Search(text)
    for last, kind in _anchors().iter(text):
        if kind == "login":
            search.login(last - 2)
        elif kind in CUES:
            getattr(search, kind)(last + 1)
        else:
            getattr(search, kind)(last)
    rank = {k: n for n, k in enumerate((*BASE, *ADDED))}
    spans = sorted(search.spans, key=lambda s: (s[1], rank[s[0]]))
    return [s for s in spans if s[0] in BASE], spans


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def personal_data(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The rows with counts of base spans, the digest of their list, and the list of all spans."""

    def search(block: pa.RecordBatch) -> dict[str, object]:
        out: dict[str, list] = {f"n_{k}": [] for k in BASE} | {"base_sha256": [], "spans": []}
        for text in block.column("text").to_pylist():
            base, spans = find(text)
            for kind in BASE:
                out[f"n_{kind}"].append(sum(s[0] == kind for s in base))
            out["base_sha256"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
            out["spans"].append(_joined(spans))
        return out

    added = ", ".join(f"n_{k} long" for k in BASE) + ", base_sha256 string, spans string"
    return add_columns(docs, search, added, keep)


def redacted(text: str, spans: str) -> str:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first names the whole."""
    out, done, last = [], 0, 0
    for span in filter(None, spans.split(",")):
        kind, start, end = span.split(":")
        if int(start) >= last:
            out += [text[done : int(start)], f"[{kind}]"]
        done = last = max(last, int(end))
    return "".join(out) + text[done:]
