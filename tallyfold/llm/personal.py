"""Personal data by anchor expansion.

One Aho-Corasick automaton finds the anchors in a whole text: at-signs, plus signs, digits, colons, schemes
(``mailto:``, ``tel:``, ``https://``) and words that announce an identifier. At each anchor a parser walks to both
sides over the characters its kind may hold and decides there; none looks at a character twice for one kind, so
the time is linear in the text whatever it holds. Kinds:

* ``email``: at-sign, local part to the left, labels to the right;
* ``ip``: four numbers of at most 255 between dots, taken in fours from a longer chain;
* ``card``: 16 to 19 digits with single blanks or hyphens between, and the Luhn check;
* ``phone``: plus sign and 8 to 15 digits;
* ``intl``: an address with characters beyond ASCII in the local part or a label, or with a quoted local part;
* ``tel``: number behind ``tel:`` without a plus sign;
* ``login``: user part of an address with a scheme (``https://user:word@host``);
* ``ip6``: an address of eight groups, shortened or not, that names a single global host;
* ``iban``: country, check digits and account, groups of four allowed, by length of the country and the rest of 97;
* ``account``: an identifier of 6 to 20 letters and digits, at least 5 of them digits, behind a word that announces an
  account, insurance, tax, passport or licence number; a US insurance number must have an area, group and
  serial that are issued.

The first four are the plain patterns of ``BASE`` and are counted; the others add spans and never replace
one. ``kind:start:end`` in code points, end exclusive, by kind as listed, then start. Null and empty texts have none. One
row in, one row out, no shuffle; repeated rows give repeated results, an empty table an empty one; other columns are not
read.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.llm.common import documents, row_slices

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "intl", "tel", "login", "ip6", "iban", "account")
MAX_PART = 255
CARD_DIGITS, PHONE_DIGITS, IDENTIFIER = (16, 19), (8, 15), (6, 20)

#: Words that announce an identifier, in lower case.
CUES = (
    "account number", "account no", "account id", "acct", "routing number", "sort code", "ssn", "social security number",
    "social security no", "tax id", "taxpayer id", "passport number", "passport no", "driver license", "driver's license",
    "licence number", "license number", "customer number", "member id", "patient id", "kontonummer", "steuernummer",
    "ausweisnummer", "reisepassnummer", "sozialversicherungsnummer", "número de cuenta", "pasaporte", "número de pasaporte",
    "numéro de compte", "numéro de passeport", "numéro de sécurité sociale",
)
#: Lengths of account numbers by country (ISO 13616, as published in its registry).
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "BA": 20, "BE": 16, "BG": 22, "BR": 29, "CH": 21, "CR": 22, "CY": 28,
    "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22,
    "GI": 23, "GL": 18, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "KW": 30, "KZ": 20,
    "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MT": 31, "NL": 18,
    "NO": 15, "PK": 24, "PL": 28, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24,
    "SM": 27, "TN": 24, "TR": 26, "UA": 29, "XK": 20,
}
SCHEMES = ("http://", "https://", "ftp://", "ftps://", "sftp://", "ssh://", "ws://", "wss://", "ldap://", "smtp://", "imap://")
DIGITS = "0123456789"

# Runs that the parsers walk over; each is matched at one place only.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
LABELS = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
WIDE_LABELS = re.compile(r"[^\W_](?:[\w-]{0,61}[^\W_])?(?:\.[^\W_](?:[\w-]{0,61}[^\W_])?)+")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
SPACED = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
CALLED = re.compile(r"[0-9][\x20().0-9-]*")
GROUPS = re.compile(r"[0-9A-Fa-f:.]+")
USER = re.compile(r"[^\s/?#@\"'<>\[\]{}|\\^`]{1,512}@(?=[A-Za-z0-9\[])")
ACCOUNT = re.compile(r"(?:[\x20.]?[A-Z0-9]){11,32}")
FILLER = re.compile(r"[\x20.:#=№()-]{0,6}(?:(?:is|ist|es|est|no|nr|number)\b[\x20.:#=-]{0,4})?", re.IGNORECASE)
NAME = re.compile(r"[A-Z0-9](?:[\x20/-]?[A-Z0-9]){5,29}")


def all_cases(cue: str) -> set[str]:
    return {cue, cue.upper(), cue.title(), cue[:1].upper() + cue[1:]}


def automaton() -> ahocorasick.Automaton:
    """Anchor to what it is; longer anchors that share an end are reported along with shorter ones."""
    made = ahocorasick.Automaton()
    for anchor, what in [("@", "at"), ("+", "plus"), ("::", "colon"), *[(d, "digit") for d in DIGITS]]:
        made.add_word(anchor, (what, 1))
    # The last group of a full address follows a colon.
    for digit in "0123456789abcdefABCDEF":
        made.add_word(f":{digit}", ("colon", 2))
    for scheme in SCHEMES:
        for case in all_cases(scheme):
            made.add_word(case, ("scheme", len(case)))
    for case in all_cases("tel:"):
        made.add_word(case, ("tel", len(case)))
    for country in IBAN_LENGTHS:
        for digit in DIGITS:
            made.add_word(country + digit, ("iban", 3))
    for cue in CUES:
        for case in all_cases(cue):
            made.add_word(case, ("cue", len(case)))
    made.make_automaton()
    return made


_anchors: ahocorasick.Automaton | None = None


def anchors() -> ahocorasick.Automaton:
    """Built once per worker."""
    global _anchors
    if _anchors is None:
        _anchors = automaton()
    return _anchors


def passes_luhn(digits: str) -> bool:
    doubled = [int(d) for d in reversed(digits)]
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(doubled)) % 10 == 0


def valid_iban(account: str) -> bool:
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def issued(number: str) -> bool:
    """Area, group and serial of a US social insurance number."""
    area, group, serial = number[:3], number[3:5], number[5:]
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


class Scan:
    """The spans of one text. ``done`` says, per kind, up to where the text is settled."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
        self.done = dict.fromkeys((*KINDS, "wide"), 0)
        handlers = {"at": self.at_sign, "plus": self.plus, "digit": self.digit, "colon": self.colon,
                    "scheme": self.scheme, "tel": self.tel, "iban": self.iban, "cue": self.cue}
        for last, (what, length) in anchors().iter(text):
            handlers[what](last - length + 1, last + 1)

    def add(self, kind: str, start: int, end: int) -> None:
        self.found[kind].append((start, end))

    def at_sign(self, start: int, end: int) -> None:
        text, left = self.text, start
        floor = self.done["email"]
        # Local parts end at at-signs and hold none, so no character is passed twice.
        while left > floor and text[left - 1] in LOCAL:
            left -= 1
        labels = LABELS.match(text, end) if left < start else None
        if labels:
            self.done["email"] = labels.end()
            self.add("email", left, labels.end())
        if not labels or self.is_wide(left, labels.end()):
            self.wide_address(start, end)

    def is_wide(self, start: int, end: int) -> bool:
        """Whether the plain address is a part of one with other letters."""
        text = self.text
        before, after = text[start - 1 : start], text[end : end + 1]
        return before > "\x7f" and before.isalpha() or after > "\x7f" and after.isalpha()

    def wide_address(self, start: int, end: int) -> None:
        text, floor = self.text, self.done["wide"]
        left = start
        if text[start - 1 : start] == '"':
            # A quoted local part: at most 64 characters, so the search for its start is short.
            left = text.rfind('"', max(floor, start - 66), start - 1)
            if left < 0 or "\n" in text[left:start] or start - left < 3:
                return
        else:
            while left > floor and start - left <= 64 and (text[left - 1] in LOCAL or text[left - 1] > "\x7f" and text[left - 1].isalnum()):
                left -= 1
            if left == start or start - left > 64:
                return
        labels = WIDE_LABELS.match(text, end)
        if not labels or not labels[0].rpartition(".")[2].isalpha():
            return
        if text[left:start].isascii() and labels[0].isascii() and text[left] != '"':
            return
        self.done["wide"] = labels.end()
        self.add("intl", left, labels.end())

    def plus(self, start: int, end: int) -> None:
        run = CALLED.match(self.text, end)
        if not run:
            return
        called = run[0].rstrip(" ().-")
        # The first digit, at least one more character, and a digit.
        if len(called) > 2 and PHONE_DIGITS[0] <= sum(map(str.isdigit, called)) <= PHONE_DIGITS[1]:
            self.add("phone", start, end + len(called))

    def digit(self, start: int, end: int) -> None:
        if start >= self.done["ip"]:
            self.dotted(start)
        if start >= self.done["card"]:
            run = SPACED.match(self.text, start)
            self.done["card"] = run.end()
            if run.end() - start >= CARD_DIGITS[0]:
                digits = run[0].replace(" ", "").replace("-", "")
                if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and passes_luhn(digits):
                    self.add("card", start, run.end())

    def dotted(self, start: int) -> None:
        run = DOTTED.match(self.text, start)
        self.done["ip"] = run.end()
        parts = run[0].split(".")
        at = start
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            length = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= MAX_PART for p in four):
                self.add("ip", at, at + length)
            at += length + 1

    def colon(self, start: int, end: int) -> None:
        if start < self.done["ip6"]:
            return
        text, left = self.text, start
        while left > self.done["ip6"] and start - left < 4 and text[left - 1] in "0123456789abcdefABCDEF":
            left -= 1
        run = GROUPS.match(text, left)
        self.done["ip6"] = run.end()
        address = run[0].rstrip(".:") + ("::" if run[0].rstrip(".").endswith("::") else "")
        before, after = text[left - 1 : left], text[left + len(address) : left + len(address) + 1]
        if address.count(":") < 3 or len(address) > 45 or before.isalnum() or before == "_" or after.isalnum() or after == "_":
            return
        try:
            parsed = ipaddress.IPv6Address(address)
        except ValueError:
            return
        if parsed.is_global and not parsed.is_multicast:
            self.add("ip6", left, left + len(address))

    def scheme(self, start: int, end: int) -> None:
        user = USER.match(self.text, end)
        if user and not self.text[start - 1 : start].isalpha():
            self.add("login", end, user.end() - 1)

    def tel(self, start: int, end: int) -> None:
        run = CALLED.match(self.text, end)
        if run and not self.text[start - 1 : start].isalnum():
            called = run[0].rstrip(" ().-")
            if 6 <= sum(map(str.isdigit, called)) <= PHONE_DIGITS[1]:
                self.add("tel", end, end + len(called))

    def iban(self, start: int, end: int) -> None:
        if start < self.done["iban"] or self.text[start - 1 : start].isalnum():
            return
        run = ACCOUNT.match(self.text, start)
        if not run:
            return
        wanted, at, account = IBAN_LENGTHS[self.text[start : start + 2]], start, ""
        while len(account) < wanted and at < run.end():
            if self.text[at] not in " .":
                account += self.text[at]
            at += 1
        ends = not self.text[at : at + 1].isalnum()
        if ends and len(account) == wanted and account[2:4].isdigit() and valid_iban(account):
            self.done["iban"] = at
            self.add("iban", start, at)

    def cue(self, start: int, end: int) -> None:
        text = self.text
        if text[start - 1 : start].isalnum() or text[end : end + 1].isalpha() or end < self.done["account"]:
            return
        name = NAME.match(text, FILLER.match(text, end).end())
        if not name:
            return
        # Words behind the number are no part of it: keep parts up to the last one with a digit.
        parts = re.split(r"(\x20)", name[0])
        while parts and not any(map(str.isdigit, parts[-1])):
            parts.pop()
        value = "".join(parts)
        plain = re.sub(r"[\x20/-]", "", value)
        digits = sum(map(str.isdigit, plain))
        stop = name.start() + len(value)
        if not IDENTIFIER[0] <= len(plain) <= IDENTIFIER[1] or digits < 5 or text[stop : stop + 1].isalnum():
            return
        insured = text[start:end].lower().startswith(("ssn", "social security"))
        if insured and not (len(plain) == 9 and plain.isdigit() and issued(plain)):
            return
        self.done["account"] = stop
        self.add("account", name.start(), stop)


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def personal_spans(text: str, kinds: tuple[str, ...] = KINDS) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    found = Scan(text).found
    return [(kind, a, b) for kind in kinds for a, b in sorted(set(found[kind]))]


SCHEMA = (
    "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, n_added bigint,"
    " base_sha256 string, spans string"
)
ARROW = pa.schema(
    [(f"n_{k}", pa.int64()) for k in (*BASE, "added")] + [("base_sha256", pa.string()), ("spans", pa.string())]
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in row_slices(batch):
            out: list[list] = [[] for _ in ARROW]
            for text in rows.column(1):
                spans = personal_spans(text.as_py() or "")
                base = [s for s in spans if s[0] in BASE]
                counts = [sum(s[0] == kind for s in base) for kind in BASE]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                values = [*counts, len(spans) - len(base), digest, joined(spans)]
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            made = [pa.array(c, f.type) for c, f in zip(out, ARROW, strict=True)]
            yield pa.record_batch([rows.column(0), *made], names=["doc_id", *ARROW.names])


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts by kind, digest of the plain spans, and all spans."""
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_scan, SCHEMA)


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(documents(spark, sf_dir))
