"""Personal data, by anchors that are expanded.

One pass of an Aho-Corasick automaton finds the anchors of a text: at-signs and
their spelled forms, plus signs, digits next to each other or to a dot, URL
schemes, and words that introduce an identifier. Each kind of anchor has a
parser which looks at the characters around it, expands to the boundaries of
what may be an address, number or account, and checks it.

The base parsers give exactly the leftmost, longest, non-overlapping matches
of these expressions, of which those that fail their check are dropped:

    email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+
    ip     [0-9]+(\\.[0-9]+){3}                    parts up to 255
    card   [0-9]([\\x20-]?[0-9])+                  16 to 19 digits, Luhn
    phone  \\+[0-9][\\x20().0-9-]+[0-9]             8 to 15 digits

Spans beyond the base, which never touch a base span of the same kind:

    email   addresses with letters beyond ASCII; `name (at) host (dot) org`
    ip      IPv6 addresses, and IPv4 ones inside longer chains of numbers
    card    numbers inside a longer chain of digit groups; 13 to 15 digits after a cue
    phone   a `tel:` scheme, and numbers without a plus sign after a cue
    account IBANs by their check digits, social security numbers, numbers after a cue
    secret  what follows a cue like `token =`, and the `user:password` of a URL
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from functools import cache
from ipaddress import AddressValueError, IPv6Address

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowscribe.llm.common import numbered, pick, position, rows_of

#: The kinds, in the order in which they are listed; those of the base come first.
KINDS = ("email", "ip", "card", "phone", "account", "secret")
BASE_KINDS = KINDS[:4]

#: The characters of the base expressions.
DIGITS = frozenset("0123456789")
LABEL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-")
LOCAL = LABEL | frozenset("._%+")
DIALLED = DIGITS | frozenset(" ().-")

#: Words that introduce an identifier, in lower case.
PHONE_CUES = ("phone", "tel.", "tel:", "mobile", "telefon", "teléfono", "téléphone", "fax")
ACCOUNT_CUES = ("account", "konto", "compte", "cuenta", "ssn", "social security", "passport", "routing", "tax id")
SECRET_CUES = ("token", "password", "passwd", "secret", "api_key", "apikey", "api key", "access_key", "private_key")
CARD_CUES = ("card", "karte", "carte", "tarjeta")
SPELLED_AT = ("(at)", "[at]", "{at}")

_WIDE_LOCAL = re.compile(r"[\w.%+-]+\Z")
_WIDE_DOMAIN = re.compile(r"(?:[^\W_](?:[\w-]{0,61}[^\W_])?\.)+[^\W\d_]{2,63}")
_SPELLED_DOMAIN = re.compile(r"\s?([A-Za-z0-9-]{1,63}(?:\s?(?:\(dot\)|\[dot\]|\{dot\}|\.)\s?[A-Za-z0-9-]{1,63}){0,5}\s?(?:\(dot\)|\[dot\]|\{dot\}|\.)\s?[A-Za-z]{2,24})\b")
_SPELLED_LOCAL = re.compile(r"[A-Za-z0-9._%+-]{1,64}(?=\s?\Z)")
_CUE_NUMBER = re.compile(r"\s?(?:number|nummer|no\.?|nr\.?|num\.?|#)?\s?[:=#]?\s?(\(?[0-9](?:[\s()./-]{0,2}[0-9]){5,18})(?![0-9])")
_SECRET = re.compile(r"[\"']?\s?(?::=|=>|[:=])\s?(?:\"([^\"\s]{8,512})\"|'([^'\s]{8,512})'|([A-Za-z0-9_./+=~-]{8,512}))")
_USERINFO = re.compile(r"([^\s/?#@:\"'<>]{1,64}:[^\s/?#@\"'<>]{1,128})@")
_TEL = re.compile(r"\+?[0-9][0-9().-]{5,20}[0-9]")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_IPV6 = re.compile(r"[0-9A-Fa-f:]{3,39}")
#: Lengths of an IBAN by country, those in frequent use.
IBAN_LENGTHS = {
    "AT": 20, "BE": 16, "CH": 21, "CZ": 24, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22,
    "GR": 27, "HU": 28, "IE": 22, "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "SE": 24,
}

Span = tuple[int, int, int, bool]


def luhn(digits: str) -> bool:
    """Whether a number passes the check of the last digit."""
    twice = [2 * int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(d - 9 if d > 9 else d for d in twice)) % 10 == 0


def iban_checks(text: str) -> bool:
    """Whether an account number without blanks has its country's length and check digits."""
    if IBAN_LENGTHS.get(text[:2]) != len(text):
        return False
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


@cache
def anchors() -> ahocorasick.Automaton:
    """The automaton of all anchors; a value names the parsers that an anchor starts."""
    found = ahocorasick.Automaton()
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    found.add_word("::", ("colons", 2))
    found.add_word("://", ("scheme", 3))
    for digit in DIGITS:
        found.add_word(digit + ".", ("dot", 2))
        for other in DIGITS:
            for between in ("", " ", "-"):
                found.add_word(digit + between + other, ("digits", 2 + len(between)))
        for letter in "0123456789abcdefABCDEF":
            found.add_word(f"{letter}:{digit}", ("colons", 3))
    for country in IBAN_LENGTHS:
        for digit in DIGITS:
            found.add_word(country + digit, ("iban", 3))
    for name, words in (("phone_cue", PHONE_CUES), ("account_cue", ACCOUNT_CUES), ("secret_cue", SECRET_CUES), ("card_cue", CARD_CUES), ("spelled_at", SPELLED_AT)):
        for word in words:
            for form in {word, word.capitalize(), word.upper()}:
                found.add_word(form, (name, len(form)))
    found.make_automaton()
    return found


class Finder:
    """The spans of one text. Anchors come in the order in which they end."""

    def __init__(self, text: str) -> None:
        self.text, self.size = text, len(text)
        #: Ends of what the base parsers have matched, kept or dropped, by kind.
        self.end = dict.fromkeys(BASE_KINDS, 0)
        self.base: list[Span] = []
        #: (kind, start, end) of what may be beyond the base, and what of it is.
        self.more: list[tuple[str, int, int]] = []
        self.extra: list[Span] = []

    def spans(self) -> list[Span]:
        """(kind, start, end, of the base) of every span, by kind, start and end."""
        for last, (name, length) in anchors().iter(self.text):
            getattr(self, name)(last + 1 - length, last + 1)
        for kind, name in enumerate(KINDS):
            # Base spans of a kind ascend and don't overlap, so the last that starts before an end decides.
            own = [span[1:3] for span in self.base if span[0] == kind]
            reached, extra = 0, []
            for start, end in sorted({span[1:] for span in self.more if span[0] == name}, key=lambda s: (s[0], -s[1])):
                before = bisect.bisect_left(own, (end,)) - 1
                if start >= reached and (before < 0 or own[before][1] <= start):
                    extra.append((kind, start, end, False))
                    reached = end
            self.extra += extra
        return sorted(self.base + self.extra)

    def run(self, at: int, allowed: frozenset, most: int | None = None) -> int:
        """Where a run of allowed characters from `at` on ends."""
        text, end = self.text, self.size if most is None else min(self.size, at + most)
        while at < end and text[at] in allowed:
            at += 1
        return at

    # --- base -----------------------------------------------------------------

    def at(self, start: int, end: int) -> None:
        """An at-sign: an email address around it."""
        first = start
        while first > self.end["email"] and self.text[first - 1] in LOCAL:
            first -= 1
        stop = self.run(end, LABEL)
        labels = 0
        if first < start and stop > end:
            while stop < self.size and self.text[stop] == ".":
                after = self.run(stop + 1, LABEL)
                if after == stop + 1:
                    break
                stop, labels = after, labels + 1
        if labels:
            self.base.append((0, first, stop, True))
            self.end["email"] = stop
        else:
            self.wide_email(start, end)

    def dot(self, start: int, end: int) -> None:
        """A digit and a dot: four numbers joined by dots, and after them four more."""
        if start < self.end["ip"]:
            return
        text = self.text
        while start > self.end["ip"] and text[start - 1] in DIGITS:
            start -= 1
        while True:
            parts, at = [], start
            while len(parts) < 4:
                stop = self.run(at, DIGITS)
                if stop == at:
                    break
                parts.append((at, stop))
                at = stop + 1
                if len(parts) < 4 and text[stop : stop + 1] != ".":
                    break
            if len(parts) < 4:
                # The numbers that were read can't start a match either, each has fewer after it.
                self.end["ip"] = max(self.end["ip"], parts[-1][1] if parts else end)
                return
            self.end["ip"] = parts[-1][1]
            if all(_part(text[a:b]) for a, b in parts):
                self.base.append((1, start, self.end["ip"], True))
            if text[self.end["ip"] : self.end["ip"] + 1] != ".":
                return
            start = self.end["ip"] + 1

    def digits(self, start: int, end: int) -> None:
        """Two digits next to each other: the whole chain of digits, single blanks and hyphens."""
        if start < self.end["card"]:
            return
        text, groups = self.text, []
        while True:
            stop = self.run(start, DIGITS)
            groups.append((start, stop))
            if stop + 1 < self.size and text[stop] in " -" and text[stop + 1] in DIGITS:
                start = stop + 1
            else:
                break
        self.end["card"] = groups[-1][1]
        total = sum(b - a for a, b in groups)
        if 16 <= total <= 19 and luhn("".join(text[a:b] for a, b in groups)):
            self.base.append((2, groups[0][0], groups[-1][1], True))
        elif len(groups) > 1:
            self.inner_cards(groups)
        if len(groups) >= 3:
            self.social(groups)

    def plus(self, start: int, end: int) -> None:
        """A plus sign: a digit, what is dialled, and the last digit of that."""
        if end >= self.size or self.text[end] not in DIGITS:
            return
        stop = self.run(end + 1, DIALLED)
        while stop > end + 1 and self.text[stop - 1] not in DIGITS:
            stop -= 1
        if stop < end + 3:
            return
        self.end["phone"] = stop
        if 8 <= sum(c in DIGITS for c in self.text[start:stop]) <= 15:
            self.base.append((3, start, stop, True))

    # --- beyond the base -------------------------------------------------------

    def wide_email(self, start: int, end: int) -> None:
        found = _WIDE_LOCAL.search(self.text[max(0, start - 64) : start])
        domain = _WIDE_DOMAIN.match(self.text, end)
        if found and domain:
            self.more.append(("email", start - len(found[0]), domain.end()))

    def spelled_at(self, start: int, end: int) -> None:
        low = max(0, start - 66)
        local = _SPELLED_LOCAL.search(self.text[low:start])
        domain = _SPELLED_DOMAIN.match(self.text, end)
        if local and domain:
            self.more.append(("email", low + local.start(), domain.end(1)))

    def inner_cards(self, groups: list[tuple[int, int]]) -> None:
        """Parts of a longer chain that are a number: a group of 16 digits or more, or four of four."""
        at = 0
        while at < len(groups):
            for own in (groups[at : at + 1], groups[at : at + 4]):
                sizes = [b - a for a, b in own]
                if (len(own) == 1 and 16 <= sizes[0] <= 19) or sizes == [4, 4, 4, 4]:
                    if luhn("".join(self.text[a:b] for a, b in own)):
                        self.more.append(("card", own[0][0], own[-1][1]))
                        break
            else:
                own = groups[at : at + 1]
            at += len(own)

    def social(self, groups: list[tuple[int, int]]) -> None:
        """Three digits, two and four, with hyphens, as a chain of its own."""
        start, end = groups[0][0], groups[-1][1]
        if len(groups) == 3 and _SSN.fullmatch(self.text, start, end):
            area, group, serial = (self.text[a:b] for a, b in groups)
            if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
                self.more.append(("account", start, end))

    def colons(self, start: int, end: int) -> None:
        """Colons among hexadecimal digits: an IPv6 address."""
        first = start
        while first > max(0, start - 39) and self.text[first - 1] in "0123456789abcdefABCDEF:":
            first -= 1
        found = _IPV6.match(self.text, first)
        if not found or found[0].count(":") < 2:
            return
        before, after = self.text[first - 1 : first] if first else "", self.text[found.end() : found.end() + 1]
        if before.isalnum() or after.isalnum():
            return
        shown = found[0].rstrip(":") if not found[0].endswith("::") else found[0]
        try:
            IPv6Address(shown)
        except AddressValueError:
            return
        # Names joined by colons may be hexadecimal too, but hardly with digits.
        if sum(c != ":" for c in shown) >= 3 and any(c in DIGITS for c in shown):
            self.more.append(("ip", first, first + len(shown)))

    def scheme(self, start: int, end: int) -> None:
        found = _USERINFO.match(self.text, end)
        if found:
            self.more.append(("secret", found.start(1), found.end(1)))

    def iban(self, start: int, end: int) -> None:
        if start and self.text[start - 1].isalnum():
            return
        found = _IBAN.match(self.text, start)
        if found:
            # Words of capitals may follow the number; its length is that of its country.
            size, at = IBAN_LENGTHS[found[0][:2]], start
            for _ in range(size):
                at += self.text[at : at + 1] == " "
                at += 1
            after = self.text[at : at + 1]
            if at <= self.size and not after.isalnum() and iban_checks(self.text[start:at].replace(" ", "")):
                self.more.append(("account", start, at))

    def _number(self, start: int, end: int) -> tuple[int, int, str] | None:
        if start and self.text[start - 1].isalnum():
            return None
        found = _CUE_NUMBER.match(self.text, end)
        return (found.start(1), found.end(1), re.sub("[^0-9]", "", found[1])) if found else None

    def phone_cue(self, start: int, end: int) -> None:
        found = self._number(start, end) or (self._tel(end) if self.text[end - 1] == ":" else None)
        if found and 7 <= len(found[2]) <= 15:
            self.more.append(("phone", found[0], found[1]))

    def _tel(self, end: int) -> tuple[int, int, str] | None:
        found = _TEL.match(self.text, end)
        return (found.start(), found.end(), re.sub("[^0-9]", "", found[0])) if found else None

    def card_cue(self, start: int, end: int) -> None:
        found = self._number(start, end)
        if found and 13 <= len(found[2]) <= 15 and luhn(found[2]):
            self.more.append(("card", found[0], found[1]))

    def account_cue(self, start: int, end: int) -> None:
        found = self._number(start, end)
        if found and len(found[2]) >= 6:
            self.more.append(("account", found[0], found[1]))

    def secret_cue(self, start: int, end: int) -> None:
        if start and self.text[start - 1].isalpha():
            return
        found = _SECRET.match(self.text, end)
        if found:
            group = next(i for i in (1, 2, 3) if found[i] is not None)
            value = found[group]
            # Words are no secrets: a value has digits, or mixes its letters' case.
            if any(c.isdigit() for c in value) or (value.lower() != value and value.upper() != value and value.capitalize() != value):
                self.more.append(("secret", found.start(group), found.end(group)))


def _part(digits: str) -> bool:
    """Whether a number of any length is at most 255."""
    significant = digits.lstrip("0")
    return len(significant) < 3 or (len(significant) == 3 and significant <= "255")


def find(text: str | None) -> list[Span]:
    """The spans of a text, by kind, start and end; none of a null one."""
    return Finder(text).spans() if text else []


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span, and spans that overlap as one, replaced by the first's kind."""
    out, at = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind]}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


SPAN = "struct<kind:string,start:long,stop:long,base:boolean>"


def find_pii(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans) of every whole text: (kind, start, stop, base) in code points, by
    kind as listed, start and stop.

    A null or empty text has no spans. Rows are not compared, so repeated and null ids
    stay as they are; other columns are left out. An empty table gives no rows.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in rows_of(batches):
            spans = [[{"kind": KINDS[k], "start": a, "stop": b, "base": own} for k, a, b, own in find(t)] for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(spans, kind)], ["doc_id", "spans"])

    docs = pick(df, doc_id=doc_id, text=text)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, f"doc_id long, spans array<{SPAN}>")


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows, with all their columns, their texts with every span replaced by its kind
    in angle brackets. A null text stays null."""

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        return pa.array([t and redacted(t, find(t)) for t in texts.to_pylist()], pa.string())

    frame, at = numbered(df), position(df, text)
    return frame.withColumn(at, clean(F.col(at).cast("string"))).toDF(*df.columns)


def listed(spans: Column, base_only: bool = False) -> Column:
    """kind:start:stop of the spans, joined by commas."""
    chosen = F.filter(spans, lambda s: s["base"]) if base_only else spans
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    """The number of base spans of a kind."""
    return F.size(F.filter(spans, lambda s: s["base"] & (s["kind"] == kind))).cast("long")
