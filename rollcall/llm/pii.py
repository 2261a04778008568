"""Operator 5: personal data by anchor expansion.

One Aho-Corasick automaton finds the anchors of a whole text in one pass: at-signs, plus signs, digits, schemes and
identifier cues.  Each anchor starts a deterministic local parser that walks left and right from it, finds the
boundary and validates what lies between; nothing backtracks, and what lies ahead of several anchors (the end of a run, the
next slash, dot or at-sign) is looked for once for all of them, so a text costs its length whatever it holds.

Base kinds (leftmost non-overlapping, failing matches dropped without a retry): email, ip (four parts to 255), card
(16 to 19 digits that pass the Luhn sum), phone (+ and 8 to 15 digits).  The method adds url (a scheme or www. up to
the last character that is no closing punctuation; mailto: with an address) and account (a cue such as "account no"
or "IBAN", then an identifier of 4 to 34 characters with a digit; an IBAN must pass its remainder test).

Defined results: a null or empty text has no spans.  Spans of different kinds may overlap; those of one kind never do.
Rows are judged one by one: ties, repeated rows and extra columns change nothing.
"""

from __future__ import annotations

import hashlib
import string

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from rollcall.llm.common import map_arrow

KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE_KINDS = KINDS[:4]

DIGITS = frozenset(string.digits)
LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
LABEL = frozenset(string.ascii_letters + string.digits + "-")
PHONE = frozenset(string.digits + " ().-")
IDENTIFIER = frozenset(string.ascii_letters + string.digits + "-")
SCHEMES = ("http://", "https://", "ftp://", "mailto:", "www.")
CUES = ("account number", "account no", "account", "acct", "iban", "customer id", "user id", "passport", "ssn", "tax id")
_STOP = frozenset(string.whitespace + "<>\"'`|\\^{}")
_CLOSING = frozenset(".,;:!?)]}")


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for digit in string.digits:
        found.add_word(digit, "digit")
    found.add_word("@", "at")
    found.add_word("+", "plus")
    for kind, words in (("scheme", SCHEMES), ("cue", CUES)):
        for word in words:
            found.add_word(word, (kind, word))
    found.make_automaton()
    return found


def _run(text: str, at: int, allowed: frozenset) -> int:
    """The end of the run of allowed characters from ``at`` on."""
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def email_at(text: str, at: int, least: int) -> tuple[int, int] | None:
    """The address around the at-sign; its local part starts at ``least`` or later."""
    start = at
    while start > least and text[start - 1] in LOCAL:
        start -= 1
    end = _run(text, at + 1, LABEL)
    if start == at or end == at + 1:
        return None
    labels = 0
    while end < len(text) and text[end] == "." and (more := _run(text, end + 1, LABEL)) > end + 1:
        end, labels = more, labels + 1
    return (start, end) if labels else None


def ip_at(text: str, at: int) -> tuple[int, int, bool]:
    """From a run of digits: the end reached, and whether four parts were found and are all at most 255."""
    start, end, parts = at, _run(text, at, DIGITS), 1
    good = _part(text, start, end)
    while parts < 4 and end < len(text) and text[end] == "." and (more := _run(text, end + 1, DIGITS)) > end + 1:
        good = good and _part(text, end + 1, more)
        end, parts = more, parts + 1
    return end, parts, good and parts == 4


def _part(text: str, a: int, b: int) -> bool:
    tail = text[a:b].lstrip("0")
    return len(tail) <= 3 and int(tail or 0) <= 255


def card_at(text: str, at: int) -> int:
    """The end of digits with at most one blank or hyphen between two."""
    n, end = len(text), _run(text, at, DIGITS)
    while end + 1 < n and text[end] in " -" and text[end + 1] in DIGITS:
        end = _run(text, end + 1, DIGITS)
    return end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def phone_at(text: str, at: int) -> tuple[int, bool] | None:
    """From a plus sign: the end of the number and whether it has 8 to 15 digits."""
    if at + 1 >= len(text) or text[at + 1] not in DIGITS:
        return None
    end = _run(text, at + 2, PHONE)
    while end > at + 3 and text[end - 1] not in DIGITS:
        end -= 1
    if end <= at + 3:
        return None
    return end, 8 <= sum(c in DIGITS for c in text[at:end]) <= 15


class _Ahead:
    """What lies ahead of anchors that come in ascending order; each character is looked at once, however many anchors ask."""

    def __init__(self, text: str):
        self.text, self.run, self.closed = text, -1, -1
        self.host = (-1, -1)
        self.next: dict[str, int] = {}
        self.addresses: dict[int, bool] = {}

    def end(self, at: int) -> int:
        """The end of the run without blanks and quotes that ``at`` stands in, less its closing signs."""
        if at > self.run:
            self.run, n = at, len(self.text)
            while self.run < n and self.text[self.run] not in _STOP:
                self.run += 1
            self.closed = self.run
            while self.closed > at and self.text[self.closed - 1] in _CLOSING:
                self.closed -= 1
        return max(self.closed, at)

    def find(self, sign: str, at: int, end: int) -> int:
        """The first place of the sign from ``at`` on, ``end`` if there is none before."""
        found = self.next.get(sign, -1)
        if found < at:
            found = self.text.find(sign, at)
            found = self.next[sign] = len(self.text) if found < 0 else found
        return min(found, end)

    def undotted(self, end: int) -> int:
        """``end`` less the dots before it."""
        if self.host[0] != end:
            at = end
            while at and self.text[at - 1] == ".":
                at -= 1
            self.host = (end, at)
        return self.host[1]

    def address(self, sign: int) -> bool:
        """True if an address stands around this at-sign."""
        if sign not in self.addresses:
            self.addresses = {sign: email_at(self.text, sign, 0) is not None}
        return self.addresses[sign]


def url_at(text: str, at: int, word: str, ahead: _Ahead) -> int | None:
    if at and text[at - 1] in LABEL:
        return None
    start = at + len(word)
    end = ahead.end(start)
    if word == "mailto:":
        sign = ahead.find("@", start, end)
        return end if start < sign < end and ahead.address(sign) else None
    if start >= end or text[start] not in LABEL:
        return None
    host = ahead.undotted(ahead.find("/", start, end))
    return end if ahead.find(".", start, host) < host else None  # a dot within the host, not at its end


def account_at(text: str, at: int, word: str) -> tuple[int, int] | None:
    """The identifier behind a cue: signs, blanks and at most one of "no", "number", "nr", "id" may stand between."""
    if at and (text[at - 1].isalnum()):
        return None
    start = at + len(word)
    for _ in range(2):
        start = _run(text, start, frozenset(" .:#=\t"))
        for filler in ("number", "no", "nr", "id", "is"):
            end = start + len(filler)
            if text[start:end].lower() == filler and (end == len(text) or not text[end].isalnum()):
                start = _run(text, end, frozenset(" .:#=\t"))
                break
    if start == at + len(word):
        return None
    end = _run(text, start, IDENTIFIER)
    if word == "iban":  # may be written in groups of up to four; the longest that passes the test counts
        ends = [end]
        while ends[-1] - start < 42 and text[ends[-1]:ends[-1] + 1] == " ":
            more = _run(text, ends[-1] + 1, IDENTIFIER)
            if not 1 <= more - ends[-1] - 1 <= 4:
                break
            ends.append(more)
        end = next((e for e in reversed(ends) if iban(text[start:e].replace(" ", ""))), None)
        return (start, end) if end else None
    value = text[start:end].strip("-")
    if not 4 <= len(value) <= 34 or not any(c in DIGITS for c in value):
        return None
    return start, end


def iban(value: str) -> bool:
    """Two letters, two digits and a remainder of 1 modulo 97."""
    v = value.upper().replace("-", "")
    if not (15 <= len(v) <= 34 and v[:2].isalpha() and v[2:4].isdigit()):
        return False
    return int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


_SPANS = ArrayType(StructType().add("kind", StringType()).add("start", IntegerType()).add("end", IntegerType()))
_AUTOMATON = _automaton()


def _lower(text: str) -> str:
    """A-Z in lower case, every position kept."""
    return text.translate(_LOWER)


_LOWER = {ord(c): c.lower() for c in string.ascii_uppercase}


def spans(text: str | None) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind and start."""
    if not text:
        return []
    found: list[tuple[int, int, int]] = []
    ahead = _Ahead(text)
    past = [0] * len(KINDS)  # the end of the last match of each kind, kept or dropped
    for last, what in _AUTOMATON.iter(_lower(text)):
        if what == "digit":
            if last >= past[1] and (last == 0 or text[last - 1] not in DIGITS or last == past[1]):
                end, parts, good = ip_at(text, last)
                if parts == 4:
                    past[1] = end
                    if good:
                        found.append((1, last, end))
            if last >= past[2]:
                end = past[2] = card_at(text, last)
                digits = "".join(c for c in text[last:end] if c in DIGITS) if end - last >= 16 else ""
                if 16 <= len(digits) <= 19 and luhn(digits):
                    found.append((2, last, end))
        elif what == "at":
            if last >= past[0] and (span := email_at(text, last, past[0])):
                found.append((0, *span))
                past[0] = span[1]
        elif what == "plus":
            if last >= past[3] and (phone := phone_at(text, last)):
                past[3] = phone[0]
                if phone[1]:
                    found.append((3, last, phone[0]))
        else:
            kind, word = what
            start = last + 1 - len(word)
            if kind == "scheme":
                if start >= past[4] and (end := url_at(text, start, word, ahead)):
                    found.append((4, start, end))
                    past[4] = end
            elif start >= past[5] and (span := account_at(text, start, word)):
                found.append((5, *span))
                past[5] = span[1]
    return sorted(found)


def joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in found)


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` in struct ``doc`` with ``spans``: an array of (kind, start, end) in code points, end exclusive."""
    kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches):
        for batch in batches:
            rows = [[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in spans(t.as_py())] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(kind))], ["doc", "spans"])

    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), docs["text"].cast("string").alias("text"))
    return map_arrow(rows, run, rows.drop("text").schema.add("spans", _SPANS))


def masked(docs: DataFrame, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """``docs`` with each span of these kinds replaced by its kind in brackets (overlapping spans together)."""
    def run(batches):
        for batch in batches:
            out = []
            for t in batch.column(1):
                text, parts, at = t.as_py(), [], 0
                for a, b, k in sorted((a, b, k) for k, a, b in spans(text) if KINDS[k] in kinds):
                    if a >= at:
                        parts += [text[at:a], f"[{KINDS[k]}]"]
                    at = max(at, b)
                out.append(None if text is None else "".join(parts) + text[at:])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc", "text"])

    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), docs["text"].cast("string").alias("text"))
    done = map_arrow(rows, run, rows.schema)
    return done.select(*[F.col("text") if c == "text" else F.col(f"doc.{c}").alias(c) for c in docs.columns])


def report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, the counts of base spans, base_sha256, all spans and their number."""
    def run(batches):
        for batch in batches:
            columns: list[list] = [[] for _ in range(7)]
            for t in batch.column(1):
                found = spans(t.as_py())
                base = [s for s in found if s[0] < len(BASE_KINDS)]
                for k in range(4):
                    columns[k].append(sum(s[0] == k for s in base))
                columns[6].append(len(found))
                columns[4].append(hashlib.sha256(joined(base).encode()).hexdigest())
                columns[5].append(joined(found))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], names)

    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_spans"]
    rows = docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string"))
    return map_arrow(rows, run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long")
