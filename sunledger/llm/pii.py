"""Format-preserving pseudonyms for personal data.

Numbers and dates that prove valid (check digits, ranges, the calendar) are replaced by others of the same format: a
Feistel network, keyed and tweaked by kind and shape, permutes the values of the format among themselves. Equal values
therefore become equal pseudonyms in every document, different ones stay different, check digits hold, and whoever has
the key can turn them back. Results that would not be valid are walked on along the permutation until one is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from datetime import date
from functools import lru_cache
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunledger.llm.common import private

ROUNDS = 10
#: For the test tables. Whoever uses the operator passes a key of their own and keeps it.
DEMO_KEY = b"sunledger demonstration key"


# --- the permutation ---


def _noise(key: bytes, tweak: str, round_: int, half: int, modulus: int) -> int:
    data = f"{tweak}|{round_}|{half}".encode()
    size = max(16, modulus.bit_length() // 8 + 9)
    return int.from_bytes(hashlib.blake2b(data, key=key[:64], digest_size=min(size, 64)).digest(), "big") % modulus


def feistel(value: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A keyed permutation of ``range(size)``. Two halves take turns in shifting each other; a result beyond the size
    (the halves' product may be a little larger) is permuted again."""
    a = isqrt(max(size - 1, 0)) + 1
    b = -(-size // a)
    while True:
        left, right = divmod(value, b)
        for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if r % 2 == 0:
                left = (left + sign * _noise(key, tweak, r, right, a)) % a
            else:
                right = (right + sign * _noise(key, tweak, r, left, b)) % b
        value = left * b + right
        if value < size:
            return value


def permuted(
    value: int, size: int, key: bytes, tweak: str, valid: Callable[[int], bool], back: bool = False
) -> int:
    """The permutation of those values that are valid, by walking on from one valid value to the next."""
    while True:
        value = feistel(value, size, key, tweak, back)
        if valid(value):
            return value


# --- kinds: what is valid, and how a value is written ---


def always(_: int) -> bool:
    return True


def fill(shape: str, digits: str) -> str:
    """The digits in the places of those in ``shape``."""
    new = iter(digits)
    return "".join(next(new) if c in "0123456789" else c for c in shape)


def digits_of(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def luhn_digit(payload: str) -> str:
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def card(text: str, key: bytes, back: bool) -> str | None:
    """13 to 19 digits with a right check digit. The first digit (the network) stays, the check digit is made anew."""
    d = digits_of(text)
    if not 13 <= len(d) <= 19 or luhn_digit(d[:-1]) != d[-1] or len(set(d)) == 1:
        return None
    n = len(d) - 2
    new = permuted(int(d[1:-1]), 10**n, key, f"card{d[0]}{n}", always, back)
    payload = f"{d[0]}{new:0{n}d}"
    return fill(text, payload + luhn_digit(payload))


def phone(text: str, key: bytes, back: bool) -> str | None:
    """A number with a country code, or in the national three-three-four form: 7 to 15 digits. The code stays."""
    code = re.match(r"\+\d{1,3}(?=\D)", text)
    kept = digits_of(code.group()) if code else ("" if not text.startswith("+") else digits_of(text)[:1])
    d = digits_of(text)[len(kept) :]
    if not 7 <= len(kept) + len(d) <= 15 or len(d) < 4:
        return None
    new = permuted(int(d), 10 ** len(d), key, f"phone{kept}|{len(d)}", always, back)
    return fill(text, f"{kept}{new:0{len(d)}d}")


def social(text: str, key: bytes, back: bool) -> str | None:
    """Three-two-four digits: area not 000, 666 or 900 and up, group not 00, serial not 0000."""

    def valid(n: int) -> bool:
        area, group, serial = n // 10**6, n // 10**4 % 100, n % 10**4
        return area not in (0, 666) and area < 900 and group > 0 and serial > 0

    n = int(digits_of(text))
    return fill(text, f"{permuted(n, 10**9, key, 'social', valid, back):09d}") if valid(n) else None


def ipv4(text: str, key: bytes, back: bool) -> str | None:
    """Four numbers up to 255, without leading zeros."""
    parts = text.split(".")
    if any(int(p) > 255 or p != str(int(p)) for p in parts):
        return None
    n = permuted(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, key, "ipv4", always, back)
    return ".".join(map(str, n.to_bytes(4, "big")))


def iban(text: str, key: bytes, back: bool) -> str | None:
    """Country, two check digits, account: the remainder by 97 must be 1. Country and kinds of characters stay."""

    def remainder(s: str) -> int:
        return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97

    s = text.replace(" ", "")
    if not 15 <= len(s) <= 34 or remainder(s) != 1:
        return None
    account = mixed(s[4:], key, f"iban{s[:2]}", back)
    check = 98 - remainder(s[:2] + "00" + account)
    new = iter(f"{s[:2]}{check:02d}{account}")
    return "".join(" " if c == " " else next(new) for c in text)


def mixed(text: str, key: bytes, tweak: str, back: bool) -> str:
    """Letters for letters and digits for digits; case and all other characters stay."""
    low = text.lower()
    shape = "".join("9" if c in "0123456789" else "a" if "a" <= c <= "z" else c for c in low)
    size, value = 1, 0
    for c, s in zip(low, shape):
        base = 10 if s == "9" else 26 if s == "a" else 1
        value = value * base + (int(c) if s == "9" else ord(c) - 97 if s == "a" else 0)
        size *= base
    value = feistel(value, size, key, f"{tweak}|{shape}", back)
    out = []
    for c, s in zip(reversed(text), reversed(shape)):
        base = 10 if s == "9" else 26 if s == "a" else 1
        value, digit = divmod(value, base)
        new = str(digit) if s == "9" else chr(97 + digit) if s == "a" else c
        out.append(new.upper() if s == "a" and c.isupper() else new)
    return "".join(reversed(out))


def email(text: str, key: bytes, back: bool) -> str | None:
    """The part before the @ is permuted, within its address's domain."""
    local, domain = text.rsplit("@", 1)
    if not any(c.isalnum() for c in local):
        return None
    return f"{mixed(local, key, f'email@{domain.lower()}', back)}@{domain}"


#: Days are counted from 0; the last one is not part of the range.
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal() - 1, date(2100, 1, 1).toordinal() - 1


def calendar_date(text: str, key: bytes, back: bool) -> str | None:
    """A day that exists, year first or last. Days from 1900 to 2099 are permuted among themselves, so are the others.
    Written in different forms, the same day gets the same pseudonym, but for day first with slashes, which keeps to
    days after the twelfth."""
    sep = next(c for c in text if not c.isdigit())
    a, b, c = text.split(sep)
    try:
        if len(a) == 4:
            order, day = "ymd", date(int(a), int(b), int(c))
        elif sep == "/" and int(a) <= 12:
            order, day = "mdy", date(int(c), int(a), int(b))
        else:
            order, day = "dmy", date(int(c), int(b), int(a))
    except ValueError:
        return None
    n = day.toordinal() - 1
    here = FIRST_DAY <= n < LAST_DAY
    # Day first with slashes must not come out as something that reads month first.
    late = order == "dmy" and sep == "/"

    def valid(v: int) -> bool:
        return (FIRST_DAY <= v < LAST_DAY) == here and (not late or date.fromordinal(v + 1).day > 12)

    if here:
        shifted = permuted(n - FIRST_DAY, LAST_DAY - FIRST_DAY, key, "day", lambda v: valid(v + FIRST_DAY), back)
        made = date.fromordinal(shifted + FIRST_DAY + 1)
    else:
        made = date.fromordinal(permuted(n, date.max.toordinal(), key, "other day", valid, back) + 1)
    if order == "ymd":
        return f"{made.year:04d}{sep}{made.month:02d}{sep}{made.day:02d}"
    first, second = (made.month, made.day) if order == "mdy" else (made.day, made.month)
    return f"{first:02d}{sep}{second:02d}{sep}{made.year:04d}"


# --- Fixed values: shapes of the kinds, in order of precedence where two begin at one place ---
NUMBERS: tuple[tuple[str, str, Callable[[str, bytes, bool], str | None]], ...] = (
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])", iban),
    ("card", r"(?<![\w-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-])", card),
    ("ipv4", r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)", ipv4),
    ("date", r"(?<![\w/.-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?!\w|[/-]\d)", calendar_date),
    ("social", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", social),
    (
        "phone",
        r"(?<![\w+])(?:\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}"
        r"|\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){1,4}"
        r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w|[.-]\d)",
        phone,
    ),
)
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
# --- end of fixed values ---
KINDS = ("email", *(kind for kind, _, _ in NUMBERS))
PATTERNS = [(kind, re.compile(pattern, re.ASCII), change) for kind, pattern, change in NUMBERS]
#: Longest part before an @ that is looked at, as mail allows.
LONGEST_LOCAL = 64
DIGIT = re.compile(r"[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    at = text.find("@")
    while at >= 0:
        local, domain = LOCAL.search(text, max(0, at - LONGEST_LOCAL), at), DOMAIN.match(text, at + 1)
        if local and domain:
            yield local.start(), domain.end()
        at = text.find("@", at + 1)


def found(text: str, key: bytes, back: bool = False) -> list[tuple[int, int, str, str]]:
    """``start, end, kind, pseudonym`` of every value, in order; where two overlap, the one that begins first."""
    hits = [(a, b, 0, "email", email(text[a:b], key, back)) for a, b in emails(text)]
    if DIGIT.search(text):
        for rank, (kind, pattern, change) in enumerate(PATTERNS, 1):
            for m in pattern.finditer(text):
                hits.append((m.start(), m.end(), rank, kind, remembered(kind, m.group(), key, back)))
    out, at = [], 0
    for start, end, _, kind, new in sorted(h for h in hits if h[4] is not None):
        if start >= at:
            out.append((start, end, kind, new))
            at = end
    return out


@lru_cache(maxsize=100_000)
def remembered(kind: str, value: str, key: bytes, back: bool) -> str | None:
    return next(change for name, _, change in PATTERNS if name == kind)(value, key, back)


def replaced(text: str, hits: list[tuple[int, int, str, str]]) -> str:
    out, at = [], 0
    for start, end, _, new in hits:
        out += [text[at:start], new]
        at = end
    return "".join(out) + text[at:]


# --- Spark ---

SPANS = "array<struct<kind: string, start: bigint, end: bigint>>"


def pseudonymise(docs: DataFrame, key: bytes = DEMO_KEY, back: bool = False) -> DataFrame:
    """``doc_id, text, spans``, one row per document: the text with its values replaced, and where they were (code
    points of the text that came in, end exclusive).

    Two values of one place: the one that begins first, then the kind named first. A null text stays null, with no
    spans. Null and repeated ids are rows like any other; an empty table gives an empty result. ``back`` undoes what
    the same key did.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = [], []
            for text in batch.column(1):
                text = text.as_py()
                hits = found(text, key, back) if text else []
                texts.append(replaced(text, hits) if hits else text)
                spans.append(hits)
            offsets = np.cumsum([0] + [len(h) for h in spans])
            flat = [h for hits in spans for h in hits]
            fields = [
                pa.array([h[2] for h in flat], pa.string()),
                pa.array([h[0] for h in flat], pa.int64()),
                pa.array([h[1] for h in flat], pa.int64()),
            ]
            column = pa.StructArray.from_arrays(fields, names=["kind", "start", "end"])
            column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), column)
            arrays = [batch.column(0), pa.array(texts, pa.string()), column]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text", "spans"])

    source = private(docs, ["doc_id", "text"]).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return source.mapInArrow(rows, f"doc_id bigint, text string, spans {SPANS}")
