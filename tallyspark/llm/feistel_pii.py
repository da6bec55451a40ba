"""Format-preserving pseudonyms by a keyed Feistel permutation.

Validated numbers and dates are replaced by another valid value of the same
format: card numbers (Luhn), IPv4 addresses, North American phone numbers,
social security numbers and calendar dates, and the local parts of e-mail
addresses.  A value is an index into its format's domain; an alternating
Feistel network of keyed hashes permutes the smallest square that holds the
domain, and cycle walking brings it back into the domain.  The key alone fixes
the permutation, so equal values stay equal across documents and executors.

Rows: a null text stays null with nothing found; repeated rows give one row
each.  Text outside the found values is not changed.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame

KEY = b"pseudonym key of the corpus"
ROUNDS = 8

EMAIL = r"(?P<email>[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)"
IP = r"(?P<ip>(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.]*\d))"
PHONE = r"(?P<phone>(?<![\d+])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d))"
SSN = r"(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
DATE = r"(?P<date>(?<![\d-])\d{4}-\d{2}-\d{2}(?![\d-]))"
CARD = r"(?P<card>(?<!\d)(?:\d{13,19}|\d{4}(?P<sep>[ -])(?:\d{4}(?P=sep)\d{4}(?P=sep)\d{1,7}|\d{6}(?P=sep)\d{5}))(?!\d))"
FOUND = re.compile("|".join((EMAIL, IP, DATE, SSN, PHONE, CARD)), re.ASCII)

# First digits of area code and exchange that no assigned number has: a second
# domain, so that such phone numbers are replaced among themselves.
LEADS_01 = [f"{a}{e}" for a in range(10) for e in range(10) if a < 2 or e < 2]

DAY0 = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2100, 1, 1).toordinal() - DAY0
FOUND_T = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("pseudonym", pa.string())]))
SCHEMA = "doc_id long, text string, n_found long, kinds string, found array<struct<kind:string,start:long,end:long,pseudonym:string>>"


def permute(x: int, size: int, key: bytes, tweak: str) -> int:
    """Keyed permutation of range(size)."""
    if size < 2:
        return x
    side = isqrt(size - 1) + 1
    while True:
        left, right = divmod(x, side)
        for r in range(ROUNDS):
            digest = hashlib.blake2b(f"{tweak}|{size}|{r}|{right}".encode(), key=key, digest_size=16).digest()
            left, right = right, (left + int.from_bytes(digest, "big")) % side
        x = left * side + right
        if x < size:
            return x


def luhn(digits: str) -> int:
    """The check digit that follows ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def refill(value: str, digits: str) -> str:
    """``value`` with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in value)


def pseudonym(kind: str, value: str, key: bytes = KEY) -> str | None:
    """The pseudonym of a value; None if the value is not valid."""
    digits = "".join(c for c in value if c.isdigit())
    if kind == "card":
        if int(digits[-1]) != luhn(digits[:-1]):
            return None
        head = digits[0]
        body = str(permute(int(digits[1:-1]), 10 ** (len(digits) - 2), key, f"card{head}")).zfill(len(digits) - 2)
        return refill(value, head + body + str(luhn(head + body)))
    if kind == "ip":
        octets = [int(x) for x in value.split(".")]
        if max(octets) > 255:
            return None
        n = permute(int.from_bytes(bytes(octets), "big"), 1 << 32, key, "ip")
        return ".".join(map(str, n.to_bytes(4, "big")))
    if kind == "date":
        try:
            day = datetime.date.fromisoformat(value).toordinal() - DAY0
        except ValueError:
            return None
        return datetime.date.fromordinal(permute(day, DAYS, key, "date") + DAY0).isoformat() if 0 <= day < DAYS else None
    if kind == "ssn":
        a, g, s = (int(x) for x in value.split("-"))
        if a in (0, 666) or a > 899 or not g or not s:
            return None
        n = permute(((a - 1 - (a > 666)) * 99 + g - 1) * 9999 + s - 1, 898 * 99 * 9999, key, "ssn")
        n, s = divmod(n, 9999)
        a, g = divmod(n, 99)
        return f"{a + 1 + (a + 1 >= 666):03d}-{g + 1:02d}-{s + 1:04d}"
    if kind == "phone":
        own, country = digits[-10:], digits[:-10]
        if own[0] in "01" or own[3] in "01":
            index = LEADS_01.index(own[0] + own[3]) * 10**8 + int(own[1:3] + own[4:])
            lead, rest = divmod(permute(index, len(LEADS_01) * 10**8, key, "phone01"), 10**8)
            (area, exchange), rest = LEADS_01[lead], f"{rest:08d}"
            return refill(value, f"{country}{area}{rest[:2]}{exchange}{rest[2:]}")
        index = (((int(own[0]) - 2) * 100 + int(own[1:3])) * 8 + int(own[3]) - 2) * 10**6 + int(own[4:])
        index, rest = divmod(permute(index, 64 * 10**8, key, "phone"), 10**6)
        area, exchange = divmod(index, 8)
        return refill(value, f"{country}{area // 100 + 2}{area % 100:02d}{exchange + 2}{rest:06d}")
    local, _, domain = value.partition("@")
    out = list(local)
    for name, alphabet in (("0", "0123456789"), ("a", "abcdefghijklmnopqrstuvwxyz"), ("A", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")):
        at = [i for i, c in enumerate(local) if c in alphabet]
        n = 0
        for i in at:
            n = n * len(alphabet) + alphabet.index(local[i])
        n = permute(n, len(alphabet) ** len(at), key, f"email{name}{len(at)}") if at else 0
        for i in reversed(at):
            n, c = divmod(n, len(alphabet))
            out[i] = alphabet[c]
    return "".join(out) + "@" + domain


def mask(text: str, key: bytes = KEY) -> tuple[str, list[dict]]:
    out, found, at, pos = [], [], 0, 0
    while m := FOUND.search(text, pos):
        new = pseudonym(m.lastgroup, m.group(), key)
        if new is None:
            pos = m.start() + 1  # a valid value may begin inside the refused one
            continue
        out += [text[at : m.start()], new]
        at = pos = m.end()
        found.append({"kind": m.lastgroup, "start": m.start(), "end": m.end(), "pseudonym": new})
    return "".join(out) + text[at:], found


def pseudonymise(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """doc_id, text with pseudonyms, n_found, kinds, found per row."""

    def run(batches):
        for b in batches:
            texts, found = [], []
            for t in b.column("text").to_pylist():
                new, got = mask(t, key) if t is not None else (None, [])
                texts.append(new), found.append(got)
            kinds = [",".join(sorted({f["kind"] for f in got})) for got in found]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(texts, pa.string()), pa.array([len(f) for f in found], pa.int64()), pa.array(kinds, pa.string()), pa.array(found, FOUND_T)],
                names=["doc_id", "text", "n_found", "kinds", "found"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
