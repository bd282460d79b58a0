"""Format-preserving pseudonyms for personal numbers, dates and addresses.

Every value that passes its format's own validation is mapped by a keyed Feistel
permutation of all values of that format, so equal values get equal pseudonyms in
every document, different values different ones, and the key holder can map back.
Phones and addresses of ranges that nobody is assigned are permuted among themselves.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import small_batches, with_n_chars

ROUNDS = 10
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()
SPANS = "array<struct<kind:string,start:int,end:int,pseudonym:string>>"


def permute(value: int, size: int, key: bytes, tweak: bytes, back: bool = False) -> int:
    """A keyed permutation of ``range(size)``: an unbalanced Feistel network with cycle walking."""
    if size < 2:
        return value
    a = int(size**0.5) if size < 1 << 52 else 1 << (size.bit_length() // 2)
    a = max(a, 2)
    b = -(-size // a)

    def step(round_: int, half: int) -> int:
        text = b"%b|%d|%d|%d" % (tweak, size, round_, half)
        return int.from_bytes(hashlib.blake2b(text, key=key, digest_size=64).digest(), "big")

    while True:
        left, right = divmod(value, b)
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if i % 2 == 0:
                left = (left + sign * step(i, right)) % a
            else:
                right = (right + sign * step(i, left)) % b
        value = left * b + right
        if value < size:
            return value


def luhn_digit(digits: str) -> str:
    """The check digit that follows ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def refill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in order."""
    new = iter(digits)
    return "".join(next(new) if c.isdigit() else c for c in shape)


def only_digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


Mover = Callable[[int, int, bytes], int]


def card(s: str, move: Mover) -> str | None:
    d = only_digits(s)
    if not 13 <= len(d) <= 19 or d[0] not in "23456" or luhn_digit(d[:-1]) != d[-1]:
        return None
    width = len(d) - 2
    body = d[0] + str(move(int(d[1:-1]), 10**width, b"card")).zfill(width)
    return refill(s, body + luhn_digit(body))


def phone(s: str, move: Mover) -> str | None:
    d = only_digits(s)
    lead = d[:-10]
    area, exchange, line = d[-10:-7], d[-7:-4], d[-4:]
    if lead not in ("", "1") or area[0] in "01" or exchange[0] in "01":
        return None
    n = ((int(area) - 200) * 800 + int(exchange) - 200) * 10_000 + int(line)
    n, line = divmod(move(n, 800 * 800 * 10_000, b"phone"), 10_000)
    area, exchange = divmod(n, 800)
    return refill(s, f"{lead}{area + 200}{exchange + 200}{line:04d}")


def unassigned_phone(s: str, move: Mover) -> str | None:
    """A number that +1 or parentheses show to be one, although no plan assigns it, among its like."""
    d = only_digits(s)
    area, exchange, line = int(d[-10:-7]), int(d[-7:-4]), d[-4:]
    if not ("+" in s or "(" in s) or (area >= 200 and exchange >= 200):
        return None
    n = area * 1000 + exchange if area < 200 else 200_000 + (area - 200) * 200 + exchange
    n, line = divmod(move(n * 10_000 + int(line), 360_000 * 10_000, b"phone unassigned"), 10_000)
    area, exchange = divmod(n, 1000) if n < 200_000 else divmod(n - 200_000 + 200 * 200, 200)
    return refill(s, f"{d[:-10]}{area:03d}{exchange:03d}{line:04d}")


def international(s: str, move: Mover) -> str | None:
    d = only_digits(s)
    if not 8 <= len(d) <= 15 or d[0] in "01":
        return None
    width = len(d) - 2
    return refill(s, d[:2] + str(move(int(d[2:]), 10**width, b"phone+")).zfill(width))


def social(s: str, move: Mover) -> str | None:
    area, group, serial = (int(x) for x in re.split("[- ]", s))
    if area in (0, 666) or area >= 900 or group == 0 or serial == 0:
        return None
    n = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    n, serial = divmod(move(n, 898 * 99 * 9999, b"ssn"), 9999)
    area, group = divmod(n, 99)
    area += 1
    return refill(s, f"{area + (area >= 666):03d}{group + 1:02d}{serial + 1:04d}")


def moved_address(s: str, move: Mover, first: int, last: int, tweak: bytes) -> str | None:
    """An address whose first part is in ``first`` to ``last``, among those."""
    parts = s.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts) or not first <= int(parts[0]) <= last:
        return None
    n = 0
    for p in parts:
        n = n * 256 + int(p)
    n = move(n - (first << 24), (last + 1 - first) << 24, tweak) + (first << 24)
    return ".".join(str(n >> shift & 255) for shift in (24, 16, 8, 0))


def address(s: str, move: Mover) -> str | None:
    return moved_address(s, move, 1, 223, b"ipv4")


def reserved_address(s: str, move: Mover) -> str | None:
    return moved_address(s, move, 224, 255, b"ipv4 reserved")


def iban_rest(country: str, body: str) -> str:
    number = "".join(str(int(c, 36)) for c in body + country + "00")
    return f"{98 - int(number) % 97:02d}"


def characters(s: str, move: Mover, tweak: bytes) -> str:
    """Permute letters and digits; case, kind and place of each stay."""
    sizes = [10 if c.isdigit() else 26 for c in s if c.isascii() and c.isalnum()]
    n = total = 0
    for c in s:
        if c.isascii() and c.isalnum():
            size = 10 if c.isdigit() else 26
            n = n * size + (int(c) if size == 10 else ord(c.lower()) - 97)
    total = 1
    for size in sizes:
        total *= size
    shape = "".join("0" if c.isdigit() else "a" if c.isascii() and c.isalnum() else c for c in s)
    n = move(n, total, tweak + shape.encode())
    out = []
    for c in reversed(s):
        if c.isascii() and c.isalnum():
            n, rest = divmod(n, 10 if c.isdigit() else 26)
            new = str(rest) if c.isdigit() else chr(97 + rest)
            out.append(new.upper() if c.isupper() else new)
        else:
            out.append(c)
    return "".join(reversed(out))


def iban(s: str, move: Mover) -> str | None:
    plain = s.replace(" ", "")
    if not 15 <= len(plain) <= 34 or iban_rest(plain[:2], plain[4:]) != plain[2:4]:
        return None
    body = characters(plain[4:], move, b"iban" + plain[:2].encode())
    new = iter(plain[:2] + iban_rest(plain[:2], body) + body)
    return "".join(c if c == " " else next(new) for c in s)


def mail(s: str, move: Mover) -> str | None:
    local, _, host = s.rpartition("@")
    if ".." in s or len(local) > 64 or not any(c.isascii() and c.isalnum() for c in local):
        return None
    return f"{characters(local, move, b'mail')}@{host}"


def moved_day(year: int, month: int, day: int, move: Mover, keep: Callable[[date], bool]) -> date | None:
    try:
        n = date(year, month, day).toordinal() - FIRST_DAY
    except ValueError:
        return None
    size = LAST_DAY - FIRST_DAY + 1
    if not 0 <= n < size:
        return None
    while True:
        n = move(n, size, b"date")
        new = date.fromordinal(FIRST_DAY + n)
        if keep(new):
            return new


def day(s: str, move: Mover) -> str | None:
    """Year first; or day first with points or hyphens; or with slashes, month first if it can be."""
    a, b, c = (int(x) for x in re.split("[-/.]", s))
    if len(re.split("[-/.]", s)[0]) == 4:
        new = moved_day(a, b, c, move, lambda d: True)
        return new and refill(s, f"{new.year:04d}{new.month:02d}{new.day:02d}")
    if "/" in s and a <= 12:
        new = moved_day(c, a, b, move, lambda d: True)
        return new and refill(s, f"{new.month:02d}{new.day:02d}{new.year:04d}")
    keep = (lambda d: d.day > 12) if "/" in s else (lambda d: True)
    new = moved_day(c, b, a, move, keep)
    return new and refill(s, f"{new.day:02d}{new.month:02d}{new.year:04d}")


#: Kind, pattern and the function that validates and maps a match; the first that fits counts.
KINDS: list[tuple[str, str, Callable[[str, Mover], str | None]]] = [
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?"
              r"(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", mail),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", iban),
    ("date", r"(?<![A-Za-z0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}"
             r"|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}-[0-9]{2}-[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})"
             r"(?![A-Za-z0-9]|[./-][0-9])", day),
    ("ipv4", r"(?<![A-Za-z0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![A-Za-z0-9]|\.[0-9])", address),
    ("ssn", r"(?<![A-Za-z0-9-])[0-9]{3}([- ])[0-9]{2}\1[0-9]{4}(?![A-Za-z0-9]|-[0-9])", social),
    ("card", r"(?<![A-Za-z0-9.+-])[0-9](?:[ -]?[0-9]){12,18}(?![A-Za-z0-9]|[.-][0-9])", card),
    ("phone", r"(?<![A-Za-z0-9.+-])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
              r"(?![A-Za-z0-9]|-[0-9])", phone),
    ("phone", r"(?<![A-Za-z0-9.+-])\+1[0-9]{10}(?![A-Za-z0-9])", phone),
    ("phone", r"(?<![A-Za-z0-9+])\+[2-9][0-9]{1,2}(?:[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,5})){2,5}(?![A-Za-z0-9])", international),
]
#: Last, so that they take nothing from the kinds above: values right by shape, in ranges nobody is assigned.
BY_SHAPE = {phone: unassigned_phone, address: reserved_address}
KINDS += [(kind, pattern, BY_SHAPE[change]) for kind, pattern, change in KINDS if change in BY_SHAPE]


def find_values(text: str, move: Mover, kinds=KINDS) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, pseudonym) of the valid values, in order and without overlaps."""
    found, taken = [], bytearray(len(text))
    for kind, pattern, change in kinds:
        for m in re.finditer(pattern, text):
            start, end = m.span()
            if 1 in taken[start:end]:
                continue
            new = change(m.group(), move)
            if new is not None:
                found.append((kind, start, end, new))
                taken[start:end] = b"\1" * (end - start)
    return sorted(found, key=lambda x: x[1])


def pseudonymise_text(text: str, key: bytes, back: bool = False) -> tuple[str, list]:
    """The text with pseudonyms (or, with ``back``, the original values), and what was replaced."""
    found = find_values(text, lambda n, size, tweak: permute(n, size, key, tweak, back))
    out, at = [], 0
    for _, start, end, new in found:
        out += [text[at:start], new]
        at = end
    return "".join(out) + text[at:], found


def pseudonyms(text: Column, key: bytes) -> Column:
    """Struct of the new ``text`` and its ``spans`` (code points of the input)."""
    worth = re.compile("[0-9@]")

    @F.pandas_udf(f"struct<text:string,spans:{SPANS}>")
    def replaced(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            if t is None or not worth.search(t):
                rows.append((t, []))
            else:
                new, found = pseudonymise_text(t, key)
                rows.append((new, [dict(zip(("kind", "start", "end", "pseudonym"), f)) for f in found]))
        return pd.DataFrame(rows, columns=["text", "spans"])

    return replaced(text)


def pseudonymise(docs: DataFrame, key: bytes, spans: str | None = None) -> DataFrame:
    """``docs`` with personal values in ``text`` replaced; ``n_chars`` follows the new text.

    ``key`` (1 to 64 bytes) is a secret of the caller.  Every text is treated whole.  Null
    texts stay null, texts without valid values stay as they are, other columns are kept.
    ``spans`` names a column to add with what was replaced.  There is no shuffle.
    """
    if not 1 <= len(key) <= 64:
        raise ValueError("the key has 1 to 64 bytes")
    small_batches(docs.sparkSession)
    made = "_pseudonymised"
    while made in docs.columns:
        made += "_"
    out = docs.withColumn(made, pseudonyms(F.col("text"), key)).withColumn("text", F.col(f"{made}.text"))
    if spans:
        out = out.withColumn(spans, F.col(f"{made}.spans"))
    return with_n_chars(out.drop(made))
