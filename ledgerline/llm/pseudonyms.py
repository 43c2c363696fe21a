"""Format-preserving pseudonyms for personal data.

Values are found by pattern, validated (checksums, calendar, ranges) and replaced by a
keyed permutation of the same format: a Feistel network over the integers that the format
can hold, with cycle walking where not every integer is valid.  The permutation depends
only on the key and the format, so equal values get equal pseudonyms in every document, in
any partition and without a lookup table.

Formats: payment numbers of 13 to 19 digits with a valid Luhn digit (contiguous, or in groups
of 4-4-4-4 or 4-6-5); IBANs with a valid checksum; social security numbers in valid ranges
(with hyphens or spaces); phone numbers with + or 00 and a country code, which is kept, and North American ones without, in all of
which equal national numbers stay equal; IPv4 addresses (loopback and the all-zeros and all-ones
addresses are kept); dates 1900-2099 in year-month-day, day.month.year and slashed order and with English month names;
e-mail addresses (letters stay letters, digits digits, the last label of the host is kept).
Numbers that fail validation are left alone, and so are forms that cannot be told from other numbers: ten bare
digits, national numbers of other countries without a code, 00 and digits without a separator, years of two digits.

Cases: null text stays null with 0 values; empty text stays empty; repeated values and rows
get the same pseudonyms; texts of any length are scanned whole, with patterns whose work is
linear in the text; extra columns are ignored by the query and kept by ``pseudonymise``.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import col, free_name, small_batches, text_udf

#: Stands in where no key is given; a deployment passes its own.
DEMO_KEY = b"demonstration key, not a secret"
ROUNDS = 8


# ------------------------------------------------------------------ the permutation
def permute(x: int, size: int, key: bytes, tweak: str, inverse: bool = False) -> int:
    """Keyed permutation of 0..size-1: an alternating Feistel network on (left, right) with
    left below a, right below b, a * b >= size, walked until it falls below size."""
    if size < 2:
        return x
    a = math.isqrt(size - 1) + 1
    b = -(-size // a)
    mods = (a, b)
    while True:
        half = list(divmod(x, b))
        for r in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
            side = r & 1
            h = hashlib.blake2b(f"{tweak}|{size}|{r}|{half[1 - side]}".encode(), key=key[:64], digest_size=32)
            f = int.from_bytes(h.digest(), "big")
            half[side] = (half[side] - f if inverse else half[side] + f) % mods[side]
        x = half[0] * b + half[1]
        if x < size:
            return x


def walk(x: int, size: int, key: bytes, tweak: str, valid: Callable[[int], bool]) -> int:
    """Permutation of the valid ones of 0..size-1 (x must be valid)."""
    while True:
        x = permute(x, size, key, tweak)
        if valid(x):
            return x


def _refill(shape: str, digits: str) -> str:
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


# ------------------------------------------------------------------ the formats
def luhn_digit(payload: str) -> str:
    total = 0
    for k, c in enumerate(reversed(payload)):
        d = int(c) * (2 - k % 2)
        total += d - 9 * (d > 9)
    return str(-total % 10)


def _card(m: re.Match, key: bytes) -> str | None:
    digits = re.sub(r"[ -]", "", m.group())
    if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    n = len(digits) - 1
    to = f"{permute(int(digits[:-1]), 10 ** n, key, f'card{n}'):0{n}d}"
    return _refill(m.group(), to + luhn_digit(to))


def _mod97(s: str) -> int:
    return int("".join(str(int(c, 36)) for c in s)) % 97


def _mixed(s: str, key: bytes, tweak: str) -> str:
    """Permute the ASCII letters and digits of s among strings of the same shape."""
    radix = [10 if c.isdigit() else 26 if c.isalpha() and c.isascii() else 1 for c in s]
    x = 0
    for c, r in zip(s, radix, strict=True):
        if r > 1:
            x = x * r + (int(c) if r == 10 else ord(c.lower()) - 97)
    x = permute(x, math.prod(radix), key, tweak + "".join("9" if r == 10 else "a" if r == 26 else c for c, r in zip(s, radix, strict=True)))
    out = []
    for c, r in zip(reversed(s), reversed(radix), strict=True):
        if r == 1:
            out.append(c)
            continue
        x, d = divmod(x, r)
        out.append(str(d) if r == 10 else chr(97 + d).upper() if c.isupper() else chr(97 + d))
    return "".join(reversed(out))


def _iban(m: re.Match, key: bytes) -> str | None:
    s = m.group().replace(" ", "")
    if not 15 <= len(s) <= 34 or _mod97(s[4:] + s[:4]) != 1:
        return None
    body = _mixed(s[4:], key, "iban" + s[:2])
    out = iter(f"{s[:2]}{98 - _mod97(body + s[:2] + '00'):02d}{body}")
    return "".join(c if c == " " else next(out) for c in m.group())


def _ssn(m: re.Match, key: bytes) -> str | None:
    def valid(x: int) -> bool:
        area, group, serial = x // 10 ** 6, x // 10 ** 4 % 100, x % 10 ** 4
        return area not in (0, 666) and area < 900 and group > 0 and serial > 0
    x = int(re.sub(r"\D", "", m.group()))
    return _refill(m.group(), f"{walk(x, 10 ** 9, key, 'ssn', valid):09d}") if valid(x) else None


def _code_length(digits: str) -> int:
    """Digits of the country code that an international number begins with."""
    return 1 if digits[0] in "17" else 2 if digits[:2] in CODES_OF_TWO else 3


def _us_valid(x: int) -> bool:
    """Area code and exchange of a North American number begin with 2 to 9."""
    return x // 10 ** 9 >= 2 and x // 10 ** 6 % 10 >= 2


def _national(digits: str, code: str, key: bytes) -> str:
    """Permutation of the national numbers of a country and length, so that all notations of a
    number get the same digits; North American ones stay valid, or not so."""
    n, x = len(digits), int(digits)
    if code == "1" and n == 10:
        kind = _us_valid(x)
        return f"{walk(x, 10 ** n, key, 'phone1-10', lambda y: _us_valid(y) == kind):0{n}d}"
    return f"{permute(x, 10 ** n, key, f'phone{code}-{n}'):0{n}d}"


def _phone(m: re.Match, key: bytes) -> str | None:
    if rest := m.group("plus1") or m.group("us"):
        digits = re.sub(r"\D", "", rest)
        if m.group("us") and rest[3] == " " and not _us_valid(int(digits)):      # spaces alone: other numbers look like that, too
            return None
        return m.group()[:len(m.group()) - len(rest)] + _refill(rest, _national(digits, "1", key))
    rest = m.group("intl")
    digits = re.sub(r"\D", "", rest.replace("(0)", ""))
    k = _code_length(digits)
    code, n = digits[:k], len(digits) - k
    if not 8 <= len(digits) <= 15 or n < 6:
        return None
    if m.group("plus") != "+" and (rest.isdigit() or code == "1" and n != 10):
        return None                                            # a number that begins with zeros
    at = [i for i, c in enumerate(rest) if c.isdigit()][k - 1] + 1
    if trunk := re.match(r"[ .-]?\(0\)", rest[at:]):
        at += trunk.end()
    return m.group("plus") + rest[:at] + _refill(rest[at:], _national(digits[k:], code, key))


def _ip(m: re.Match, key: bytes) -> str | None:
    parts = m.group().split(".")
    if any(int(p) > 255 or len(p) > 1 and p[0] == "0" for p in parts):
        return None

    def valid(x: int) -> bool:
        return x >> 24 not in (0, 127) and x != 0xFFFFFFFF
    x = sum(int(p) << s for p, s in zip(parts, (24, 16, 8, 0), strict=True))
    if not valid(x):
        return None
    x = walk(x, 1 << 32, key, "ip", valid)
    return ".".join(str(x >> s & 255) for s in (24, 16, 8, 0))


FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()


def _read_date(order: str, a: int, b: int, c: int) -> dt.date | None:
    y, m, d = {"ymd": (a, b, c), "dmy": (c, b, a), "mdy": (c, a, b)}[order]
    try:
        day = dt.date(y, m, d)
    except ValueError:
        return None
    return day if 1900 <= y <= 2099 else None


def _date(m: re.Match, key: bytes) -> str | None:
    a, sep, b, c = m.group("d1", "dsep", "d2", "d3") if m.group("d1") else m.group("y1", "ysep", "y2", "y3")
    if m.group("y1"):
        orders = ("ymd",)
    else:
        orders = ("mdy", "dmy") if sep == "/" else ("dmy",)
    parts = [a, b, c]
    order = next((o for o in orders if _read_date(o, *map(int, parts))), None)
    if order is None:
        return None

    def numbers(x: int) -> tuple[int, int, int]:
        day = dt.date.fromordinal(FIRST_DAY + x)
        return {"ymd": (day.year, day.month, day.day), "dmy": (day.day, day.month, day.year),
                "mdy": (day.month, day.day, day.year)}[order]

    def valid(x: int) -> bool:                 # must read back in the same order
        return next(o for o in orders if _read_date(o, *numbers(x))) == order
    x = _read_date(order, *map(int, parts)).toordinal() - FIRST_DAY
    new = numbers(walk(x, LAST_DAY - FIRST_DAY + 1, key, "date", valid))
    wide = "0" if any(p[0] == "0" for p in parts) or all(len(p) > 1 for p in parts) else ""
    return sep.join(f"{n:02d}" if wide else str(n) for n in new)


def _month_date(m: re.Match, key: bytes) -> str | None:
    """A date with a month name: the same permutation as of a date in numbers."""
    first = m.group("mon") is not None
    name, day, year = m.group("mon", "day", "year") if first else m.group("mon2", "day2", "year2")
    month = next(k for k, full in enumerate(MONTHS, 1) if full[:3].lower() == name[:3].lower())
    date = _read_date("ymd", int(year), month, int(day))
    if date is None:
        return None
    new = dt.date.fromordinal(FIRST_DAY + permute(date.toordinal() - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, key, "date"))
    to = MONTHS[new.month - 1] if name.lower() == MONTHS[month - 1].lower() else MONTHS[new.month - 1][:3]
    to = to.upper() if name.isupper() else to.lower() if name.islower() else to
    ordinal = m.group("ord" if first else "ord2")
    at = f"{new.day:02d}" if day[0] == "0" else str(new.day)
    if ordinal:
        at += "th" if 11 <= new.day <= 13 else {1: "st", 2: "nd", 3: "rd"}.get(new.day % 10, "th")
    if first:
        return f"{to}{m.group('m1')}{at}{m.group('m2')}{new.year}"
    return f"{at}{m.group('n1')}{to}{m.group('n2')}{new.year}"


def _email(m: re.Match, key: bytes) -> str | None:
    head, dot, top = m.group().rpartition(".")
    return _mixed(head, key, "email") + dot + top


# The names of months, and the country codes of two digits (1 and 7 have one, all others three).
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
CODES_OF_TWO = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
                         "81 82 84 86 90 91 92 93 94 95 98".split())
# The patterns of the formats.  Every one starts at a boundary and is bounded
# or possessive, so a scan is linear.
EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}+\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])")
PATTERNS = {
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})(?![A-Za-z0-9])",
    "date": r"(?<![0-9A-Za-z./-])(?:(?P<y1>[0-9]{4})(?P<ysep>[-/.])(?P<y2>[0-9]{1,2})(?P=ysep)(?P<y3>[0-9]{1,2})"
            r"|(?P<d1>[0-9]{1,2})(?P<dsep>[./])(?P<d2>[0-9]{1,2})(?P=dsep)(?P<d3>[0-9]{4}))(?:(?=T[0-9]{2}:)|(?![0-9A-Za-z]|[./-][0-9]))",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}(?P<ssep>[ -])[0-9]{2}(?P=ssep)[0-9]{4}(?![0-9A-Za-z]|-[0-9])",
    "ip": r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?P<csep>[ -])[0-9]{4}(?P=csep)[0-9]{4}(?P=csep)[0-9]{4}"
            r"|[0-9]{4}(?P<asep>[ -])[0-9]{6}(?P=asep)[0-9]{5})(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+])(?:(?:\+|00)1[ .-]?(?P<plus1>\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4})"
             r"|(?:1[ .-])?(?P<us>(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4})"
             r"|(?P<plus>\+|00[ .-]?)(?P<intl>[1-9][0-9]{0,2}(?:[ .-]?\(0\))?[ .-]?\(?[0-9]{1,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}))(?![0-9A-Za-z])",
}
_MONTH = "|".join([*MONTHS, *(x[:3] for x in MONTHS if x != "May"), "Sept"])
MONTH_DATE = re.compile(
    rf"(?<![0-9A-Za-z])(?:(?P<mon>{_MONTH})(?P<m1>\.? )(?P<day>[0-9]{{1,2}})(?P<ord>st|nd|rd|th)?(?P<m2>,? )(?P<year>[0-9]{{4}})"
    rf"|(?P<day2>[0-9]{{1,2}})(?P<ord2>st|nd|rd|th)?(?P<n1> (?:of )?|-)(?P<mon2>{_MONTH})(?P<n2>[.,]? |-)(?P<year2>[0-9]{{4}}))(?![0-9A-Za-z])",
    re.IGNORECASE)
NUMBERS = re.compile("|".join(f"(?:{p})" for p in PATTERNS.values()))
KINDS = {k: (re.compile(PATTERNS[k]), make) for k, make in
         {"iban": _iban, "date": _date, "ssn": _ssn, "ip": _ip, "card": _card, "phone": _phone}.items()}
_DIGIT = re.compile(r"[0-9]")


def _replaced(text: str, find: re.Pattern, kinds, key: bytes) -> tuple[str, int]:
    """Replace the first valid kind at every place that ``find`` finds; a place without one
    is left, and the scan goes on behind its first character."""
    out, done, at, n = [], 0, 0, 0
    while m := find.search(text, at):
        at = m.start() + 1
        for pattern, make in kinds:
            if (own := pattern.match(text, m.start())) and (new := make(own, key)) is not None:
                out += [text[done:own.start()], new]
                done = at = own.end()
                n += 1
                break
    return "".join([*out, text[done:]]), n


def pseudonyms(text: str | None, key: bytes = DEMO_KEY) -> tuple[str | None, int]:
    """The text with its validated values replaced, and how many there were."""
    if not text:
        return text, 0
    mails = months = numbers = 0
    if "@" in text:
        text, mails = _replaced(text, EMAIL, [(EMAIL, _email)], key)
    if _DIGIT.search(text):
        text, months = _replaced(text, MONTH_DATE, [(MONTH_DATE, _month_date)], key)
        text, numbers = _replaced(text, NUMBERS, KINDS.values(), key)
    return text, mails + months + numbers


def pseudonym_column(text: Column, key: bytes = DEMO_KEY) -> Column:
    """struct(text, n_values)."""
    def run(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([pseudonyms(t, key) for t in s], columns=["text", "n_values"])
    return text_udf(run, "text string, n_values long")(text)


def query(docs: DataFrame, key: bytes = DEMO_KEY) -> DataFrame:
    """doc_id, text with pseudonyms, and n_values for every document."""
    small_batches(docs.sparkSession)
    out = docs.select(col(docs, "doc_id").alias("doc_id"), pseudonym_column(col(docs, "text"), key).alias("_p"))
    return out.select("doc_id", F.col("_p.text").alias("text"), F.col("_p.n_values").alias("n_values"))


def pseudonymise(docs: DataFrame, key: bytes = DEMO_KEY) -> DataFrame:
    """``docs`` with pseudonyms in ``text``, and n_chars (if there) of the new text."""
    small_batches(docs.sparkSession)
    name = free_name(docs, "_pseudonyms")
    out = docs.withColumn(name, pseudonym_column(col(docs, "text"), key))
    new = col(out, name)
    made = {"text": new["text"], "n_chars": F.when(new["n_values"] > 0, F.length(new["text"]).cast("long")).otherwise(
        col(out, "n_chars")) if "n_chars" in docs.columns else None}
    return out.select(*[made[c].alias(c) if made.get(c) is not None else col(out, c) for c in docs.columns])
