"""Personal numbers, dates and addresses replaced by keyed pseudonyms of the same format."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from datetime import date
from itertools import accumulate

from pyspark.sql import DataFrame

from trackloom.llm.common import map_texts, packed

KINDS = ("email", "iban", "card", "ipv4", "date", "phone", "ssn")
ROUNDS = 8
FIRST_DAY, DAYS = date(1900, 1, 1).toordinal(), date(2100, 1, 1).toordinal() - date(1900, 1, 1).toordinal()

_EMAIL = re.compile(r"(?<![\w.+-])[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![\w-])")
_IBAN = re.compile("[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?")
_CARD = re.compile("[0-9](?:[ -]?[0-9]){12,18}")
_CARD_PRINTED = re.compile(r"[0-9]{13,19}|[0-9]{4}([ -])(?:[0-9]{4}\1){2}[0-9]{4}(?:\1[0-9]{1,3})?|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5}")
_IPV4 = re.compile(r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|\.[0-9])")
_DATE = re.compile(r"(?<![\w/.-])(?:([0-9]{4})([-/.])([0-9]{2})\2([0-9]{2})|([0-9]{1,2})([/.-])([0-9]{1,2})\6([0-9]{4}))(?![\w/-]|\.[0-9])")
_PHONE = re.compile(r"(?<![\w.+-])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![\w-])")
_SSN = re.compile(r"(?<![\w-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![\w-])")
_DIGIT = re.compile("[0-9]")
#: Where values of parts may lie one after another or beside other numbers; each is a range of the parts.
_RUNS = {
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "card": re.compile(r"(?<![\w.+-])[0-9](?:[ -]?[0-9]){12,}(?![\w-])"),
}
_PART = re.compile("[A-Z0-9]+")
#: Fewest and most digits and letters of such values.
_SIZES = {"iban": (12, 35), "card": (13, 19)}


class Feistel:
    """A keyed permutation of the numbers below any size: rounds on the two halves of a rectangle, walked until inside."""

    def __init__(self, key: bytes) -> None:
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, tweak: str, size: int, i: int, x: int) -> int:
        said = f"{tweak}|{size}|{i}|{x}".encode()
        return int.from_bytes(hashlib.blake2b(said, key=self.key, digest_size=32).digest())

    def permute(self, x: int, size: int, tweak: str, back: bool = False) -> int:
        a = math.isqrt(size - 1) + 1 if size > 1 else 1
        b = -(-size // a)
        while True:
            left, right = divmod(x, b)
            for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
                sign = -1 if back else 1
                if i % 2:
                    right = (right + sign * self._round(tweak, size, i, left)) % b
                else:
                    left = (left + sign * self._round(tweak, size, i, right)) % a
            x = left * b + right
            if x < size:
                return x


def luhn_digit(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return -total % 10


def card_valid(digits: str) -> bool:
    return len(set(digits)) > 1 and luhn_digit(digits[:-1]) == int(digits[-1])


def iban_rest(country: str, body: str) -> int:
    return int("".join(str(int(c, 36)) for c in f"{body}{country}00")) % 97


def day_of(m: re.Match) -> int | None:
    """The day of a date match as a number from FIRST_DAY, or None if there is no such day. Of 3/4/2020 the first is the day, unless it can only be the month."""
    if m[1]:
        y, mo, d = int(m[1]), int(m[3]), int(m[4])
    else:
        d, mo, y = int(m[5]), int(m[7]), int(m[8])
        if mo > 12 >= d:
            d, mo = mo, d
    try:
        n = date(y, mo, d).toordinal() - FIRST_DAY
    except ValueError:
        return None
    return n if 0 <= n < DAYS else None


def _poured(shape: str, digits: str) -> str:
    """shape with its digits replaced in turn."""
    left = iter(digits)
    return "".join(next(left) if "0" <= c <= "9" else c for c in shape)


def _letters(feistel: Feistel, text: str, tweak: str, back: bool) -> str:
    """ASCII letters and digits permuted together, each position within its own class; other characters stay."""
    sizes = [(10, 48) if c.isdigit() else (26, 97) if c.islower() else (26, 65) for c in text if c.isascii() and c.isalnum()]
    x, size = 0, 1
    for c, (n, low) in zip((c for c in text if c.isascii() and c.isalnum()), sizes, strict=True):
        x, size = x * n + ord(c) - low, size * n
    y, out = feistel.permute(x, size, tweak, back), []
    for n, low in reversed(sizes):
        y, d = divmod(y, n)
        out.append(chr(low + d))
    fresh = iter(reversed(out))
    return "".join(next(fresh) if c.isascii() and c.isalnum() else c for c in text)


def pseudonym(feistel: Feistel, kind: str, m: re.Match, back: bool = False) -> str | None:
    """What replaces a match, or None if it isn't a valid value of its kind. back undoes it."""
    text = m[0]
    digits = "".join(_DIGIT.findall(text))
    match kind:
        case "email":
            local, _, host = text.lower().partition("@")
            name, _, top = host.rpartition(".")
            return f"{_letters(feistel, local, 'email', back)}@{_letters(feistel, name, 'host', back)}.{top}"
        case "card":
            if not card_valid(digits):
                return None
            size = 10 ** (len(digits) - 1)
            # A number of one repeated digit isn't valid, so the walk goes on past it.
            fresh = int(digits[:-1])
            while True:
                fresh = feistel.permute(fresh, size, "card", back)
                done = f"{fresh:0{len(digits) - 1}d}"
                done += str(luhn_digit(done))
                if card_valid(done):
                    return _poured(text, done)
        case "iban":
            flat = text.replace(" ", "")
            country, check, body = flat[:2], int(flat[2:4]), flat[4:]
            if (98 - iban_rest(country, body)) != check:
                return None
            fresh = _letters(feistel, body, f"iban{country}", back)
            left = iter(f"{country}{98 - iban_rest(country, fresh):02d}{fresh}")
            return "".join(c if c == " " else next(left) for c in text)
        case "ipv4":
            parts = [int(p) for p in text.split(".")]
            if max(parts) > 255 or any(str(n) != p for n, p in zip(parts, text.split("."), strict=True)):
                return None
            fresh = feistel.permute(int.from_bytes(bytes(parts)), 1 << 32, "ipv4", back)
            return ".".join(map(str, fresh.to_bytes(4)))
        case "date":
            if (day := day_of(m)) is None:
                return None
            d = date.fromordinal(FIRST_DAY + feistel.permute(day, DAYS, "date", back))
            if m[1]:
                return f"{d.year:04d}{m[2]}{d.month:02d}{m[2]}{d.day:02d}"
            first, second = (d.month, d.day) if int(m[7]) > 12 and d.day > 12 else (d.day, d.month)
            width = 1 if len(m[5]) + len(m[7]) < 4 and not (m[5] + m[6] + m[7]).startswith("0") and m[7][0] != "0" else 2
            return f"{first:0{width}d}{m[6]}{second:0{width}d}{m[6]}{d.year:04d}"
        case "phone":
            code = re.match(r"\+[0-9]{1,3}(?=[ .(-])", text)
            keep = len(_DIGIT.findall(code[0])) if code else 0
            if not 7 <= len(digits) <= 15 or len(digits) - keep < 6:
                return None
            rest = digits[keep:]
            fresh = feistel.permute(int(rest), 10 ** len(rest), f"phone{len(rest)}", back)
            return _poured(text, f"{digits[:keep]}{fresh:0{len(rest)}d}")
        case "ssn":
            area, group, serial = int(m[1]), int(m[2]), int(m[3])
            if area in (0, 666) or area >= 900 or not group or not serial:
                return None
            x = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
            x = feistel.permute(x, 898 * 99 * 9999, "ssn", back)  # the areas from 1 to 899 but 666
            x, serial = divmod(x, 9999)
            area, group = divmod(x, 99)
            return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"
    return None


_PATTERNS = {"email": _EMAIL, "iban": _IBAN, "card": _CARD, "ipv4": _IPV4, "date": _DATE, "ssn": _SSN, "phone": _PHONE}


def replace(text: str, feistel: Feistel, back: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and (kind, start, end) of what they replace. Of overlapping values the kind listed first wins.

    In a run of parts each part is tried as the start of a value, with the longest valid range first, and the
    search goes on behind a valid range only; cards in their printed groups come before others, so no part of one
    is lost to a neighbour. So the pseudonym of a number beside others can be valid in a longer
    range, one time in ten for a card; then back needs the spans to find it.
    """
    taken: list[tuple[int, int, str, str]] = []
    marked = bytearray(len(text))
    has_digit = _DIGIT.search(text)

    def take(kind: str, m: re.Match) -> bool:
        fresh = None if marked.find(1, m.start(), m.end()) >= 0 else pseudonym(feistel, kind, m, back)
        if fresh is not None:
            marked[m.start() : m.end()] = b"\x01" * (m.end() - m.start())
            taken.append((m.start(), m.end(), kind, fresh))
        return fresh is not None

    for kind, pattern in _PATTERNS.items():
        if "@" not in text if kind == "email" else not has_digit:
            continue
        if kind not in _RUNS:
            for m in pattern.finditer(text):
                take(kind, m)
            continue
        for run in _RUNS[kind].finditer(text):
            parts = [p.span() for p in _PART.finditer(text, *run.span())]
            sums, (least, most) = [0, *accumulate(b - a for a, b in parts)], _SIZES[kind]
            for form in (_CARD_PRINTED, pattern) if kind == "card" else (pattern,):
                i = 0
                while i < len(parts):
                    ends = range(bisect_right(sums, sums[i] + most) - 1, bisect_left(sums, sums[i] + least) - 1, -1)
                    ranges = ((j, form.fullmatch(text, parts[i][0], parts[j - 1][1])) for j in ends)
                    i = next((j for j, m in ranges if m and take(kind, m)), i + 1)
    if not taken:
        return text, []
    taken.sort()
    out, at = [], 0
    for a, b, _, fresh in taken:
        out += [text[at:a], fresh]
        at = b
    return "".join([*out, text[at:]]), [(k, a, b) for a, b, k, _ in taken]


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """(row, masked_text, n_<kind> for each kind, spans) for every row of docs, without a shuffle.

    Numbers are validated (card and IBAN check digits, octets, days of the calendar, area codes) and then
    permuted among the valid values of their format by a keyed Feistel network, so a value has the same
    pseudonym in every document and format, and only the key leads back. Phone numbers keep their country code; the
    digits behind it are linked with the same digits without a code. Days and months without a leading zero
    get none. Invalid numbers stay. Spans are
    kind:start:end in code points of the input, comma-joined. A null or empty text has none and its
    masked_text is empty. The time is linear in a text's length.
    """
    added = ", ".join(["masked_text string", *[f"n_{k} long" for k in KINDS], "spans string"])

    def make():
        feistel = Feistel(key)

        def work(texts: list) -> dict[str, list]:
            got = [replace(t or "", feistel) for t in texts]
            counts = {f"n_{k}": [sum(s[0] == k for s in g[1]) for g in got] for k in KINDS}
            return counts | {"masked_text": [g[0] for g in got], "spans": [",".join(f"{k}:{a}:{b}" for k, a, b in g[1]) for g in got]}

        return work

    return map_texts(packed(docs, text), "body", added, make, drop=("body",))
