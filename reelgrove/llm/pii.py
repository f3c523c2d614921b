"""Format-preserving pseudonyms for personal data and secrets.

A value that passes its kind's check is mapped to its number in the set of all values of
its format, the number goes through a keyed Feistel network over exactly that set, and the
result is written in the same layout: a card number stays a valid card number of that
length, a date a real date. The map is one-to-one for a key, so equal values get equal
pseudonyms in all documents, whatever their separators, and different ones never meet.
"""

from __future__ import annotations

import bisect
import datetime
import hashlib
import ipaddress
import re
import secrets
import string
import unicodedata
import warnings
from collections.abc import Callable, Iterator
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

from reelgrove.llm.common import appended, slices

ROUNDS = 8
_FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2099, 12, 31).toordinal() - _FIRST_DAY + 1
_EARLY_DAYS, _LATE_DAYS = (
    [n for n in range(_FIRST_DAY, _FIRST_DAY + _DAYS) if (datetime.date.fromordinal(n).day > 12) == late]
    for late in (False, True)
)
_ALPHABETS = (string.digits, string.ascii_lowercase, string.ascii_uppercase)
# Calling codes of one and two digits; all others have three.
_SHORT_CODES = {"1", "7", "20", "27", "36", "39", "98", *map(str, range(30, 35)), *map(str, range(40, 42))} | {
    *map(str, range(43, 50)), *map(str, range(51, 59)), *map(str, range(60, 67)), "81", "82", "84", "86", *map(str, range(90, 96))
}
# Digits of a national number behind the calling code, least and most.
_NATIONAL = {
    "1": (10, 10), "7": (10, 10), "20": (8, 10), "27": (9, 9), "30": (10, 10), "31": (9, 9), "32": (8, 9), "33": (9, 9),
    "34": (9, 9), "36": (8, 9), "40": (9, 9), "41": (9, 9), "44": (9, 10), "45": (8, 8), "46": (7, 9), "47": (8, 8),
    "48": (9, 9), "51": (8, 9), "52": (10, 10), "54": (10, 11), "55": (10, 11), "56": (9, 9), "57": (10, 10), "60": (8, 10),
    "61": (9, 9), "63": (8, 10), "64": (8, 10), "65": (8, 8), "66": (8, 9), "81": (9, 10), "82": (8, 10), "84": (9, 10),
    "86": (10, 11), "90": (10, 10), "91": (10, 10), "92": (9, 10), "94": (9, 9), "98": (10, 10), "212": (9, 9),
    "234": (8, 10), "254": (9, 9), "351": (9, 9), "353": (7, 9), "354": (7, 7), "370": (8, 8), "371": (8, 8), "372": (7, 8),
    "380": (9, 9), "385": (8, 9), "386": (8, 8), "420": (9, 9), "421": (9, 9), "852": (8, 8), "886": (8, 9), "880": (10, 10),
    "966": (9, 9), "971": (8, 9), "972": (8, 9),
}
# Characters of an IBAN by country.
_IBAN_LENGTHS = {
    country: size
    for size, countries in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
# First digits and lengths of the large card issuers.
_ISSUED = re.compile(
    r"4(?:\d{12}|\d{15}|\d{18})|(?:5[1-5]\d\d|222[1-9]|22[3-9]\d|2[3-6]\d\d|27[01]\d|2720)\d{12}|3[47]\d{13}"
    r"|3(?:0[0-5]|[689]\d)\d{11}|(?:6011|64[4-9]\d|65\d\d|62\d\d|35[2-8]\d)\d{12,15}"
)
_CARD_GROUPS = re.compile(r"\d{13,19}|\d{4}([ -])(?:\d{4}\1){2,3}\d{1,4}|\d{4}([ -])\d{6}\2\d{4,5}")


KEY_SETTING = "spark.reelgrove.pii.key"


# Drawn secrets by application; no setting holds them, so no event log does.
_drawn: dict[str, bytes] = {}


def key_of(spark: SparkSession) -> bytes:
    """The secret in the session's settings, or one drawn at random for this application.

    Pseudonyms of different keys cannot be linked; whoever has the key can undo them. A drawn
    secret is told to nobody, so set one where several applications' pseudonyms have to agree.
    Only a local master has a fixed key for trials.
    """
    key = spark.conf.get(KEY_SETTING, None)
    if key:
        return key.encode()
    if spark.sparkContext.master.startswith("local"):
        return b"for local trials only"
    app = spark.sparkContext.applicationId
    if app not in _drawn:
        warnings.warn(f"{KEY_SETTING} is not set: pseudonyms agree in this application alone", stacklevel=2)
    return _drawn.setdefault(app, secrets.token_bytes(32))


def _told(number: int) -> bytes:
    """A number as text; Python writes none of more than 4,300 decimal digits."""
    return b"%d" % number if number.bit_length() < 14_000 else b"x%x" % number


class Feistel:
    """A keyed permutation of ``range(size)`` for any size."""

    def __init__(self, key: bytes):
        self.key = key

    def _round(self, kind: str, size: int, step: int, value: int, modulus: int) -> int:
        told = b"%s|%s|%s|%d|%s" % (self.key, kind.encode(), _told(size), step, _told(value))
        width = (modulus.bit_length() + 7) // 8 + 8
        return int.from_bytes(hashlib.shake_256(told).digest(width), "big") % modulus

    def permute(self, kind: str, value: int, size: int) -> int:
        if size < 2:
            return value
        a = isqrt(size - 1) + 1
        b = -(-size // a)
        while True:
            left, right = divmod(value, b)
            for step in range(0, ROUNDS, 2):
                left = (left + self._round(kind, size, step, right, a)) % a
                right = (right + self._round(kind, size, step + 1, left, b)) % b
            value = left * b + right
            if value < size:  # the two halves span a little more than the set: walk on
                return value


def luhn_digit(digits: str) -> int:
    """The digit that makes ``digits`` plus itself valid."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return -total % 10


def in_layout(layout: str, digits: str) -> str:
    """The digits in the places of the layout's digits."""
    it = iter(digits)
    return "".join(next(it) if "0" <= c <= "9" else c for c in layout)


def only_digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _digits(f: Feistel, kind: str, digits: str) -> str:
    return str(f.permute(kind, int(digits), 10 ** len(digits))).zfill(len(digits))


def _has_pair(c: str) -> bool:
    """A letter with one other case, of one character, that leads back to it."""
    other = c.swapcase()
    return len(other) == 1 and other != c and other.swapcase() == c


def _letter_kind(c: str) -> tuple[str, bool] | None:
    category = unicodedata.category(c)
    return (category, _has_pair(c)) if category[0] == "L" or category == "Nd" else None


@lru_cache(maxsize=4096)
def _alphabet(c: str) -> str | None:
    """The characters that may stand for a letter or digit: those of its kind and script.

    Beyond ASCII these are the letters of the same category and case in its row of 128 code
    points. Other characters (None) stay as they are.
    """
    if c.isascii():
        return next((a for a in _ALPHABETS if c in a), None)
    kind, first = _letter_kind(c), ord(c) // 128 * 128
    if kind is None:
        return None
    return "".join(d for d in map(chr, range(first, first + 128)) if not d.isascii() and _letter_kind(d) == kind)


def _number(places: list[int], sizes: list[int]) -> tuple[int, int]:
    """The number with these places, and of how many. Halves are joined, as long values are many."""
    if len(places) > 64:
        half = len(places) // 2
        (high, above), (low, below) = _number(places[:half], sizes[:half]), _number(places[half:], sizes[half:])
        return high * below + low, above * below
    number, size = 0, 1
    for place, of in zip(places, sizes):
        number, size = number * of + place, size * of
    return number, size


def _places(number: int, sizes: list[int]) -> list[int]:
    """The places of a number, as ``_number`` reads them."""
    if len(sizes) > 64:
        half = len(sizes) // 2
        high, low = divmod(number, _number(sizes[half:], sizes[half:])[1])
        return _places(high, sizes[:half]) + _places(low, sizes[half:])
    places = []
    for of in reversed(sizes):
        number, place = divmod(number, of)
        places.append(place)
    return places[::-1]


def _characters(f: Feistel, kind: str, text: str) -> str:
    """Permute all letters and digits, each within its alphabet."""
    own = [_alphabet(c) for c in text]
    sizes = [len(a) for a in own if a]
    number, size = _number([a.index(c) for c, a in zip(text, own) if a], sizes)
    new = iter(_places(f.permute(f"{kind}:{len(text)}", number, size), sizes))
    return "".join(a[next(new)] if a else c for c, a in zip(text, own))


def card_digits(found: str) -> str | None:
    digits = only_digits(found)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != int(digits[-1]):
        return None
    return digits


def card(f: Feistel, found: str) -> str | None:
    digits = card_digits(found)
    if digits is None:
        return None
    body = _digits(f, "card", digits[:-1])
    return in_layout(found, body + str(luhn_digit(body)))


def calling_code(digits: str) -> str:
    """The country's code at the start of an international number."""
    return next((digits[:n] for n in (1, 2) if digits[:n] in _SHORT_CODES), digits[:3])


def national(found: str) -> tuple[str, str, str]:
    """Country code, trunk zero as in ``(0)``, and the national digits behind ``+`` or ``00``."""
    found = found.removeprefix("00")
    digits = only_digits(found)
    code = calling_code(digits)
    rest = digits[len(code) :]
    trunk = "0" if re.sub("[^0-9()]", "", found)[len(code) :].startswith("(0)") else ""
    return code, trunk, rest[len(trunk) :]


def phone(f: Feistel, found: str) -> str | None:
    """The national digits change, the country code and a trunk zero stay."""
    if not found.startswith(("+", "00")):
        digits = only_digits(found)
        return in_layout(found, _digits(f, "phone", digits)) if digits else None
    head = "00" if found.startswith("00") else ""
    layout = found[len(head) :]
    if not 8 <= len(only_digits(layout)) <= 15:
        return None
    code, trunk, rest = national(found)
    return head + in_layout(layout, code + trunk + _digits(f, "phone", rest))


def ipv4(f: Feistel, found: str) -> str | None:
    parts = [int(p) for p in found.split(".")]
    if max(parts) > 255:
        return None
    number = f.permute("ipv4", int.from_bytes(bytes(parts), "big"), 1 << 32)
    return ".".join(map(str, number.to_bytes(4, "big")))


def ipv6(f: Feistel, found: str) -> str | None:
    """Any spelling of one address has one pseudonym. ``a::b`` may be a name in a program."""
    if found.count(":") < 3 and not re.match(r"(?=[0-9A-Fa-f]*\d)[0-9A-Fa-f]{4}:", found):
        return None
    try:
        number = int(ipaddress.IPv6Address(found))
    except ValueError:
        return None
    new = str(ipaddress.IPv6Address(f.permute("ipv6", number, 1 << 128)))
    return new.upper() if re.search("[A-F]", found) else new


def social_number(f: Feistel, found: str) -> str | None:
    """Three, two and four digits, none of them all zeros, the first not 666 or from 900."""
    area, group, serial = (int(p) for p in found.split("-"))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    number = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    number, serial = divmod(f.permute("social", number, 898 * 99 * 9999), 9999)
    area, group = divmod(number, 99)
    area += 1
    return f"{area + (area > 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def iban(f: Feistel, found: str) -> str | None:
    plain = found.replace(" ", "")

    def remainder(text: str) -> int:
        return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97

    if not 15 <= len(plain) <= 34 or remainder(plain) != 1:
        return None
    head = plain[:2]
    body = _characters(f, "iban:" + head, plain[4:])
    whole = f"{head}{98 - remainder(head + '00' + body):02d}{body}"
    it = iter(whole)
    return "".join(c if c == " " else next(it) for c in found)


def _moved(f: Feistel, day: datetime.date) -> datetime.date | None:
    """Another day. Days of a month up to 12 and later ones are permuted apart: which of two
    numbers is the day stays as plain as it was, and different dates never meet."""
    if not 0 <= day.toordinal() - _FIRST_DAY < _DAYS:
        return None
    late = day.day > 12
    own = _LATE_DAYS if late else _EARLY_DAYS
    number = bisect.bisect_left(own, day.toordinal())
    return datetime.date.fromordinal(own[f.permute(f"date{late}", number, len(own))])


def date(f: Feistel, found: str) -> str | None:
    """Year first, or day or month first: day first where the calendar allows it."""
    a, mark, b, _, c = re.split(r"([-/.])", found)
    orders = ["ymd"] if len(a) == 4 else ["dmy", "mdy"]
    for order in orders:
        parts = dict(zip(order, (a, b, c)))
        try:
            day = datetime.date(*(int(parts[k]) for k in "ymd"))
        except ValueError:
            continue
        day = _moved(f, day)
        if day is None:
            return None
        new = {"y": f"{day.year:04d}", "m": str(day.month), "d": str(day.day)}
        return mark.join(new[k].zfill(len(parts[k])) for k in order)
    return None


def named_date(f: Feistel, found: str) -> str | None:
    """A date with an English month; it has the pseudonym of the same date in numbers."""
    name = re.search("[A-Za-z]+", found)[0]
    month = next(i for i, m in enumerate(_MONTHS) if m[:3] == name[:3])
    day, year = re.findall(r"\d+", found)
    try:
        new = _moved(f, datetime.date(int(year), month + 1, int(day)))
    except ValueError:
        return None
    if new is None:
        return None
    full = _MONTHS[new.month - 1]
    words = {name: full if name == _MONTHS[month] else full[:3], day: str(new.day).zfill(len(day)), year: f"{new.year:04d}"}
    return re.sub(r"[A-Za-z]+|\d+", lambda m: words[m[0]], found)


def email(f: Feistel, found: str) -> str | None:
    """All but the last label, by the lower-case form; capitals stay capitals."""
    name, _, end = found.rpartition(".")
    capital = [c.isupper() and _has_pair(c) for c in name]
    new = _characters(f, "email", "".join(c.lower() if up else c for c, up in zip(name, capital)))
    return "".join(n.upper() if up else n for n, up in zip(new, capital)) + "." + end


def secret(f: Feistel, found: str) -> str | None:
    if re.fullmatch("[0-9a-f]+", found):
        size = len(found)
        return f"{f.permute('hex', int(found, 16), 16**size):0{size}x}"
    return _characters(f, "secret", found)


def access_key(f: Feistel, found: str) -> str | None:
    return found[:4] + _characters(f, "access", found[4:])


def credential(f: Feistel, found: str) -> str | None:
    """The issuer's mark stays, and the beginnings that all signed tokens have."""
    if found.startswith("eyJ"):
        first, second, third = found.split(".")
        new = _characters(f, "signed", f"{first[3:]}.{second[3:]}.{third}").split(".")
        return f"eyJ{new[0]}.eyJ{new[1]}.{new[2]}"
    mark = _MARKS.match(found).end()
    return found[:mark] + _characters(f, "credential:" + found[:mark], found[mark:])


def shorter(found: str) -> list[str]:
    """The text and its beginnings that end at a separator, longest first."""
    ends = [m.end() for m in re.finditer(r"[A-Za-z0-9](?![A-Za-z0-9])", found)]
    return [found[:end] for end in reversed(ends)]


def cards(found: str) -> Iterator[str]:
    """An issuer's number before other ones, so that no expiry date or code is part of it.

    Longest first in each group. What has no issuer's form is a card only if it is written
    in groups, and only where no issuer's number begins further behind: one in ten plain
    numbers of that length has a right check digit by chance.
    """
    every = [t for t in shorter(found) if card_digits(t)]
    issued = [t for t in every if _ISSUED.fullmatch(only_digits(t))]
    yield from issued
    for start in re.finditer(r"(?<=[ -])\d", found) if every and not issued else ():
        if any(_ISSUED.fullmatch(only_digits(t)) and card_digits(t) for t in shorter(found[start.start() :])):
            return
    yield from (t for t in every if not t.isdigit() and (t == found or _CARD_GROUPS.fullmatch(t)))


def phones(found: str) -> Iterator[str]:
    """The longest reading of a national length of its country, then any."""
    if not found.startswith(("+", "00")):
        yield found
        return
    every = shorter(found)
    for text in every:
        code, _, rest = national(text)
        least, most = _NATIONAL.get(code, (5, 15) if text[0] == "+" else (16, 0))
        if least <= len(rest) <= most:
            yield text
    if found.startswith("+"):
        yield from every


def ibans(found: str) -> Iterator[str]:
    """The reading of the country's length, then any."""
    every = shorter(found)
    size = _IBAN_LENGTHS.get(found[:2])
    yield from (t for t in every if len(t.replace(" ", "")) == size)
    yield from every


# Names of the months, marks that issuers put before their credentials, and
# words for secrets in settings.
_MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
_MARKS = re.compile(
    r"gh[oprsu]_|github_pat_|glpat-|xox[abeoprs]-|[prs]k_(?:live|test)_|AIza|npm_|hf_|sk-(?:ant-|proj-)?"
)
_SECRET_WORDS = r"(?i:passw(?:or)?d|passphrase|secret|token|(?:api|access|private|secret)[_-]?key)"
# A month in full or its first three letters.
_MONTH = "(?:" + "|".join(m[:3] + (f"(?:{m[3:]})?" if m[3:] else "") for m in _MONTHS) + ")"
# The word with its sign and quotes; the value behind it changes.
_SECRET_HEAD = _SECRET_WORDS + r"[\"'`]?\s{0,3}(?:=>|:=|[:=])\s{0,3}[\"'`]?"
_BEFORE = {"secret": re.compile(_SECRET_HEAD)}

# Tried from left to right at every place of a text; a failed check leaves the text as it is
# and the search goes on behind its first character.
KINDS: list[tuple[str, str, Callable[[Feistel, str], str | None]]] = [
    ("email", r"(?<![\w.+-])[\w+-][\w.+-]*@(?:[\w-]+\.)+(?:xn--[A-Za-z0-9-]+|[^\W\d_]{2,})(?![\w-])", email),
    (
        "secret",
        _SECRET_HEAD + r"(?:(?<=[\"'`])(?![$<{%])[^\s\"'`]{6,}(?=[\"'`])"
        r"|(?<=[=\"'`])[A-Za-z0-9_\-+/.]{8,}|(?<=[:= >])(?=[^\s]*(?:[0-9]|[a-z][A-Z]))[A-Za-z0-9_\-+/.]{8,})",
        secret,
    ),
    (
        "credential",
        r"(?<![\w-])(?:" + _MARKS.pattern + r")[A-Za-z0-9_-]{16,}(?![\w-])"
        r"|(?<![\w-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}(?![\w-])",
        credential,
    ),
    ("access_key", r"(?<![A-Za-z0-9])A(?:KIA|SIA)[A-Z0-9]{16}(?![A-Za-z0-9])", access_key),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", iban),
    ("ipv4", r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\w|\.\d)", ipv4),
    ("ipv6", r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}(?![\w:]|\.\d)", ipv6),
    (
        "named_date",
        rf"(?<!\w)(?:{_MONTH}\.? \d{{1,2}},? \d{{4}}|\d{{1,2}}\.? {_MONTH}\.?,? \d{{4}})(?!\w)",
        named_date,
    ),
    ("date", r"(?<![\w./-])(?:\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}-\d{1,2}-\d{4})(?!(?![Tt]\d)[\w/-])", date),
    ("social_number", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", social_number),
    ("card", r"(?<![\w])\d(?:[ -]?\d){12,18}(?!\w)", card),
    (
        "phone",
        r"(?<![\w+])(?:\+\d(?:[ .-]?\(?\d\)?){7,18}|(?<!\d[ .-])00[1-9]\d{0,2}[ .-]\(?\d(?:[ .-]?\(?\d\)?){5,14}|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w)",
        phone,
    ),
]
_FIND = re.compile("|".join(f"(?P<{name}>{pattern})" for name, pattern, _ in KINDS))
_WRITE = {name: write for name, _, write in KINDS}
_READINGS = {"card": cards, "phone": phones, "iban": ibans}
_HINT = re.compile(r"[0-9@]|(?i:passw|passphrase|secret|token|key)|eyJ|[kopsru]_|xox|glpat|sk-|AIza|npm_|hf_")

SPANS = T.ArrayType(
    T.StructType([
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
    ])
)


def written(kind: str, found: str, f: Feistel) -> tuple[int, str] | None:
    """Length and pseudonym of the first reading that passes the kind's check."""
    for reading in _READINGS.get(kind, lambda t: (t,))(found):
        new = _WRITE[kind](f, reading)
        if new is not None:
            return len(reading), new
    return None


def pseudonymised(text: str, f: Feistel) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and their kinds and places in it."""
    if not _HINT.search(text):
        return text, []
    out, spans, copied, at, length = [], [], 0, 0, 0
    while match := _FIND.search(text, at):
        kind, start = match.lastgroup, match.start()
        head = _BEFORE[kind].match(match[0]).end() if kind in _BEFORE else 0
        found = written(kind, match[0][head:], f)
        if found is not None:
            start += head
        else:
            # Another kind may hold where no reading of this one does.
            for other, pattern in _OTHERS[kind]:
                again = pattern.match(text, start)
                found = again and written(other, again[0], f)
                if found:
                    kind = other
                    break
        if not found:
            at = start + 1
            continue
        size, new = found
        before = text[copied:start]
        length += len(before)
        spans.append((kind, length, length + len(new)))
        out += [before, new]
        length += len(new)
        copied = at = start + max(size, 1)
    return "".join([*out, text[copied:]]), spans


_OTHERS = {
    name: [(other, re.compile(p)) for other, p, _ in KINDS[i + 1 :]]
    for i, (name, _, _) in enumerate(KINDS)
}


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """Replace personal data and secrets in ``text_col``; add ``pii_spans``.

    Found are e-mail addresses, card numbers (check digit), telephone numbers (country code
    or the form with an area code), IPv4 addresses, dates from 1900 to 2099, social security
    numbers, IBANs (check number), IPv6 addresses, dates with an English month, access keys,
    tokens with their issuer's mark, signed tokens, and values behind words like password or
    token with a colon or an equals sign, quoted or not; an unquoted one behind a colon needs a
    digit or an inner capital. A number directly behind a card, IBAN or telephone number is no part of it; where
    a country's telephone numbers vary in length, the longest reading holds. ``pii_spans`` lists kind, start and end (characters of the new text); an empty
    list where nothing was found, also for NULL texts, which stay NULL. All columns and rows
    are kept; a column ``pii_spans`` of the input is replaced. Row by row, nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feistel = Feistel(key)
        for batch in batches:
            for cut in slices(batch, text_col):
                results = [
                    (None, []) if t is None else pseudonymised(t, feistel)
                    for t in cut.column(text_col).to_pylist()
                ]
                spans = [[{"kind": k, "start": a, "end": b} for k, a, b in r[1]] for r in results]
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
                yield cut.set_column(
                    cut.schema.get_field_index(text_col), text_col, pa.array([r[0] for r in results], pa.string())
                ).append_column("pii_spans", pa.array(spans, kind))

    return appended(docs, run, [T.StructField("pii_spans", SPANS)])
