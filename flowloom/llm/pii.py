"""Format-preserving pseudonyms for personal data.

Found are card numbers (Luhn), IBANs (modulo 97), telephone numbers, social security numbers, IPv4 addresses, dates
that exist, e-mail addresses, and secrets behind words such as token or password.  Each is validated, read as a
number below the size of its format, permuted by a keyed Feistel network on that range, and written back in the same
format: separators stay, check digits are computed anew, dates remain dates.  A card or an IBAN may stand before other
numbers or capitals: where the longest match is not valid, shorter ends at its separators are tried.  The permutation is one to one and
depends on the key alone, so equal values have equal pseudonyms in all documents, and different ones different.

The network has ROUNDS rounds over the smallest even number of bits that holds the range, and walks on until it is
back in the range.

Bounds: dates are those of 1900 to 2099; a secret has 8 characters or more, or 5 of which one is a digit; of e-mail
addresses the name is permuted, the same for upper and lower case, and the domain stays; of numbers of countries other
than +1 the first three digits stay.

A null text stays null with nothing found; texts of any length are read whole, in time that grows with their length.
Every row is judged by itself, so that repeated rows, and rows that share a doc_id or have none, all come back; an
empty table gives none.  Only doc_id and text are read, whatever other columns there are.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ._common import documents, lean, slices

ROUNDS = 10
#: The setting that holds the key, and what counts where it is unset; a deployment sets its own.
KEY_SETTING = "spark.flowloom.pii.key"
KEY = b"flowloom-demonstration-key"


@lru_cache(maxsize=200_000)
def permute(value: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of range(size), one for each key, tweak and size."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask, width = (1 << half) - 1, (half + 7) // 8
    salt = f"{tweak}/{size}".encode()
    while True:
        left, right = value >> half, value & mask
        for k in range(ROUNDS):
            out = hashlib.blake2b(bytes([k]) + right.to_bytes(width, "big") + salt, key=key[:64], digest_size=max(8, width)).digest()
            left, right = right, left ^ (int.from_bytes(out, "big") & mask)
        value = left << half | right
        if value < size:
            return value


def luhn(digits: str) -> int:
    """The sum that is 0 for a valid number."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10


def refill(shape: str, characters: str) -> str:
    """shape with its letters and digits replaced in order."""
    it = iter(characters)
    return "".join(next(it) if c.isalnum() else c for c in shape)


def card_digits(found: str) -> str | None:
    """The digits of a valid card number."""
    digits = re.sub(r"\D", "", found)
    return None if not 13 <= len(digits) <= 19 or digits[0] == "0" or luhn(digits) or len(set(digits)) == 1 else digits


def card(found: str, key: bytes) -> str | None:
    digits = card_digits(found)
    if not digits:
        return None
    body = f"{permute(int(digits[1:-1]), 10 ** (len(digits) - 2), key, 'card' + digits[0]):0{len(digits) - 2}d}"
    start = digits[0] + body
    return refill(found, start + str(-luhn(start + "0") % 10))


#: How cards are printed.
_PRINTED = re.compile(r"\d{13,19}|\d{4}([ -])(?:\d{4}\1\d{4}\1\d{4}(?:\1\d{3})?|\d{6}\1\d{4,5}|\d{3}\1\d{3}\1\d{3})")


def card_end(found: str) -> int:
    """Where the card ends that begins these groups of digits, or 0.  Of several in them, one as cards are printed goes
    before others, then the first, then the longest; if that begins later, its turn comes later."""
    best = (False, 0, 0)
    groups = [m.span() for m in re.finditer(r"[0-9]+", found)]
    for i, (a, _) in enumerate(groups):
        for _, b in groups[i:]:
            if b - a >= 13 and card_digits(found[a:b]):
                best = max(best, (bool(_PRINTED.fullmatch(found[a:b])), -a, b))
    return best[2] if not best[1] else 0


def iban_rest(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def mixed(text: str, key: bytes, tweak: str) -> str:
    """Permutes digits and letters within their own kinds, as one number of mixed radix; the rest stays."""
    kinds = [(10, "0") if c.isdecimal() and c.isascii() else (26, "a") if "a" <= c <= "z" else (26, "A") if "A" <= c <= "Z" else None for c in text]
    value, size = 0, 1
    for c, k in zip(text, kinds, strict=True):
        if k:
            value, size = value * k[0] + ord(c) - ord(k[1]), size * k[0]
    if size < 2:
        return text
    shape = "".join(k[1] if k else c for c, k in zip(text, kinds, strict=True))
    value, out = permute(value, size, key, f"{tweak}:{shape}"), []
    for c, k in zip(reversed(text), reversed(kinds), strict=True):
        if k:
            value, digit = divmod(value, k[0])
            c = chr(ord(k[1]) + digit)
        out.append(c)
    return "".join(reversed(out))


def iban(found: str, key: bytes) -> str | None:
    plain = found.replace(" ", "")
    if not 15 <= len(plain) <= 34 or iban_rest(plain) != 1:
        return None
    body = mixed(plain[4:], key, "iban" + plain[:2])
    return refill(found, plain[:2] + f"{98 - iban_rest(plain[:2] + '00' + body):02d}" + body)


#: Characters of an IBAN by country.
_IBAN_LENGTHS = {c: n for n, cs in ((15, "NO"), (16, "BE"), (18, "DK FI FK FO GL NL SD"), (19, "MK SI"), (20, "AT BA EE KZ LT LU MN XK"), (21, "CH CR HR LI LV"), (22, "BG BH DE GB GE IE ME RS VA"), (23, "AE GI IL IQ OM SO TL"), (24, "AD CZ ES MD PK RO SA SE SK TN VG"), (25, "LY PT ST"), (26, "IS TR"), (27, "BI DJ FR GR IT MC MR SM"), (28, "AL AZ BY CY DO GT HN HU LB NI PL SV"), (29, "BR EG PS QA UA"), (30, "JO KW MU YE"), (31, "MT SC"), (32, "LC"), (33, "RU")) for c in cs.split()}


def iban_end(found: str) -> int:
    """Where the IBAN ends that begins these groups, or 0: at its country's length, or else at the last separator that fits."""
    ends = [m.end() for m in re.finditer(r"[A-Z0-9]+", found)]
    size = _IBAN_LENGTHS.get(found[:2])
    for end in sorted(ends, key=lambda e: (len(found[:e].replace(" ", "")) == size, e), reverse=True):
        plain = found[:end].replace(" ", "")
        if 15 <= len(plain) <= 34 and iban_rest(plain) == 1:
            return end
    return 0


def phone(found: str, key: bytes) -> str | None:
    digits = re.sub(r"\D", "", found)
    code = ""
    if found.startswith("+"):
        if digits[0] != "1":  # the country's plan is not known: the first three digits stay
            rest = digits[3:]
            return refill(found, digits[:3] + f"{permute(int(rest), 10 ** len(rest), key, 'phone' + digits[:3] + str(len(rest))):0{len(rest)}d}") if 8 <= len(digits) <= 15 else None
        code, digits = "1", digits[1:]
    elif len(digits) == 11 and digits[0] == "1":
        code, digits = "1", digits[1:]
    if len(digits) != 10:
        return None
    if digits[0] in "01" or digits[3] in "01":  # not assigned, but a number all the same: permuted among such
        value = permute(int(digits), 10**10, key, "phone-other")
        while (text := f"{value:010d}")[0] not in "01" and text[3] not in "01":
            value = permute(value, 10**10, key, "phone-other")
        return refill(found, code + text)
    area, exchange, line = int(digits[:3]) - 200, int(digits[3:6]) - 200, int(digits[6:])
    value = permute((area * 800 + exchange) * 10_000 + line, 800 * 800 * 10_000, key, "phone")
    value, line = divmod(value, 10_000)
    area, exchange = divmod(value, 800)
    return refill(found, f"{code}{area + 200}{exchange + 200}{line:04d}")


def social(found: str, key: bytes) -> str | None:
    a, b, c = (int(x) for x in found.split("-"))
    if a in (0, 666) or a >= 900 or not b or not c:
        return None
    a -= 1 + (a > 666)
    value = permute((a * 99 + b - 1) * 9999 + c - 1, 898 * 99 * 9999, key, "ssn")
    value, c = divmod(value, 9999)
    a, b = divmod(value, 99)
    a += 1 + (a + 1 >= 666)
    return f"{a:03d}-{b + 1:02d}-{c + 1:04d}"


def address(found: str, key: bytes) -> str | None:
    parts = [int(x) for x in found.split(".")]
    if any(x > 255 for x in parts):
        return None
    value = permute(parts[0] << 24 | parts[1] << 16 | parts[2] << 8 | parts[3], 1 << 32, key, "ipv4")
    return f"{value >> 24}.{value >> 16 & 255}.{value >> 8 & 255}.{value & 255}"


FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


def date(found: str, key: bytes) -> str | None:
    parts = re.split(r"[-./]", found)
    separators = re.findall(r"[-./]", found)
    for order in ((0, 1, 2),) if len(parts[0]) == 4 else ((2, 1, 0), (2, 0, 1)):  # year, month, day; else day or month first
        try:
            day = datetime.date(*(int(parts[i]) for i in order)).toordinal()
        except ValueError:
            continue
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        new = datetime.date.fromordinal(FIRST_DAY + permute(day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, key, "date"))
        out = [""] * 3
        for i, x in zip(order, (f"{new.year:04d}", f"{new.month:02d}", f"{new.day:02d}"), strict=True):
            out[i] = x
        return out[0] + separators[0] + out[1] + separators[1] + out[2]
    return None


def email(found: str, key: bytes) -> str | None:
    name, _, domain = found.rpartition("@")
    new = mixed(name.lower(), key, "email@" + domain.lower()) if len(name.lower()) == len(name) else mixed(name, key, "email@" + domain.lower())
    return "".join(b.upper() if a.isupper() else b for a, b in zip(name, new, strict=True)) + "@" + domain


def secret(found: str, key: bytes) -> str | None:
    if re.fullmatch(r"[0-9a-f]+", found):
        return f"{permute(int(found, 16), 16 ** len(found), key, f'hex{len(found)}'):0{len(found)}x}"
    return mixed(found, key, "secret")


#: In order of preference where two begin at one place; e-mail addresses come second.
_KINDS = (
    ("secret", secret, r"(?i:\b(?:api[_-]?key|secret|token|passw(?:or)?d|pwd|access[_-]?key)\b)\s*[:=]\s*[\"']?(?P<secret>[A-Za-z0-9+/_\-]{8,}|(?=[A-Za-z]*[0-9])[A-Za-z0-9+/_\-]{5,})"),
    ("iban", iban, r"(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b)"),
    ("date", date, r"(?P<date>(?<![\d.])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}[./-]\d{2}[./-]\d{4})(?![\d]))"),
    ("ipv4", address, r"(?P<ipv4>(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d))"),
    ("ssn", social, r"(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"),
    ("phone", phone, r"(?P<phone>(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d(?:[ .-]?\d){5,11}(?!\d)|(?<![\w(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\w.-])(?:1[ .-])?\d{3}[.-]\d{3}[.-]\d{4}(?![\w.-]\d))"),
    ("card", card, r"(?P<card>(?<![\w])\d(?:[ -]?\d){12,18}(?!\w))"),
)
_ANY = re.compile("|".join(pattern for _, _, pattern in _KINDS))
_MAY = re.compile("[0-9@]|(?i:token|secret|passw|pwd|key)")
_BY_KIND = {name: f for name, f, _ in _KINDS} | {"email": email}
_DOMAIN = re.compile(r"@[A-Za-z0-9](?:[A-Za-z0-9-]*\.)+[A-Za-z]{2,}")
_NAME_END = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_+-")
_SHORTER = {"card": card_end, "iban": iban_end}
_CARD = re.compile(_KINDS[-1][2])


def mails(text: str) -> Iterator[tuple[int, int, int]]:
    """For each e-mail address, from its sign on: where the characters before the sign that may be its name begin, the sign, the end."""
    sign = text.find("@")
    while sign >= 0:
        if sign and text[sign - 1] in _NAME_END and (m := _DOMAIN.match(text, sign)):
            begin = sign
            while begin and (text[begin - 1].isalnum() or text[begin - 1] in "_.+-"):
                begin -= 1
            yield begin, sign, m.end()
        sign = text.find("@", sign + 1)


def name_begin(text: str, begin: int, sign: int) -> int:
    """Where the name of an address begins, from begin on; the sign if nowhere."""
    while begin < sign and not (text[begin].isascii() and text[begin].isalnum()):
        begin += 1
    return begin


def pseudonymised(text: str, key: bytes = KEY) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and the kind and place in the old text of each that was found."""
    if not _MAY.search(text):
        return text, []
    out, found, last, at = [], [], 0, 0
    addresses = mails(text)
    mail, m = next(addresses, None), _ANY.search(text)
    while True:
        if m and m.start() < at:
            m = _ANY.search(text, at)
        while mail and (start := name_begin(text, max(at, mail[0]), mail[1])) >= mail[1]:
            mail = next(addresses, None)
        if not m and not mail:
            break
        if mail and (not m or start < m.start() or start == m.start() and m.lastgroup != "secret"):
            kind, begin, end = "email", start, mail[2]
        else:
            kind = m.lastgroup
            begin, end = m.span(kind)
        new = _BY_KIND[kind](text[begin:end], key)
        if new is None and kind == "phone" and (c := _CARD.match(text, begin)):
            kind, end = "card", c.end()
            new = card(c[0], key)
        if new is None and kind in _SHORTER and (size := _SHORTER[kind](text[begin:end])):
            end = begin + size
            new = _BY_KIND[kind](text[begin:end], key)
        if new is None:
            at = begin + 1 if kind != "secret" else end
            while at < len(text) and text[at].isalnum() and text[at - 1].isalnum():
                at += 1  # no part of a longer number
            continue
        out += [text[last:begin], new]
        found.append((kind, begin, end))
        last = at = end
    return "".join([*out, text[last:]]), found


def pseudonyms(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """doc_id, n_found, kinds (of what was found, in order), spans (places in the old text), text (the new one)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out, found = [], []
            for text in batch.column("text").to_pylist():
                new, own = (None, []) if text is None else pseudonymised(text, key)
                out.append(new)
                found.append(own)
            kinds = pa.array([[k for k, _, _ in x] for x in found], pa.list_(pa.string()))
            spans = pa.array([[{"begin": a, "end": b} for _, a, b in x] for x in found], pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(x) for x in found], pa.int64()), kinds, spans, pa.array(out, pa.string())], names=["doc_id", "n_found", "kinds", "spans", "text"])

    return docs.select("doc_id", "text").mapInArrow(lean(run), "doc_id long, n_found long, kinds array<string>, spans array<struct<begin: long, end: long>>, text string")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get(KEY_SETTING, None)
    return pseudonyms(documents(spark, sf_dir), key.encode() if key else KEY)
