"""Format-preserving pseudonyms for personal numbers, dates and addresses.

A value is found by its shape and validated (check digits, ranges, the calendar). It is
then read as a number within its format, permuted there by a keyed Feistel network, and
written back in the same layout. The permutation depends on the key, the kind and the
format alone, so equal values get equal pseudonyms in all documents, different values
stay different, and the key's holder can undo it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


ROUNDS = 8
FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)

# The characters that may stand for each other.
ALPHABETS = (
    "0123456789",
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ",
    "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ",
)
HEX = ("0123456789abcdef", "0123456789ABCDEF")
# Length of an IBAN by country, as registered.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27,
    "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28,
    "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23,
    "GL": 18, "GR": 27, "GT": 28, "HN": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21,
    "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28,
    "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22,
    "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25,
    "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}


def _iban_account(length: int) -> str:
    """The account of an IBAN of this length, with or without a blank before each four."""
    whole, rest = divmod(length - 4, 4)
    return f"(?:[ ]?[0-9A-Z]{{4}}){{{whole}}}" + (f"[ ]?[0-9A-Z]{{{rest}}}" if rest else "")


IBAN_SHAPES = "|".join(
    f"(?:{'|'.join(c for c in IBAN_LENGTHS if IBAN_LENGTHS[c] == n)})[0-9]{{2}}{_iban_account(n)}"
    for n in sorted(set(IBAN_LENGTHS.values()))
)

SHAPES = re.compile(
    r"""
    (?P<email>(?<![\w.%+-])[\w.%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![\w-]))
  | (?P<secret>(?<![0-9A-Za-z])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![0-9A-Za-z]))
  | (?P<iban>(?<![0-9A-Za-z])(?=[A-Z]{2}[0-9]{2})(?:IBAN_SHAPES)(?![0-9A-Za-z]))
  | (?P<ip>(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\w|\.[0-9]))
  | (?P<date>(?<![\w./-])(?:
        [0-9]{4}(?P<s1>[-/.])[0-9]{1,2}(?P=s1)[0-9]{1,2}
      | [0-9]{1,2}(?P<s2>[-/.])[0-9]{1,2}(?P=s2)[0-9]{4})(?!\w|[./-][0-9]))
  | (?P<phone>(?<![\w+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9A-Za-z])
      | (?<![\w(+.-])(?:\([0-9]{3}\)[ ]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?!\w|-[0-9]))
  | (?P<ssn>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?!\w|-[0-9]))
  | (?P<card>(?<![0-9A-Za-z])(?:
        [0-9]{13,19}
      | [0-9]{4}(?P<s3>[ -])[0-9]{4}(?P=s3)[0-9]{4}(?P=s3)[0-9]{4}
      | [0-9]{4}(?P<s4>[ -])[0-9]{6}(?P=s4)[0-9]{5})(?![0-9A-Za-z]))
    """.replace("IBAN_SHAPES", IBAN_SHAPES),
    re.VERBOSE,
)
TRACE = re.compile("[0-9@]")


class Feistel:
    """A keyed permutation of ``range(size)``, for any size."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, label: str, size: int, turn: int, half: int, modulus: int) -> int:
        message = f"{label}:{size}:{turn}:{half}".encode()
        # Sixteen bytes more than the half has keep the remainder even.
        width = (modulus.bit_length() + 7) // 8 + 16
        out, block = b"", 0
        while len(out) < width:
            out += hashlib.blake2b(message + bytes([block]), key=self.key).digest()
            block += 1
        return int.from_bytes(out[:width], "big") % modulus

    def permute(self, value: int, size: int, label: str, undo: bool = False) -> int:
        """The value's image; values outside walk on until they are inside again."""
        root = isqrt(size - 1) + 1
        turns = range(ROUNDS)[::-1] if undo else range(ROUNDS)
        while True:
            left, right = divmod(value, root)
            for turn in turns:
                if undo:
                    left, right = (right - self._round(label, size, turn, left, root)) % root, left
                else:
                    left, right = right, (left + self._round(label, size, turn, right, root)) % root
            value = left * root + right
            if value < size:
                return value

    def letters(self, text: str, label: str, undo: bool = False, alphabets=ALPHABETS) -> str:
        """Each character replaced within its alphabet, all of them as one number; others stay."""
        at = [next((a for a in alphabets if c in a), None) for c in text]
        value, size = 0, 1
        for c, alphabet in zip(text, at, strict=True):
            if alphabet:
                value, size = value * len(alphabet) + alphabet.index(c), size * len(alphabet)
        value, out = self.permute(value, size, label, undo), []
        for c, alphabet in zip(reversed(text), reversed(at), strict=True):
            if alphabet:
                value, digit = divmod(value, len(alphabet))
                c = alphabet[digit]
            out.append(c)
        return "".join(reversed(out))


def luhn_digit(payload: str) -> str:
    """Check digit that a card number ends with."""
    total = 0
    for i, c in enumerate(reversed(payload)):
        digit = int(c) * (2 if i % 2 == 0 else 1)
        total += digit - 9 if digit > 9 else digit
    return str(-total % 10)


def iban_digits(country: str, account: str) -> str:
    """Check digits that stand after an IBAN's country."""
    number = "".join(str(int(c, 36)) for c in f"{account}{country}00")
    return f"{98 - int(number) % 97:02d}"


def _relaid(shape: str, characters: str) -> str:
    """``characters`` in the layout of ``shape``, whose separators stay."""
    source = iter(characters)
    return "".join(next(source) if c.isalnum() else c for c in shape)


def _email(text: str, f: Feistel, undo: bool) -> str | None:
    local, _, host = text.partition("@")
    if local.startswith(".") or local.endswith(".") or ".." in text:
        return None
    return f"{f.letters(local, 'email', undo)}@{host}"


def _secret(text: str, f: Feistel, undo: bool) -> str | None:
    if text.isdigit() or text.isalpha():
        return None
    alphabet = HEX[any(c.isupper() for c in text)]
    return f.letters(text, "secret", undo, (alphabet,))


def _iban(text: str, f: Feistel, undo: bool) -> str | None:
    plain = text.replace(" ", "")
    country, account = plain[:2], plain[4:]
    if IBAN_LENGTHS.get(country) != len(plain) or iban_digits(country, account) != plain[2:4]:
        return None
    account = f.letters(account, f"iban {country}", undo)
    return _relaid(text, country + iban_digits(country, account) + account)


def _ip(text: str, f: Feistel, undo: bool) -> str | None:
    parts = text.split(".")
    if any(int(x) > 255 or x != str(int(x)) for x in parts):
        return None
    value = int.from_bytes(bytes(map(int, parts)), "big")
    return ".".join(map(str, f.permute(value, 1 << 32, "ip", undo).to_bytes(4, "big")))


def _date(text: str, f: Feistel, undo: bool) -> str | None:
    separator = re.search(r"[^0-9]", text)[0]
    parts = text.split(separator)
    orders = ((0, 1, 2),) if len(parts[0]) == 4 else ((2, 1, 0), (2, 0, 1))
    for year, month, day in orders:
        try:
            found = date(int(parts[year]), int(parts[month]), int(parts[day]))
        except ValueError:
            continue
        if not FIRST_DAY <= found <= LAST_DAY:
            return None
        size = (LAST_DAY - FIRST_DAY).days + 1
        at = f.permute((found - FIRST_DAY).days, size, "date", undo)
        other = FIRST_DAY + timedelta(days=at)
        parts[year] = str(other.year)
        width = 1 if min(len(parts[month]), len(parts[day])) == 1 else 2
        parts[month], parts[day] = f"{other.month:0{width}d}", f"{other.day:0{width}d}"
        return separator.join(parts)
    return None


def _phone(text: str, f: Feistel, undo: bool) -> str | None:
    digits = re.sub(r"[^0-9]", "", text)
    country = len(re.match(r"\+([0-9]*)", text)[1]) if text[0] == "+" else 0
    if not 8 <= len(digits) <= 15 or len(digits) - country < 6:
        return None
    rest = f.letters(digits[country:], "phone", undo)
    return _relaid(text, digits[:country] + rest)


def _ssn(text: str, f: Feistel, undo: bool) -> str | None:
    area, group, serial = map(int, text.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    areas = [x for x in range(1, 900) if x != 666]
    value = (areas.index(area) * 99 + group - 1) * 9999 + serial - 1
    value = f.permute(value, len(areas) * 99 * 9999, "ssn", undo)
    value, serial = divmod(value, 9999)
    area, group = divmod(value, 99)
    return f"{areas[area]:03d}-{group + 1:02d}-{serial + 1:04d}"


def _card(text: str, f: Feistel, undo: bool) -> str | None:
    digits = re.sub(r"[^0-9]", "", text)
    if len(set(digits)) == 1 or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    payload = f.letters(digits[:-1], "card", undo)
    return _relaid(text, payload + luhn_digit(payload))


KINDS: dict[str, Callable[[str, Feistel, bool], str | None]] = {
    "email": _email,
    "secret": _secret,
    "iban": _iban,
    "ip": _ip,
    "date": _date,
    "phone": _phone,
    "ssn": _ssn,
    "card": _card,
}


def pseudonymise(text: str, f: Feistel, undo: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and (kind, start, length) of each one in it."""
    if not TRACE.search(text):
        return text, []
    out, spans, end, size = [], [], 0, 0
    match = SHAPES.search(text)
    while match:
        kind = match.lastgroup if match.lastgroup in KINDS else next(k for k in KINDS if match[k])
        value = KINDS[kind](match[0], f, undo)
        if value is None:
            # What begins inside a shape that is not valid may be.
            match = SHAPES.search(text, match.start() + 1)
            continue
        out.append(text[end : match.start()])
        size += len(out[-1])
        spans.append((kind, size, len(value)))
        out.append(value)
        size += len(value)
        end = match.end()
        match = SHAPES.search(text, end)
    return "".join([*out, text[end:]]), spans


SPANS = "array<struct<kind: string, start: int, length: int>>"


def _run(key: bytes, undo: bool):
    kind = pa.struct({"kind": pa.string(), "start": pa.int32(), "length": pa.int32()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feistel = Feistel(key)
        for batch in batches:
            found = [
                (None, []) if text is None else pseudonymise(text, feistel, undo)
                for text in batch.column("_text").to_pylist()
            ]
            texts = pa.array([text for text, _ in found], pa.string())
            names = ("kind", "start", "length")
            spans = [[dict(zip(names, x, strict=True)) for x in rows] for _, rows in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), texts, pa.array(spans, pa.list_(kind))],
                ["_row", "_text", "_spans"],
            )

    return run


def mask_private(
    docs: DataFrame, key: bytes, text: str = "text", undo: bool = False
) -> DataFrame:
    """``docs`` with pseudonyms in the text, and ``pii_spans`` (kind, start, length in it).

    A null text stays null, texts without private values stay as they are, and repeated
    rows are treated alike. An input column named pii_spans gives way. With ``undo`` and
    the same key the texts come back.
    """
    names = [x for x in docs.columns if x.lower() not in (text.lower(), "pii_spans")]
    held = docs.select(
        F.struct(F.lit(0).alias("_"), *[f"`{x}`" for x in names]).alias("_row"),
        F.col(f"`{text}`").alias("_text"),
    )
    row = held.schema["_row"].dataType.simpleString()
    done = held.mapInArrow(_run(key, undo), f"_row {row}, _text string, _spans {SPANS}")
    at = {x: F.col(f"_row.`{x}`") for x in names} | {text: F.col("_text")}
    ordered = [at[x].alias(x) for x in docs.columns if x in at]
    return done.select(*ordered, F.col("_spans").alias("pii_spans"))
