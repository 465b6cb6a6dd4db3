"""Replace personal data by format-preserving pseudonyms (operator 9)."""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywise.llm import words

ROUNDS = 10
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HEX = DIGITS + "abcdef"
DAY_0, DAYS = datetime.date(1900, 1, 1).toordinal(), 73049  # 1900-01-01 to 2099-12-31


def permute(value: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of 0 ... size - 1: a balanced Feistel network over the next even number of
    bits, walked on until the value falls below ``size`` again."""
    half = max((max(size - 1, 1).bit_length() + 1) // 2, 1)
    mask, n = (1 << half) - 1, (half + 7) // 8
    while True:
        left, right = value >> half, value & mask
        for i in range(ROUNDS):
            data = f"{tweak}|{size}|{i}|{right}".encode()
            mixed = int.from_bytes(hashlib.blake2b(data, key=key, digest_size=min(n + 8, 64)).digest(), "big")
            left, right = right, left ^ (mixed & mask)
        value = left << half | right
        if value < size:
            return value


def _characters(text: str, key: bytes, tweak: str, alphabets: tuple[str, ...] = (DIGITS, LOWER, UPPER)) -> str:
    """Each character permuted within its alphabet, all together; characters of none stay."""
    kinds = [next((k for k in alphabets if c in k), "") for c in text]
    value, size = 0, 1
    for c, kind in zip(text, kinds, strict=True):
        if kind:
            value, size = value * len(kind) + kind.index(c), size * len(kind)
    if size == 1:
        return text
    value, out = permute(value, size, key, tweak + "".join(k[:1] or c for c, k in zip(text, kinds, strict=True))), []
    for c, kind in zip(reversed(text), reversed(kinds), strict=True):
        if kind:
            value, at = divmod(value, len(kind))
            c = kind[at]
        out.append(c)
    return "".join(reversed(out))


def luhn(digits: str) -> int:
    """The sum of the digits, every second from the right doubled, modulo 10."""
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10


def _card(text: str, key: bytes) -> str | None:
    digits = re.sub(r"\D", "", text)
    if not 13 <= len(digits) <= 19 or luhn(digits):
        return None
    body = _characters(digits[:-1], key, "card")
    new = iter(body + str(-luhn(body + "0") % 10))
    return re.sub(r"\d", lambda _: next(new), text)


def _address(text: str, key: bytes) -> str | None:
    parts = [int(x) for x in text.split(".")]
    if max(parts) > 255:
        return None
    value = permute(int.from_bytes(bytes(parts), "big"), 1 << 32, key, "ip")
    return ".".join(map(str, value.to_bytes(4, "big")))


def _date(text: str, key: bytes) -> str | None:
    cut = re.split(r"[-/.]", text)
    year_first = len(cut[0]) == 4
    year, month, day = map(int, cut if year_first else cut[::-1])
    swapped = not year_first and month > 12
    if swapped:
        month, day = day, month
    try:
        at = datetime.date(year, month, day).toordinal() - DAY_0
    except ValueError:
        return None
    if not 0 <= at < DAYS:
        return None
    new = datetime.date.fromordinal(DAY_0 + permute(at, DAYS, key, "date"))
    order = [new.year, new.month, new.day] if year_first else [new.month, new.day, new.year] if swapped else [new.day, new.month, new.year]
    wide = iter(f"{x:0{4 if x == new.year else 2}d}" for x in order)
    return re.sub(r"\d+", lambda _: next(wide), text)


def _iban(text: str, key: bytes) -> str | None:
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body = _characters(plain[4:], key, "iban")
    new = iter(plain[:2] + f"{98 - number(body + plain[:2] + '00') % 97:02d}" + body)
    return re.sub(r"\w", lambda _: next(new), text)


def _phone(text: str, key: bytes) -> str | None:
    country = re.match(r"\+\d{1,3}(?=[ .\-(])", text)
    kept = country[0] if country else ""
    return kept + _characters(text[len(kept) :], key, "phone")


def _email(text: str, key: bytes) -> str | None:
    local, _, domain = text.partition("@")
    return f"{_characters(local, key, 'mail' + domain.lower())}@{domain}"


def _hex(text: str, key: bytes) -> str | None:
    if text.isupper():  # the same value in capitals
        return _hex(text.lower(), key).upper()
    return _characters(text, key, "hex", (HEX,) if text.lower() == text else (DIGITS, "abcdef", "ABCDEF"))


def _secret(prefix: str) -> Callable[[str, bytes], str | None]:
    def change(text: str, key: bytes) -> str | None:
        head = re.match(prefix, text)[0]
        return head + _characters(text[len(head) :], key, "secret")

    return change


#: Kinds in the order in which they are tried at a place: name, pattern, change (None: not valid).
KINDS: list[tuple[str, str, Callable[[str, bytes], str | None]]] = [
    ("email", r"[A-Za-z0-9][A-Za-z0-9._%+\-]{0,63}@[A-Za-z0-9.\-]{1,253}\.[A-Za-z]{2,24}", _email),
    ("access_key", r"AKIA[A-Z0-9]{16}\b", _secret("AKIA")),
    ("password", r"(?i:password|passwd|secret|api_?key|token)[\"']?\s?[=:]\s?[\"']?[^\s\"',;]{4,128}", _secret(r"\w+[\"']?\s?[=:]\s?[\"']?")),
    ("hex_key", r"(?=[a-fA-F]{0,63}\d)[0-9a-fA-F]{32,64}\b", _hex),
    ("iban", r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", _iban),
    ("date", r"(?:\d{4}-\d{2}-\d{2}|\d{1,2}[/.]\d{1,2}[/.]\d{4})(?!\d)", _date),
    ("ip", r"\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)", _address),
    ("ssn", r"\d{3}-\d{2}-\d{4}(?!\d)", lambda text, key: _characters(text, key, "ssn")),
    ("card", r"\d(?:[ \-]?\d){12,18}(?!\d)", _card),
    ("phone", r"(?:\+\d{1,3}[ .\-]?)?(?:\(\d{3}\) ?|\d{3}[.\-])\d{3}[ .\-]\d{4}(?!\d)|\+\d{1,3}(?:[ .\-]?\d{2,4}){2,4}(?!\d)", _phone),
]
#: Any text with one of these is looked at; no kind can do without.
TRIGGER = re.compile(r"[0-9@]|(?i:password|passwd|secret|api_?key|token)")
ANY = re.compile(r"(?<![\w@+])(?<!\d\.)(?=[\w+(])(?:" + "|".join(f"(?P<{name}>{pattern})" for name, pattern, _ in KINDS) + ")", re.ASCII)
PATTERNS = {name: (re.compile(pattern, re.ASCII), change) for name, pattern, change in KINDS}
#: Characters of an IBAN by country.
IBAN_SIZES = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28,
    "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18,
    "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21,
    "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28,
    "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "XK": 20,
}


def _lengths(name: str, text: str) -> list[str]:
    """What a check is tried on: the match, then what is left without its last groups, longest first.
    An IBAN's length in its country comes before all others."""
    if name not in ("card", "iban"):
        return [text]
    tries = [text, *(text[: m.start()] for m in reversed(list(re.finditer(r"[ \-]", text))))]
    if name == "iban":
        tries.sort(key=lambda x: len(x.replace(" ", "")) != IBAN_SIZES.get(x[:2]))
    return tries


def pseudonymize(text: str, key: bytes, known: dict[tuple[str, str], str]) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with pseudonyms, and where they stand in it (first and last character, kind)."""
    out, found, end, size, at = [], [], 0, 0, 0
    while (m := ANY.search(text, at)) is not None:
        # A kind that isn't valid here leaves the place to the next kind.
        for name in list(PATTERNS)[list(PATTERNS).index(m.lastgroup) :]:
            pattern, change = PATTERNS[name]
            if (hit := pattern.match(text, m.start())) is None:
                continue
            for value in _lengths(name, hit[0]):
                if (new := known.get((name, value))) is None and (new := change(value, key)) is not None:
                    if len(known) >= 100_000:
                        known.clear()
                    known[name, value] = new
                if new is not None:
                    break
            if new is not None:
                out += [text[end : hit.start()], new]
                size += hit.start() - end + len(new)
                found.append((size - len(new), size, name))
                end = at = hit.start() + len(value)
                break
        else:
            at = m.start() + 1
    return "".join([*out, text[end:]]), found


def pseudonymize_documents(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, text, n_found, found): each whole text with its personal data replaced, and where.

    Cards (Luhn), IBANs (modulo 97), IP addresses, dates, telephone and social security numbers,
    e-mail addresses and secrets are found by pattern and check, and permuted within their format by
    a keyed Feistel network: a card stays a valid card, a date a date. So equal values have equal
    pseudonyms in all documents, and different values of a format different ones. What fails its check
    stays; cards and IBANs are checked at shorter lengths too, up to where a group of them ends.

    A null text stays null with nothing found, an empty one empty. A row comes out for each row,
    whatever its id; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, str], str] = {}
        kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("kind", pa.string())]))
        for batch in batches:
            for part, _, _ in words.slices(batch, "text"):
                done = [(t, []) if t is None or not TRIGGER.search(t) else pseudonymize(t, key, known) for t in part.column("text").to_pylist()]
                found = [[{"first": a, "last": b, "kind": k} for a, b, k in x] for _, x in done]
                counts = pa.array([len(x) for x in found], pa.int64())
                yield pa.record_batch([part.column("id"), pa.array([t for t, _ in done], pa.string()), counts, pa.array(found, kind)], ["id", "text", "n_found", "found"])

    found = "array<struct<first:long,last:long,kind:string>>"
    schema = f"id {rows.schema['id'].dataType.simpleString()}, text string, n_found long, found {found}"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
