"""Format-preserving pseudonyms for personal data by a keyed Feistel permutation.

Values are found by form and validated (check digits, calendar, numbering rules); each kind is an interval of
whole numbers that its valid values are mapped onto one to one, and a Feistel network keyed with HMAC
permutes that interval. Numbers outside of the interval are walked on until they come back, so that the
map is a permutation: equal values get equal pseudonyms in all documents, different values different
ones, and the pseudonym is valid in the same format (punctuation, length, check digit, calendar). Whoever
has the key can invert it.

Kinds: card (13 to 19 digits with a Luhn check digit; the first digit stays), iban (mod 97; country and layout stay),
ssn, phone (North American numbers, and international ones after ``+`` with their country code kept),
ipv4 (private, loopback and other reserved addresses are left alone), date (from 1900 to 2099, day first or
month first as written, impossible dates are left alone) and email (the local part's letters and digits,
each in its own alphabet, and the domain stays).

A match that isn't valid as a whole is cut at its separators: printed layouts of cards and the country's length of
an IBAN come first, then all shorter spans, and the search goes on just after its start. Where digits stand
beside a value, another span may turn valid by chance under a pseudonym; inversion of such texts needs the items.

Defined results: null texts stay null and empty ones empty, both without items; repeated rows give the same
text; null ids are kept; an empty table gives an empty result; other columns are ignored by ``found_items``
and carried by ``pseudonymised``.
"""

from __future__ import annotations

import datetime
import hashlib
import hmac
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import query, table

ROUNDS = 8
FORMS = {
    "email": r"""(?P<email>(?<![\w.+-])[A-Za-z0-9](?:[A-Za-z0-9._+-]*[A-Za-z0-9])?@[A-Za-z0-9](?:[A-Za-z0-9.-]*[A-Za-z0-9])?\.[A-Za-z]{2,})""",
    "iban": r"""(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:\ ?[A-Z0-9]){11,30}(?![A-Za-z0-9]))""",
    "ipv4": r"""(?P<ipv4>(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d))""",
    "date": r"""(?P<date>(?<![\d/.-])(?:\d{4}(?P<m>[-/.])\d{1,2}(?P=m)\d{1,2}|\d{1,2}(?P<n>[-/.])\d{1,2}(?P=n)\d{4})(?![\d]|[/.-]\d))""",
    "phone": r"""(?P<phone>(?<![\w])\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)|(?<![\w+])\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}(?!\d)|(?<![\w+.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])|(?<![\w])\+[2-9]\d{0,2}[ .-]?(?:\d[ .-]?){6,11}\d(?!\d))""",
    "ssn": r"""(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))""",
    "card": r"""(?P<card>(?<![\d])\d(?:[ -]?\d){12,18}(?!\d))""",
}
PATTERN = re.compile("|".join(FORMS.values()), re.X | re.A)
SINGLE = {kind: re.compile(form, re.X | re.A) for kind, form in FORMS.items()}
#: Cards as they are printed: in one piece, in fours, or as 4, 6 and 5 digits.
PRINTED = re.compile(r"(?<!\d)(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}(?:\1\d{3})?|\d{4}([ -])\d{6}\2\d{5})(?!\d)", re.A)
#: Characters of an IBAN by country.
IBAN_SIZES = {
    k[:2]: int(k[2:])
    for k in (
        "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 "
        "GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 "
        "PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30"
    ).split()
}
#: Texts without any of these hold nothing that PATTERN matches.
MAYBE = re.compile(r"@|\+\d|\d[ -]?\d[ -]?\d|\d[-/.]\d|[A-Z]{2}\d{2}", re.A)
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
#: Country codes of one and two digits; all others have three.
SHORT_CODES = frozenset("7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())


class Feistel:
    """Keyed permutations of 0 .. n - 1, one for every label."""

    def __init__(self, key: bytes, rounds: int = ROUNDS):
        if not key:
            raise ValueError("a key is needed")
        self.key, self.rounds = key, rounds

    def _part(self, label: bytes, turn: int, half: int, bits: int) -> int:
        size = (bits + 7) // 8
        raw = hmac.new(self.key, b"%b|%d|%d|%d" % (label, turn, bits, half), hashlib.sha256).digest()
        return int.from_bytes(raw[:size] if size <= 32 else raw, "big") & ((1 << bits) - 1)

    def _once(self, label: bytes, x: int, bits: int, turns: range) -> int:
        low_bits = bits // 2
        high, low = x >> low_bits, x & ((1 << low_bits) - 1)
        for turn in turns:  # unbalanced halves take turns, so that widths never mix
            if turn % 2 == 0:
                high ^= self._part(label, turn, low, bits - low_bits)
            else:
                low ^= self._part(label, turn, high, low_bits)
        return high << low_bits | low

    def permute(self, label: str, x: int, n: int, back: bool = False) -> int:
        if n < 2:
            return x
        bits, name = max(2, (n - 1).bit_length()), f"{label}|{n}".encode()
        turns = range(self.rounds - 1, -1, -1) if back else range(self.rounds)
        while True:
            x = self._once(name, x, bits, turns)
            if x < n:
                return x

    def digits(self, label: str, digits: str, back: bool = False) -> str:
        return str(self.permute(label, int(digits), 10 ** len(digits), back)).zfill(len(digits)) if digits else ""


def luhn_digit(payload: str) -> str:
    total = 0
    for k, d in enumerate(reversed(payload)):
        n = int(d) * (2 - k % 2)
        total += n - 9 * (n > 9)
    return str(-total % 10)


def _fill(form: str, digits: str) -> str:
    """``form`` with its digits replaced in order."""
    new = iter(digits)
    return "".join(next(new) if c.isdigit() else c for c in form)


def card(f: Feistel, value: str, back: bool = False) -> str | None:
    d = re.sub(r"\D", "", value)
    if len(set(d)) == 1 or luhn_digit(d[:-1]) != d[-1]:
        return None
    payload = d[0] + f.digits("card" + d[0], d[1:-1], back)
    new = payload + luhn_digit(payload)
    return _fill(value, new)


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def iban(f: Feistel, value: str, back: bool = False) -> str | None:
    plain = value.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _mod97(plain[4:] + plain[:4]) != 1:
        return None
    body = plain[4:]
    label = "iban" + plain[:2] + "".join("9" if c.isdigit() else "A" for c in body)
    new = _mixed(f, label, body, back)
    whole = iter(f"{plain[:2]}{98 - _mod97(new + plain[:2] + '00'):02d}{new}")
    return "".join(" " if c == " " else next(whole) for c in value)


def _mixed(f: Feistel, label: str, text: str, back: bool = False) -> str:
    """Every digit and letter within its own alphabet (case stays), as one number of mixed bases."""
    bases = [(ord("0"), 10) if c.isdigit() else (ord("a"), 26) if c.islower() else (ord("A"), 26) for c in text]
    x, n = 0, 1
    for c, (low, base) in zip(text, bases, strict=True):
        x, n = x * base + ord(c) - low, n * base
    x = f.permute(label, x, n, back)
    out = []
    for low, base in reversed(bases):
        x, d = divmod(x, base)
        out.append(chr(low + d))
    return "".join(reversed(out))


def ssn(f: Feistel, value: str, back: bool = False) -> str | None:
    area, group, serial = (int(x) for x in value.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    x = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    x, serial = divmod(f.permute("ssn", x, 898 * 99 * 9999, back), 9999)
    area, group = divmod(x, 99)
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def phone(f: Feistel, value: str, back: bool = False) -> str | None:
    d = re.sub(r"\D", "", value)
    code = ""
    if value.startswith("+") and d[0] != "1":
        code = next((d[:n] for n in (1, 2) if d[:n] in SHORT_CODES), d[:3])
        return _fill(value, code + f.digits("phone" + code, d[len(code) :], back)) if len(d) - len(code) >= 4 else None
    if len(d) == 11:
        code, d = d[0], d[1:]
    return _fill(value, code + f.digits("phone1", d, back)) if len(d) == 10 else None


def _reserved(x: int) -> bool:
    first, second = x >> 24, x >> 16 & 255
    return first in (0, 10, 127) or first >= 224 or (first, second) in ((169, 254), (192, 168)) or (first == 172 and 16 <= second < 32)


def ipv4(f: Feistel, value: str, back: bool = False) -> str | None:
    parts = value.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    x = sum(int(p) << 8 * (3 - k) for k, p in enumerate(parts))
    if _reserved(x):
        return None
    x = f.permute("ipv4", x, 1 << 32, back)
    while _reserved(x):  # walks on within public addresses
        x = f.permute("ipv4", x, 1 << 32, back)
    return ".".join(str(x >> 8 * k & 255) for k in (3, 2, 1, 0))


def date(f: Feistel, value: str, back: bool = False) -> str | None:
    """Permutes days; a date written year first stays so, others stay day first if the first number is over 12."""
    a, mark, b, _, c = re.split(r"([-/.])", value)
    form = "ymd" if len(a) == 4 else "dmy" if int(a) > 12 else "mdy"
    numbers = dict(zip(form, (int(a), int(b), int(c)), strict=True))
    try:
        day = datetime.date(numbers["y"], numbers["m"], numbers["d"]).toordinal()
    except ValueError:
        return None
    if not FIRST_DAY <= day <= LAST_DAY:
        return None
    wide = all(len(x) != 1 for x in (a, b, c))
    label = "date" + ("ymd" if form == "ymd" else "text")
    x = day - FIRST_DAY
    while True:
        x = f.permute(label, x, LAST_DAY - FIRST_DAY + 1, back)
        new = datetime.date.fromordinal(FIRST_DAY + x)
        # among dates that read the same way: day first ones have days over 12, and unpadded ones a number below 10
        if form == "dmy" and new.day <= 12 or not wide and new.day > 9 and new.month > 9:
            continue
        break
    show = (lambda n: f"{n:02d}") if wide else str
    out = {"y": f"{new.year:04d}", "m": show(new.month), "d": show(new.day)}
    return mark.join(out[k] for k in form)


def email(f: Feistel, value: str, back: bool = False) -> str | None:
    local, _, domain = value.partition("@")
    plain = re.sub(r"[^A-Za-z0-9]", "", local)
    label = "email" + domain.lower() + re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", local)))
    new = iter(_mixed(f, label, plain, back))
    return "".join(next(new) if c.isalnum() else c for c in local) + "@" + domain


KINDS: dict[str, Callable[..., str | None]] = {"email": email, "iban": iban, "ipv4": ipv4, "date": date, "phone": phone, "ssn": ssn, "card": card}


def _candidates(kind: str, text: str, m: re.Match, end: int) -> Iterator[tuple[int, int]]:
    """Spans within a match that may be the value, the likeliest first: a match takes in what stands beside a value."""
    start, stop = m.span()
    if kind == "card":
        at = start
        while (printed := PRINTED.search(text, at, min(end, stop + 24))) and printed.start() < stop:
            yield printed.span()
            at = printed.start() + 1
    elif kind == "iban" and (size := IBAN_SIZES.get(text[start : start + 2])):
        at = start
        while at < stop and size:
            size -= text[at] != " "
            at += 1
        if not size and not text[at : at + 1].isalnum():
            yield start, at
    yield start, stop
    if kind == "card" or kind == "iban" and text[start : start + 2] not in IBAN_SIZES:
        for at in range(stop - 1, start + 12, -1):
            if text[at] in " -" and sum(c not in " -" for c in text[start:at]) >= (13 if kind == "card" else 15):
                yield start, at


def _found(f: Feistel, text: str, start: int, end: int, back: bool) -> Iterator[tuple[str, int, int, str]]:
    """kind, start, stop and pseudonym of the values in a part of ``text``, in order."""
    while m := PATTERN.search(text, start, end):
        kinds, hit = list(KINDS), None
        for kind in kinds[kinds.index(m.lastgroup) :]:  # what one kind refuses may be a value of another
            own = m if kind == m.lastgroup else SINGLE[kind].match(text, m.start(), end)
            spans = _candidates(kind, text, own, end) if own else ()
            hit = next(((kind, a, b, new) for a, b in spans if (new := KINDS[kind](f, text[a:b], back)) is not None), None)
            if hit:
                break
        start = m.start() + 1
        if hit:
            if hit[1] > start:
                yield from _found(f, text, start, hit[1], back)
            yield hit
            start = hit[2]


def replaced(f: Feistel, text: str, back: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
    """``text`` with pseudonyms, and (kind, start, stop) of the values in the original."""
    if MAYBE.search(text) is None:
        return text, []
    out, items, last = [], [], 0
    for kind, start, stop, new in _found(f, text, 0, len(text), back):
        out += [text[last:start], new]
        last = stop
        items.append((kind, start, stop))
    return "".join([*out, text[last:]]), items


def found_items(docs: DataFrame, key: bytes) -> DataFrame:
    """doc_id, text (with pseudonyms), n_items, kinds (kind -> count), items (kind, start, stop) for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Feistel(key)
        for batch in batches:
            texts, numbers, kinds, spans = [], [], [], []
            for value in batch.column(1):
                text = value.as_py()
                new, items = (None, []) if text is None else replaced(f, text)
                texts.append(new)
                numbers.append(len(items))
                kinds.append(sorted(Counter(k for k, *_ in items).items()))
                spans.append([{"kind": k, "start": a, "stop": b} for k, a, b in items])
            span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
            columns = [pa.array(texts, pa.string()), pa.array(numbers, pa.int64()), pa.array(kinds, pa.map_(pa.string(), pa.int64())), pa.array(spans, span)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "text", "n_items", "kinds", "items"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, text string, n_items bigint, kinds map<string,bigint>, items array<struct<kind:string,start:int,stop:int>>"
    return docs.select("doc_id", "text").mapInArrow(run, ddl)


def pseudonymised(docs: DataFrame, key: bytes) -> DataFrame:
    """``docs`` with pseudonyms in ``text``; all other columns stay."""
    at, name = docs.columns.index("text"), "text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Feistel(key)
        for batch in batches:
            texts = [None if (t := x.as_py()) is None else replaced(f, t)[0] for x in batch.column(at)]
            yield batch.set_column(at, name, pa.array(texts, pa.string()))

    return docs.mapInArrow(run, docs.schema)


@query("op5_feistel_pseudonyms")
def op5_feistel_pseudonyms(spark, folder):
    """All documents with pseudonyms for personal numbers, dates and addresses. The key is a session setting; production sets its own."""
    key = spark.conf.get("gaugework.pseudonym.key", "not secret: set gaugework.pseudonym.key")
    found = found_items(table(spark, folder, "documents").select("doc_id", "text"), key.encode())
    return found.select("doc_id", "n_items", F.array_join(F.transform("items", lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), " ").alias("items"), "text")
