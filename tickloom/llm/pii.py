"""Format-preserving pseudonyms for personal data.

Method: a keyed Feistel permutation within each format. A value is validated, read
as the number it stands for (the day of a date, country and national number of a
phone), permuted and written in the format at hand. Equal values get equal
pseudonyms in all documents, whatever their separators, case, padding or month
names; different values of a kind never share one. Only dates written without
leading zeros or with month names may change their length.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import each

ROUNDS = 10
#: A key for tests. Whoever knows the key can undo the pseudonyms: give your own, 16 bytes or more.
TEST_KEY = b"tickloom-test-key"
#: The days that dates are permuted among.
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


class Permutation:
    """Keyed permutations of 0..n-1 for any n: a balanced Feistel network over bits, walked until it lands inside."""

    def __init__(self, key: bytes, rounds: int = ROUNDS):
        self.key, self.rounds = hashlib.blake2b(key, digest_size=32).digest(), rounds

    def _round(self, tag: str, n: int, number: int, half: int, bits: int) -> int:
        text = f"{tag}|{n}|{number}|{half}".encode()
        return int.from_bytes(hashlib.blake2b(text, key=self.key, digest_size=64).digest()) & ((1 << bits) - 1)

    def __call__(self, tag: str, value: int, n: int, valid: Callable[[int], bool] | None = None, inverse: bool = False) -> int:
        """The image of ``value``; ``valid`` names the subset that is permuted within itself."""
        if n < 2:
            return value
        bits = max(1, (max(2, (n - 1).bit_length()) + 1) // 2)
        if bits > 512:
            raise ValueError("a value is too long to permute")
        mask = (1 << bits) - 1
        while True:
            left, right = value >> bits, value & mask
            if inverse:
                for number in reversed(range(self.rounds)):
                    left, right = right ^ self._round(tag, n, number, left, bits), left
            else:
                for number in range(self.rounds):
                    left, right = right, left ^ self._round(tag, n, number, right, bits)
            value = left << bits | right
            if value < n and (valid is None or valid(value)):
                return value


def _letters_and_digits(permute: Permutation, tag: str, text: str) -> str:
    """Letters a-z to letters, digits to digits, others as they are; case stays where it is."""
    value, n = 0, 1
    places = [(i, 10 if c.isdigit() else 26) for i, c in enumerate(text) if c.isascii() and c.isalnum()]
    for i, base in places:
        value = value * base + (int(text[i]) if base == 10 else ord(text[i].lower()) - 97)
        n *= base
    if n.bit_length() > 900:  # far beyond any such value: in parts
        half = len(text) // 2
        return _letters_and_digits(permute, tag + "<", text[:half]) + _letters_and_digits(permute, tag + ">", text[half:])
    shape = "".join("9" if c.isascii() and c.isdigit() else "a" if c.isascii() and c.isalpha() else c for c in text)
    value = permute(f"{tag}|{shape}", value, n)
    out = list(text)
    for i, base in reversed(places):
        value, digit = divmod(value, base)
        out[i] = str(digit) if base == 10 else chr(digit + (65 if text[i].isupper() else 97))
    return "".join(out)


def luhn_digit(digits: str) -> int:
    """The check digit of the digits before it."""
    total = sum(sum(divmod(int(d) * 2, 10)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits)))
    return -total % 10


def iban_check(country: str, body: str) -> str:
    """The two check digits of an account number."""
    return f"{98 - int(''.join(str(int(c, 36)) for c in body + country + '00')) % 97:02d}"


def _respell(text: str, characters: str) -> str:
    """Put ``characters`` in place of the letters and digits of ``text``."""
    rest = iter(characters)
    return "".join(next(rest) if c.isalnum() else c for c in text)


def _email(permute: Permutation, m: re.Match) -> str | None:
    name, _, domain = m[0].rpartition("@")
    host, dot, top = domain.rpartition(".")
    return f"{_letters_and_digits(permute, 'email', name)}@{_letters_and_digits(permute, 'host', host)}{dot}{top}"


def _ip(permute: Permutation, m: re.Match) -> str | None:
    parts = m[0].split(".")
    if any(int(p) > 255 or len(p) > 1 and p[0] == "0" for p in parts):
        return None
    # An octet keeps its number of digits, so that the address keeps its length.
    ranges = [{1: (0, 10), 2: (10, 90), 3: (100, 156)}[len(p)] for p in parts]
    value, n = 0, 1
    for part, (least, size) in zip(parts, ranges):
        value, n = value * size + int(part) - least, n * size
    value, out = permute("ip" + "".join(str(len(p)) for p in parts), value, n), []
    for least, size in reversed(ranges):
        value, rest = divmod(value, size)
        out.append(str(least + rest))
    return ".".join(reversed(out))


def _card(permute: Permutation, m: re.Match) -> str | None:
    digits = re.sub(r"\D", "", m[0])
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != int(digits[-1]) or len(set(digits)) == 1:
        return None
    n = len(digits) - 1
    body = f"{permute(f'card{n}', int(digits[:-1]), 10 ** n, lambda v: len(set(f'{v:0{n}d}')) > 1):0{n}d}"
    return _respell(m[0], body + str(luhn_digit(body)))


def _iban(permute: Permutation, m: re.Match) -> str | None:
    plain = re.sub(r"\W", "", m[0]).upper()
    country, body = plain[:2], plain[4:]
    if not 15 <= len(plain) <= 34 or iban_check(country, body) != plain[2:4]:
        return None
    body = _letters_and_digits(permute, "iban" + country, body)
    return _respell(m[0], country + iban_check(country, body) + body)


def _ssn(permute: Permutation, m: re.Match) -> str | None:
    def valid(v: int) -> bool:
        area, group, serial = v // 1_000_000, v // 10_000 % 100, v % 10_000
        return area not in (0, 666) and area < 900 and group > 0 and serial > 0

    value = int(re.sub(r"\D", "", m[0]))
    return _respell(m[0], f"{permute('ssn', value, 10 ** 9, valid):09d}") if valid(value) else None


#: Country calling codes: one digit if it is 1 or 7, these of two digits, all others of three. Fixed values.
CODES_OF_TWO = set(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())


def _phone(permute: Permutation, m: re.Match) -> str | None:
    text = m[0]
    trunk = text.find("(0)") if text[0] == "+" else -1  # a zero that is dialled at home only
    digits = re.sub(r"\D", "", text if trunk < 0 else text[:trunk] + text[trunk + 3:])
    if text[0] == "+":
        known = 1 if digits[0] in "17" else 2 if digits[:2] in CODES_OF_TWO else 3
        country, number = digits[:known], digits[known:]
        head = country
    else:
        country, head, number = "1", digits[:-10], digits[-10:]
    if not 7 <= len(country + number) <= 15 or len(number) < 6:
        return None
    new = head + f"{permute(f'phone{country}|{len(number)}', int(number), 10 ** len(number)):0{len(number)}d}"
    if trunk >= 0:
        at = sum(c.isdigit() for c in text[:trunk])
        new = new[:at] + "0" + new[at:]
    return _respell(text, new)


#: Names of the months. Fixed values.
MONTHS = {language: names.split() for language, names in {
    "en": "January February March April May June July August September October November December",
    "short": "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec",
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "de": "Januar Februar März April Mai Juni Juli August September Oktober November Dezember",
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
}.items()}
MONTH = "|".join(sorted({re.escape(n) for names in MONTHS.values() for n in names}, key=len, reverse=True))


def _other_day(permute: Permutation, year: int, month: int, day: int) -> datetime.date | None:
    """The pseudonym of a day. Days up to the twelfth are permuted among themselves, so that day and month are told apart as before."""
    try:
        value = datetime.date(year, month, day).toordinal()
    except ValueError:
        return None
    if not FIRST_DAY <= value <= LAST_DAY:
        return None
    return datetime.date.fromordinal(FIRST_DAY + permute(
        "date", value - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, lambda v: (datetime.date.fromordinal(FIRST_DAY + v).day > 12) == (day > 12)))


def _written_date(permute: Permutation, m: re.Match) -> str | None:
    between, name = m[0], m["month"]
    first = ["es"] if " de " in between.lower() else ["de"] if re.match(r"\d+\. ", between) else []
    language, month = next((k, [n.lower() for n in MONTHS[k]].index(name.lower())) for k in [*first, *MONTHS] if name.lower() in map(str.lower, MONTHS[k]))
    date = _other_day(permute, int(m["y"]), month + 1, int(m["d"]))
    if date is None:
        return None
    new = MONTHS[language][date.month - 1]
    new = new.upper() if name.isupper() else new.lower() if name.islower() else new.capitalize()
    ending = "" if not m["th"] else "th" if 10 < date.day < 20 else {1: "st", 2: "nd", 3: "rd"}.get(date.day % 10, "th")
    spans = {"d": f"{date.day:02d}" if m["d"][0] == "0" else str(date.day), "th": ending, "month": new, "y": f"{date.year:04d}"}
    out, at = "", m.start()
    for group in sorted((g for g in spans if m[g] is not None), key=m.start):
        out, at = out + m.string[at: m.start(group)] + spans[group], m.end(group)
    return out + m.string[at: m.end()]


def _date(permute: Permutation, m: re.Match) -> str | None:
    if "month" in m.re.groupindex:
        return _written_date(permute, m)
    a, mark, b, c = m["a"], m["mark"], m["b"], m["c"]
    if len(a) == 4:
        order = "ymd"
    elif len(c) != 4:
        return None
    elif mark == "." or int(a) > 12:
        order = "dmy"
    else:
        order = "mdy"
    fields = dict(zip(order, (a, b, c)))
    date = _other_day(permute, int(fields["y"]), int(fields["m"]), int(fields["d"]))
    if date is None:
        return None
    parts = [fields["m"], fields["d"]]
    width = 2 if any(p[0] == "0" for p in parts) or all(len(p) == 2 for p in parts) else 1
    new = {"y": f"{date.year:04d}", "m": f"{date.month:0{width}d}", "d": f"{date.day:0{width}d}"}
    return mark.join(new[k] for k in order)


#: In this order; a span that one kind has taken is not looked at again.
KINDS: dict[str, tuple[re.Pattern, Callable[[Permutation, re.Match], str | None]]] = {
    "email": (re.compile(r"(?<![\w.%+-])[\w.%+-]+@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}(?![A-Za-z0-9])"), _email),
    "iban": (re.compile(r"(?<![A-Za-z0-9])[A-Za-z]{2}\d{2}(?:[ -]?[A-Za-z0-9]{4}){2,7}(?:[ -]?[A-Za-z0-9]{1,4})?(?![A-Za-z0-9])"), _iban),
    "ip": (re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)"), _ip),
    "date": (re.compile(r"(?<![\w./-])(?P<a>\d{4}|\d{1,2})(?P<mark>[-./])(?P<b>\d{1,2})(?P=mark)(?P<c>\d{4}|\d{1,2})(?![\w/-]|\.\d)"), _date),
    "ssn": (re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"), _ssn),
    "card": (re.compile(r"(?:(?<![\w.+-])|(?<=\d-))\d(?:[ -]?\d){12,18}(?!\w|-(?!\d)|\.\d)"), _card),
    "phone": (re.compile(
        r"(?<!\w)\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}(?!\w|\.\d)|"
        r"(?<![\w+.-])(?:1[ .-])?(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?![\w-]|\.\d)"), _phone),
}
#: Tried before the kind's own pattern: the usual ways to write it, so that numbers beside it do not take part of it.
FIRST = {
    "card": [re.compile(
        r"(?:(?<![\w.+-])|(?<=\d-))(?:\d{13,19}|\d{4}(?P<s>[ -])\d{4}(?P=s)\d{4}(?P=s)\d{1,4}(?:(?P=s)\d{1,3})?|\d{4}(?P<t>[ -])\d{6}(?P=t)\d{4,5})"
        r"(?!\w|-(?!\d)|\.\d)")],
    "date": [
        re.compile(rf"(?<![\w./-])(?P<d>\d{{1,2}})(?P<th>st|nd|rd|th)?(?:\.? | de |-)(?P<month>{MONTH})\.?(?:,? | del? |-)(?P<y>\d{{4}})(?!\w)", re.I),
        re.compile(rf"(?<!\w)(?P<month>{MONTH})\.? (?P<d>\d{{1,2}})(?P<th>st|nd|rd|th)?,? (?P<y>\d{{4}})(?!\w)", re.I)],
}
#: Characters of an account number by country, from the public registry.
IBAN_LENGTHS = {c: int(n) for n, names in (x.split(":") for x in (
    "15:NO 16:BE 18:DK,FI,FK,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,HR,LI,LV "
    "22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA 23:AE,GI,IL,IQ,OM,SO,TL 24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG "
    "25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM 28:AL,AZ,BY,CY,DO,GT,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA 30:JO,KW,MU,YE 31:MT,SC 32:LC 33:RU"
).split()) for c in names.split(",")}
_POSSIBLE = re.compile(r"\d.*\d|@", re.S)


def _luhn_ends(text: str, start: int, end: int) -> list[int]:
    """Where a number from ``start`` on may end, at ``end`` or a separator, with a right check digit; the last place first. Both sums run along."""
    ends, n, even, odd = [], 0, 0, 0  # the sum of even places as they are and odd ones doubled, and the other way
    for at in range(start, end + 1):
        c = text[at] if at < end else " "
        if c in " -":
            if 13 <= n <= 19 and (even if n % 2 else odd) % 10 == 0:
                ends.append(at)
            continue
        plain = int(c)
        double = plain * 2 - 9 * (plain > 4)
        even, odd, n = (even + double, odd + plain, n + 1) if n % 2 else (even + plain, odd + double, n + 1)
    return ends[::-1]


def _candidates(kind: str, pattern: re.Pattern, m: re.Match) -> Iterator[re.Match]:
    """A match and what it becomes when words or numbers at its end are left out, the longest first; an account number of its country's length before."""
    text, start = m.string, m.start()
    if kind == "card":
        yield from (c for c in (pattern.fullmatch(text, start, at) for at in _luhn_ends(text, start, m.end())) if c)
        return
    cuts = [at for at in range(m.end() - 1, start, -1) if text[at] in " -"] if kind in ("iban", "phone") else []
    shorter = [c for c in (pattern.fullmatch(text, start, at) for at in cuts) if c]
    if kind == "iban":
        length = IBAN_LENGTHS.get(m[0][:2].upper())
        yield from (c for c in shorter if len(re.sub("[ -]", "", c[0])) == length)
    yield m
    yield from shorter


def _replaced(kind: str, pattern: re.Pattern, replace: Callable, permute: Permutation, piece: str) -> tuple[list[tuple[str, bool]], int]:
    """The parts of a piece of text and how many values were replaced. Behind a match that fails, the search goes on at its second character."""
    out: list[tuple[str, bool]] = []
    last = at = count = 0
    while m := pattern.search(piece, at):
        at = m.start() + 1
        for c in _candidates(kind, pattern, m):
            new = replace(permute, c)
            if new is not None:
                out += [(piece[last: c.start()], False), (new, True)]
                last = at = c.end()
                count += 1
                break
    return [*out, (piece[last:], False)], count


def pseudonymise(text: str, permute: Permutation) -> tuple[str, dict[str, int]]:
    """The text with its personal data replaced, and how many of each kind were."""
    counts = dict.fromkeys(KINDS, 0)
    if not _POSSIBLE.search(text):
        return text, counts
    # Pieces of text alternate with finished replacements.
    pieces: list[tuple[str, bool]] = [(text, False)]
    for kind, (own, replace) in KINDS.items():
        for pattern in (*FIRST.get(kind, ()), own):
            after: list[tuple[str, bool]] = []
            for piece, done in pieces:
                if done or kind == "email" and "@" not in piece:
                    after.append((piece, done))
                    continue
                parts, count = _replaced(kind, pattern, replace, permute, piece)
                after += parts
                counts[kind] += count
            pieces = after
    return "".join(p for p, _ in pieces), counts


COUNTS = "struct<text:string," + ",".join(f"n_{k}:int" for k in KINDS) + ">"


def pseudonyms(text: Column, key: bytes) -> Column:
    """A struct of the new text and the number of values replaced per kind; null for null."""
    def run(texts: pa.Array) -> pa.Array:
        permute = Permutation(key)
        rows = [None if t is None else pseudonymise(t, permute) for t in each(texts)]
        fields = [("text", pa.string())] + [(f"n_{k}", pa.int32()) for k in KINDS]
        return pa.array([None if r is None else {"text": r[0], **{f"n_{k}": n for k, n in r[1].items()}} for r in rows], pa.struct(fields))

    return F.arrow_udf(run, COUNTS)(text)


def pseudonymised(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``docs`` with pseudonyms in place of personal data; all other columns stay as they are.

    Lengths change by dates without leading zeros or with month names only. A null text stays null, an empty one empty; repeated rows
    get equal texts. Numbers that fail their check (Luhn, mod 97, ranges) are no
    personal data and stay, except for values inside that pass it: what stands
    between separators is tried by itself.
    """
    return docs.withColumn(text, pseudonyms(F.col(text), key)["text"])
