"""Personal data replaced by format-preserving pseudonyms.

Numbers, dates, addresses and secrets that pass validation are permuted within their format
by a keyed Feistel network: a card number becomes another valid card number, a date another
date, and an e-mail address another address with letters and digits in the same places. Equal
values give equal pseudonyms in all documents, however they are written, and whoever has the
key can turn them back.

A value is taken as a number below the size of its format. The network permutes the numbers
below the next power of four; results outside the format go through it again until they lie
inside. Values that fail validation are not personal data and stay as they are.

Digits or words behind a value can look like a part of it. What fails validation is therefore
tried again without its last groups, and the search goes on one place behind its begin. So that
pseudonyms can be turned back, one with which such a failed try would pass is permuted on.
"""

import datetime
import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from precinct.llm.common import importable, slices, worker_table

ROUNDS = 8


class Feistel:
    """Keyed permutations of the numbers below any size, one for each kind of value."""

    def __init__(self, key: bytes) -> None:
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def mask(self, tweak: bytes, turn: int, half: int, bits: int) -> int:
        size = max(1, -(-bits // 8))
        data = tweak + bytes([turn]) + half.to_bytes(size, "big")
        out, block = b"", 0
        while len(out) < size:
            salt = block.to_bytes(4, "big")
            out += hashlib.blake2b(data, key=self.key, salt=salt).digest()
            block += 1
        return int.from_bytes(out[:size], "big") & ((1 << bits) - 1)

    def permute(self, value: int, size: int, kind: str, back: bool = False) -> int:
        """Another number below ``size``; with ``back``, the number that became ``value``."""
        bits = max(1, -(-max(size - 1, 1).bit_length() // 2))
        low = (1 << bits) - 1
        tweak = f"{kind}:{size}:".encode()
        turns = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
        while True:
            left, right = value >> bits, value & low
            for turn in turns:
                if back:
                    left, right = right ^ self.mask(tweak, turn, left, bits), left
                else:
                    left, right = right, left ^ self.mask(tweak, turn, right, bits)
            value = (left << bits) | right
            if value < size:
                return value


def in_places(text: str, values: str, places: Callable[[str], bool]) -> str:
    """``text`` with the characters for which ``places`` holds replaced, in order."""
    fresh = iter(values)
    return "".join(next(fresh) if places(c) else c for c in text)


def luhn(digits: str) -> int:
    """The check digit that belongs behind ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 - i % 2)
        total += d - 9 if d > 9 else d
    return -total % 10


def digits_of(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def is_digit(c: str) -> bool:
    return c in "0123456789"


class Kind:
    """A sort of value: how it looks, whether it is valid, and its number in its format."""

    name: str
    pattern: str
    # What stands between groups, if there may be fewer groups than the pattern finds.
    between: re.Pattern | None = None

    def tries(self, found: re.Match) -> Iterator[re.Match]:
        """What was found, then what is left of it without its last groups, longest first."""
        yield found
        if self.between is None:
            return
        begin = found.start()
        for cut in reversed([m.start() for m in self.between.finditer(found[0])]):
            shorter = found.re.fullmatch(found.string, begin, begin + cut)
            if shorter:
                yield shorter

    def swap(self, found: re.Match, cipher: Feistel, back: bool) -> str | None:
        """The pseudonym, or None if the value is not valid."""
        raise NotImplementedError


class Card(Kind):
    """Payment cards: 13 to 19 digits with a right check digit, which stays right."""

    name = "card"
    pattern = r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w-])"
    between = re.compile("[ -]")

    def swap(self, found, cipher, back):
        digits = digits_of(found[0])
        body = digits[:-1]
        if luhn(body) != int(digits[-1]) or len(set(digits)) == 1:
            return None
        number = cipher.permute(int(body), 10 ** len(body), self.name, back)
        body = str(number).zfill(len(body))
        return in_places(found[0], body + str(luhn(body)), is_digit)


class Phone(Kind):
    """Ten digits in North American writing, with or without a country code, which stays.

    Areas begin with 2 to 9, before and after. So do exchanges, but those that do not, as
    in made-up numbers, are hidden too and stay among themselves.
    """

    name = "phone"
    pattern = r"(?<![\w.])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w)"

    @staticmethod
    def fresh(digits: str, cipher: Feistel, back: bool) -> str | None:
        area, exchange, line = int(digits[:3]), int(digits[3:6]), int(digits[6:])
        if area < 200:
            return None
        first, many = (200, 800) if exchange >= 200 else (0, 200)
        number = ((area - 200) * many + exchange - first) * 10_000 + line
        number = cipher.permute(number, 800 * many * 10_000, Phone.name, back)
        rest, line = divmod(number, 10_000)
        area, exchange = divmod(rest, many)
        return f"{area + 200}{exchange + first:03d}{line:04d}"

    def swap(self, found, cipher, back):
        digits = digits_of(found[0])
        body = self.fresh(digits[-10:], cipher, back)
        return body and in_places(found[0], digits[:-10] + body, is_digit)


# Country codes of one and two digits in the public numbering plan; all others
# have three, and no code begins another.
SHORT_CODES = r"[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"


class WorldPhone(Kind):
    """A plus sign, a country code and 7 to 12 more digits, in groups or not; the code stays.

    Behind the code 1 there must be a number in the North American plan, and it gets the same
    pseudonym as in its other writings.
    """

    name = "world_phone"
    pattern = (
        rf"(?<![\w.+])\+(?!1\D)({SHORT_CODES}|(?!{SHORT_CODES})\d{{3}})"
        r"((?:[ .-]?\(?\d+\)?){2,5})(?!\w)"
    )
    between = re.compile(r"[ .-]|(?<![ .-])\(")

    def swap(self, found, cipher, back):
        body = digits_of(found[2])
        if found[1] == "1":
            fresh = Phone.fresh(body, cipher, back) if len(body) == 10 else None
        elif 7 <= len(body) <= 12:
            kind = f"{self.name}:{found[1]}"
            fresh = str(cipher.permute(int(body), 10 ** len(body), kind, back)).zfill(len(body))
        else:
            fresh = None
        return fresh and f"+{found[1]}" + in_places(found[2], fresh, is_digit)


class SocialNumber(Kind):
    """Numbers like 123-45-6789 of areas, groups and serials that are given out."""

    name = "social"
    pattern = r"(?<![\w.-])(\d{3})-(\d{2})-(\d{4})(?![\w-])"

    def swap(self, found, cipher, back):
        area, group, serial = map(int, found.groups())
        if not 0 < area < 900 or area == 666 or not group or not serial:
            return None
        # Areas are 1 to 899 without 666, groups 1 to 99 and serials 1 to 9999.
        place = area - 1 - (area > 666)
        number = (place * 99 + group - 1) * 9999 + serial - 1
        number = cipher.permute(number, 898 * 99 * 9999, self.name, back)
        rest, serial = divmod(number, 9999)
        place, group = divmod(rest, 99)
        return f"{place + 1 + (place >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


class Address(Kind):
    """IPv4 addresses: four numbers up to 255."""

    name = "ipv4"
    pattern = r"(?<![\w.])(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})(?!\.?\d|[A-Za-z_])"

    def swap(self, found, cipher, back):
        parts = [int(x) for x in found.groups()]
        if max(parts) > 255:
            return None
        number = cipher.permute(int.from_bytes(bytes(parts), "big"), 1 << 32, self.name, back)
        return ".".join(str(b) for b in number.to_bytes(4, "big"))


class AccountNumber(Kind):
    """IBANs with right check digits; the country stays, the check digits stay right."""

    name = "iban"
    pattern = r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"
    between = re.compile(" ")

    @staticmethod
    def check(country: str, body: str) -> int:
        return 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97

    def swap(self, found, cipher, back):
        plain = found[0].replace(" ", "")
        country, body = plain[:2], plain[4:]
        if self.check(country, body) != int(plain[2:4]) or not 11 <= len(body) <= 30:
            return None
        body = mixed(body, cipher, f"{self.name}:{country}", back)
        check = self.check(country, body)
        return in_places(found[0], f"{country}{check:02d}{body}", lambda c: c != " ")


class Mail(Kind):
    """E-mail addresses: letters and digits are permuted, all but the top-level domain."""

    name = "email"
    pattern = (
        r"(?<![\w.%+-])[A-Za-z0-9](?:[\w%+-]|\.(?=\w)){0,63}"
        r"@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,62})\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])"
    )

    def swap(self, found, cipher, back):
        head, dot, top = found[0].rpartition(".")
        return mixed(head, cipher, f"{self.name}:{top.lower()}", back) + dot + top


class Token(Kind):
    """Access keys that are known by how they begin, which stays."""

    name = "token"
    # Beginnings of public kinds of access keys.
    begins = r"(?:(?:AKIA|ASIA)(?=[A-Z0-9]{16}(?![A-Za-z0-9]))|gh[pousr]_(?=[A-Za-z0-9]{36}))"
    pattern = rf"(?<![A-Za-z0-9_])({begins})([A-Za-z0-9]{{16,255}})(?![A-Za-z0-9])"

    def swap(self, found, cipher, back):
        return found[1] + mixed(found[2], cipher, f"{self.name}:{found[1]}", back)


class Secret(Kind):
    """Long values that are given to a name like token, secret, key or password.

    They are hexadecimal, or have letters as well as digits.
    """

    name = "secret"
    pattern = (
        r"(?i:(?:token|secret|api_?key|access_?key|password|passwd))['\"]?\s{0,3}[:=]\s{0,3}['\"]?"
        r"([0-9A-Za-z+/_-]{16,128})(?![0-9A-Za-z+/_-])"
    )
    known = re.compile(Token.pattern, re.ASCII)

    @staticmethod
    def is_hexadecimal(value: str) -> bool:
        return all(c in "0123456789abcdefABCDEF" for c in value)

    def swap(self, found, cipher, back):
        value = found[1]
        token = self.known.fullmatch(value)
        if token:
            fresh = Token().swap(token, cipher, back)
        elif self.is_hexadecimal(value):
            number = cipher.permute(int(value, 16), 16 ** len(value), self.name, back)
            fresh = f"{number:0{len(value)}x}"
            if not any(c in "abcdef" for c in value):
                fresh = fresh.upper()
        elif any(map(is_digit, value)) and any(c.isalpha() for c in value):
            # Others stay no hexadecimal numbers and no tokens, so that they come back as what they were.
            fresh = mixed(value, cipher, self.name, back)
            while self.is_hexadecimal(fresh) or self.known.fullmatch(fresh):
                fresh = mixed(fresh, cipher, self.name, back)
        else:
            return None
        return found[0][: found.start(1) - found.start()] + fresh


class Date(Kind):
    """Calendar dates from 1900 to 2099, as 2020-01-31, 31.01.2020 or 01/31/2020."""

    name = "date"
    pattern = (
        r"(?<![\w./-])(?:(?P<y>(?:19|20)\d\d)([-/.])(?P<m>\d\d)\2(?P<d>\d\d)"
        r"|(?P<a>\d\d)([-/.])(?P<b>\d\d)\6(?P<z>(?:19|20)\d\d))(?![\w/-]|\.\d)"
    )
    first = datetime.date(1900, 1, 1).toordinal()
    days = datetime.date(2099, 12, 31).toordinal() - first + 1

    def swap(self, found, cipher, back):
        part = {k: int(v) for k, v in found.groupdict().items() if v}
        mark = found[2] or found[6]
        try:
            if "y" in part:
                day, form = datetime.date(part["y"], part["m"], part["d"]), "%Y{0}%m{0}%d"
            elif mark == "/" and part["a"] <= 12:
                day, form = datetime.date(part["z"], part["a"], part["b"]), "%m{0}%d{0}%Y"
            else:
                day, form = datetime.date(part["z"], part["b"], part["a"]), "%d{0}%m{0}%Y"
        except ValueError:
            return None
        number = day.toordinal() - self.first
        while True:
            number = cipher.permute(number, self.days, self.name, back)
            fresh = datetime.date.fromordinal(self.first + number)
            # A day of up to 12 in front of a slash would be read as a month. So days up to 12
            # stay so, and days above, in all forms: a date has one pseudonym.
            if (fresh.day <= 12) == (day.day <= 12):
                return fresh.strftime(form.format(mark))


def mixed(text: str, cipher: Feistel, kind: str, back: bool) -> str:
    """Letters become letters and digits digits; case and other characters stay in place."""
    value, size, bases = 0, 1, []
    for c in text.lower():
        base = 10 if is_digit(c) else 26 if "a" <= c <= "z" else 0
        if base:
            value = value * base + int(c, 36) - (10 if base == 26 else 0)
            size *= base
            bases.append(base)
    shape = "".join("d" if is_digit(c) else "a" if "a" <= c <= "z" else c for c in text.lower())
    value = cipher.permute(value, size, f"{kind}:{shape}", back) if size > 1 else 0
    fresh = []
    for base in reversed(bases):
        value, place = divmod(value, base)
        fresh.append(str(place) if base == 10 else chr(ord("a") + place))
    fresh = iter(reversed(fresh))
    out = []
    for old, c in zip(text, text.lower()):
        if is_digit(c) or "a" <= c <= "z":
            new = next(fresh)
            out.append(new.upper() if old.isupper() else new)
        else:
            out.append(old)
    return "".join(out)


# Where values of two kinds begin in the same place, the first kind that is valid counts.
KINDS = (
    Mail(),
    Secret(),
    Token(),
    Address(),
    AccountNumber(),
    SocialNumber(),
    Date(),
    Phone(),
    WorldPhone(),
    Card(),
)
# Every value has a digit, an at sign or a known beginning; other text is not searched.
HINT = re.compile("[0-9@]|AKIA|ASIA|gh[pousr]_")


@lru_cache(1)
def patterns() -> list[tuple[Kind, re.Pattern]]:
    return [(kind, re.compile(kind.pattern, re.ASCII)) for kind in KINDS]


def replace(text: str, cipher: Feistel, back: bool = False) -> tuple[str, dict[str, int]]:
    """The text with pseudonyms, and the number of values of each kind."""
    if not HINT.search(text):
        return text, {}
    values, failed = first_valid(text, cipher, back)
    if failed:
        values = still_found(text, values, failed, cipher, back)
    out, at, counts = [], 0, {}
    for begin, order, end, fresh in values:
        out += [text[at:begin], fresh]
        at = end
        name = KINDS[order].name
        counts[name] = counts.get(name, 0) + 1
    return "".join([*out, text[at:]]), counts


def first_valid(
    text: str, cipher: Feistel, back: bool
) -> tuple[list[tuple[int, int, int, str]], list[tuple[int, int, int]]]:
    """Values from left to right, and the tries that had to fail for them to be found."""

    def search(order: int, at: int) -> tuple[tuple | None, list[tuple[int, int, int]]]:
        (kind, pattern), tried = patterns()[order], []
        match = pattern.search(text, at)
        while match:
            for part in kind.tries(match):
                fresh = kind.swap(part, cipher, back)
                if fresh is not None:
                    return (part.start(), order, part.end(), fresh), tried
                tried.append((part.start(), part.end(), order))
            match = pattern.search(text, match.start() + 1)
        return None, tried

    ahead = {}
    for order, kind in enumerate(KINDS):
        if kind.name != "email" or "@" in text:
            ahead[order] = search(order, 0)
    values, failed, at = [], [], 0
    while any(value for value, _ in ahead.values()):
        first = min(value for value, _ in ahead.values() if value)
        begin, order, end, _ = first
        values.append(first)
        for number, (value, tried) in list(ahead.items()):
            # Failures further on did not decide this; behind its end they may decide the next.
            failed += [t for t in tried if at <= t[0] and (t[0], number) <= (begin, order)]
            if value and value[0] < end:
                ahead[number] = search(number, end)
        at = end
    return values, failed


def still_found(
    text: str,
    values: list[tuple[int, int, int, str]],
    failed: list[tuple[int, int, int]],
    cipher: Feistel,
    back: bool,
) -> list[tuple[int, int, int, str]]:
    """The values, permuted on until no try passes that failed in ``text``.

    Values are taken from the left, and from the right on the way back, so that each meets the
    same neighbours both times.
    """
    now, failed = list(text), sorted(failed)
    longest = max(end - begin for begin, end, _ in failed)
    fixed = []
    for begin, order, end, fresh in reversed(values) if back else values:
        near = failed[bisect_left(failed, (begin - longest,)) : bisect_left(failed, (end,))]
        near = [f for f in near if f[1] > begin]
        # Only addresses can change their length; they stay what they are for others.
        while len(fresh) == end - begin:
            now[begin:end] = fresh
            if not any(passes("".join(now[b:e]), kind, cipher) for b, e, kind in near):
                break
            kind, pattern = patterns()[order]
            fresh = kind.swap(pattern.fullmatch(fresh), cipher, back)
        fixed.append((begin, order, end, fresh))
    return fixed[::-1] if back else fixed


def passes(value: str, order: int, cipher: Feistel) -> bool:
    """Whether this is a valid value of a kind."""
    kind, pattern = patterns()[order]
    match = pattern.fullmatch(value)
    return match is not None and kind.swap(match, cipher, False) is not None


def pseudonymise(
    docs: DataFrame, key: bytes, text: str = "text", back: bool = False
) -> DataFrame:
    """All rows with pseudonyms in ``text``, and ``n_replaced`` and ``replaced``, by kind.

    Null texts stay null and empty ones empty, with no values; texts without values stay as
    they are. Columns of the input named ``n_replaced`` or ``replaced`` are replaced. Each row
    is treated by itself, so repeated rows stay equal; an empty table gives an empty result.
    """
    kept = docs.drop("n_replaced", "replaced")
    place = kept.columns.index(text)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema]
    names = [*kept.columns, "n_replaced", "replaced"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_table(None, None)
        cipher = Feistel(key)
        for batch in slices(batches):
            fresh, totals, kinds = [], [], []
            for body in batch.column(place).to_pylist():
                new, counts = (None, {}) if body is None else replace(body, cipher, back)
                fresh.append(new)
                totals.append(sum(counts.values()))
                kinds.append(sorted(counts.items()))
            columns = list(batch.columns)
            columns[place] = pa.array(fresh, pa.string())
            columns += [
                pa.array(totals, pa.int64()),
                pa.array(kinds, pa.map_(pa.string(), pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = ", ".join([*fields, "n_replaced bigint, replaced map<string,bigint>"])
    return importable(kept).mapInArrow(run, schema)
