"""Personal data: format-preserving pseudonyms by a keyed Feistel network.

Numbers and dates that pass their own check (Luhn digit, mod-97 digits, calendar, octet range, ...) are permuted within
their format under a key: a card becomes another valid card of the same length and first digit, a date another date in
the same notation, an e-mail address another of the same shape. The permutation depends on the kind and on the value
without its separators, so equal values stay equal, in one document and across documents, whichever way they are
written; different values stay different. With the key, `restore` undoes it.

A format is a row of places, each with a radix; the first half of the places is one side of the network, the second
half the other. Each round adds a keyed hash of one side to the other, modulo that side's size, so every round can be
taken back and the result stays in the format. Values outside a format's check are walked over: permuted again until
they pass.

Values are found first, replaced afterwards one after the other. A replacement must not make a span pass that failed its
check, of whatever kind, so the new text has its values at the same places; `restore` goes through them backwards.

Defined results: a null text stays null; a text without findings stays as it is, character for character; findings do
not overlap (kinds in the order of `KINDS`, then from left to right); the length of a text never changes; rows are
independent, so repeated rows give repeated results, an empty table an empty one, and other columns are carried along.
Digits that fail their check are left alone. Every kind with a check is looked for at every start and every length, the
longest valid one first, so what follows a value (expiry, year, code, a word) does not hide it. One value has several
pseudonyms in two cases: where its neighbours would, with the pseudonym, look like a value themselves; and dates with
days or months of one digit, whose pseudonyms have one digit there too.

Where a country has numbers of several lengths, digits that follow a shorter one and fit are read as part of it.

Not covered: national phone numbers outside North America, phone numbers that start with 00, IPv6, names, postal
addresses, written-out months, IBANs in mixed case, passwords without one of the words of `SECRET` in front.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from harborline.llm.common import arrow_map

ROUNDS = 10

# For tests and the registered queries; a real run names its own secret in this setting or passes it.
TEST_KEY = b"harborline test key"
KEY_SETTING = "spark.harborline.pii.key"

DIGITS, LOWER, UPPER, HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


def _hash(key: bytes, tweak: str, turn: int, value: int, size: int) -> int:
    said = f"{tweak}|{turn}|{value}".encode()
    width = (size.bit_length() + 7) // 8 + 16
    found = b"".join(
        hashlib.blake2b(said + bytes([n]), key=key[:64], digest_size=64).digest() for n in range(-(-width // 64))
    )
    return int.from_bytes(found, "big") % size


def permute(key: bytes, tweak: str, places: list[int], radices: list[int], back: bool = False) -> list[int]:
    """One keyed permutation of the values that the radices allow; `back` takes it back."""
    half = (len(places) + 1) // 2
    sizes, sides = [1, 1], [0, 0]
    for at, (place, radix) in enumerate(zip(places, radices)):
        side = at >= half
        sides[side], sizes[side] = sides[side] * radix + place, sizes[side] * radix
    for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
        side = turn % 2
        move = _hash(key, tweak, turn, sides[1 - side], sizes[side])
        sides[side] = (sides[side] + (-move if back else move)) % sizes[side]
    out = []
    for side, some in ((1, radices[half:]), (0, radices[:half])):
        for radix in reversed(some):
            sides[side], place = divmod(sides[side], radix)
            out.append(place)
    return out[::-1]


def walk(key: bytes, tweak: str, places: list[int], radices: list[int], valid: Callable, back: bool = False) -> list[int]:
    """Permute until the result passes; on values that pass, this is a permutation too."""
    while True:
        places = permute(key, tweak, places, radices, back)
        if valid(places):
            return places


def _spelled(key: bytes, tweak: str, text: str, alphabets: list[str], valid: Callable = lambda p: True, back=False) -> str:
    """Permute characters, each within its alphabet."""
    if not text:
        return text
    places = [a.index(c) for c, a in zip(text, alphabets)]
    made = walk(key, tweak, places, [len(a) for a in alphabets], valid, back)
    return "".join(a[p] for p, a in zip(made, alphabets))


def _refill(shape: str, characters: str, wanted: str) -> str:
    """Put new characters in the places of a written value, keeping its separators."""
    new = iter(characters)
    return "".join(next(new) if re.match(wanted, c) else c for c in shape)


def _only(text: str, wanted: str) -> str:
    return "".join(re.findall(wanted, text))


def luhn_sum(digits: str, more: int = 0) -> int:
    """The Luhn sum of digits that have `more` digits behind them."""
    doubled = (int(d) * (2 if at % 2 else 1) for at, d in enumerate(reversed(digits), more))
    return sum(d - 9 if d > 9 else d for d in doubled) % 10


def luhn(digits: str) -> bool:
    return luhn_sum(digits) == 0


def mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _class(c: str) -> str:
    return DIGITS if c in DIGITS else LOWER if c in LOWER else UPPER if c in UPPER else c


# Each of these takes a written value that passed its check and gives its pseudonym. They walk over pseudonyms that are
# not clear of other findings; e-mail addresses and secrets come first and are always clear.


def _email(key: bytes, text: str, back: bool, _: Callable[[str], bool]) -> str:
    name, _, host = text.partition("@")
    return _spelled(key, f"email@{host.lower()}", name, [_class(c) for c in name], back=back) + "@" + host


def _is_card(text: str) -> bool:
    digits = _only(text, "[0-9]")
    return 13 <= len(digits) <= 19 and luhn(digits) and len(set(digits)) > 1


def _card(key: bytes, text: str, back: bool, clear: Callable[[str], bool]) -> str:
    digits = _only(text, "[0-9]")
    shifted = luhn_sum(digits, 1)

    def whole(p: list[int]) -> str:
        body = digits[0] + "".join(map(str, p))
        return body + str(-luhn_sum(body, 1) % 10)

    def valid(p: list[int]) -> bool:
        # With both sums as they were, a longer run of digits passes or fails as it did before.
        return luhn_sum(whole(p), 1) == shifted and clear(_refill(text, whole(p), "[0-9]"))

    tweak = f"card{len(digits)}{digits[0]}"
    made = walk(key, tweak, [int(d) for d in digits[1:-1]], [10] * (len(digits) - 2), valid, back)
    return _refill(text, whole(made), "[0-9]")


# Lengths of the IBAN registry; a country that is not listed may have any.
IBAN_LENGTHS = {
    land: length
    for length, lands in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for land in lands.split()
}


def _is_iban(text: str) -> bool:
    iban = _only(text.upper(), "[0-9A-Z]")
    # In small letters it could be words: only the lengths of known countries count.
    length = IBAN_LENGTHS.get(iban[:2], 0 if text.islower() else len(iban))
    return 15 <= len(iban) <= 34 and len(iban) == length and mod97(iban) == 1


def _iban(key: bytes, text: str, back: bool, clear: Callable[[str], bool]) -> str:
    upper = text.upper()
    iban = _only(upper, "[0-9A-Z]")
    land, body = iban[:2], iban[4:]
    alphabets = [_class(c) for c in body]

    def whole(p: list[int]) -> str:
        new = "".join(a[x] for x, a in zip(p, alphabets))
        new = _refill(upper, f"{land}{98 - mod97(f'{land}00{new}'):02d}{new}", "[0-9A-Z]")
        return new.lower() if text.islower() else new

    places, radices = [a.index(c) for c, a in zip(body, alphabets)], [len(a) for a in alphabets]
    return whole(walk(key, f"iban{land}", places, radices, lambda p: clear(whole(p)), back))


# Fixed values of the international numbering plan: how a country code is told from what follows, and how many digits
# follow it (least, most). Codes that are not listed have 7 to 12.
COUNTRY_CODE = re.compile(r"\+(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2})")
PHONE_DIGITS = {
    "1": (10, 10), "7": (10, 10), "20": (8, 10), "27": (9, 9), "30": (10, 10), "31": (9, 9), "32": (8, 9), "33": (9, 9),
    "34": (9, 9), "36": (8, 9), "39": (6, 11), "40": (9, 9), "41": (9, 9), "43": (7, 13), "44": (9, 10), "45": (8, 8),
    "46": (7, 9), "47": (8, 8), "48": (9, 9), "49": (7, 11), "51": (8, 9), "52": (10, 10), "54": (10, 11), "55": (10, 11),
    "56": (9, 9), "57": (10, 10), "60": (8, 10), "61": (9, 9), "62": (8, 12), "63": (8, 10), "64": (8, 10), "65": (8, 8),
    "66": (8, 9), "81": (9, 10), "82": (8, 10), "84": (9, 10), "86": (10, 11), "90": (10, 10), "91": (10, 10), "92": (9, 10),
    "351": (9, 9), "353": (7, 9), "358": (6, 12), "380": (9, 9), "386": (8, 8), "420": (9, 9), "421": (9, 9), "852": (8, 8),
    "966": (8, 9), "971": (8, 9), "972": (8, 9),
}


def _phone_parts(text: str) -> tuple[str, str, str]:
    """Country code, its zero for calls within the country (or nothing) and the number; the code of a North American
    number may be left out."""
    digits, found = _only(text, "[0-9]"), COUNTRY_CODE.match(text)
    if not found:
        return "", "", digits
    code, rest = found[1], digits[len(found[1]) :]
    trunk = "0" if rest[:1] == "0" and code != "39" else ""
    return code, trunk, rest[len(trunk) :]


def _is_number(code: str, digits: str) -> bool:
    least, most = PHONE_DIGITS.get(code or "1", (7, 12))
    if not least <= len(digits) <= most or (digits[0] == "0" and code != "39"):
        return False
    return code not in ("", "1") or (digits[0] > "1" and digits[3] > "1")


def _is_phone(text: str) -> bool:
    code, _, number = _phone_parts(text)
    return (code != "" or text[0] != "+") and _is_number(code, number)


def _phone(key: bytes, text: str, back: bool, clear: Callable[[str], bool]) -> str:
    code, trunk, number = _phone_parts(text)

    def whole(new: str) -> str:
        return _refill(text, code + trunk + new, "[0-9]")

    def valid(p: list[int]) -> bool:
        new = "".join(map(str, p))
        return _is_number(code, new) and clear(whole(new))

    # A number is the same with and without its country code, and with and without the zero.
    tweak = f"phone{code or '1'}/{len(number)}"
    return whole(_spelled(key, tweak, number, [DIGITS] * len(number), valid, back))


def _is_address(text: str) -> bool:
    return all(int(p) <= 255 and str(int(p)) == p for p in text.split("."))


def _address(key: bytes, text: str, back: bool, clear: Callable[[str], bool]) -> str:
    parts = text.split(".")
    least = [0 if len(p) == 1 else 10 ** (len(p) - 1) for p in parts]
    sizes = [{1: 10, 2: 90, 3: 156}[len(p)] for p in parts]

    def whole(p: list[int]) -> str:
        return ".".join(str(x + a) for x, a in zip(p, least))

    tweak = "ip" + "".join(str(len(p)) for p in parts)
    places = [int(p) - a for p, a in zip(parts, least)]
    return whole(walk(key, tweak, places, sizes, lambda p: clear(whole(p)), back))


def _is_social(text: str) -> bool:
    area, group, serial = (int(p) for p in re.split("[- ]", text))
    return area not in (0, 666) and area < 900 and group > 0 and serial > 0


def _social(key: bytes, text: str, back: bool, clear: Callable[[str], bool]) -> str:
    def whole(p: list[int]) -> str:
        return _refill(text, "{:03d}{:02d}{:04d}".format(*p), "[0-9]")

    def valid(p: list[int]) -> bool:
        return _is_social(whole(p)) and clear(whole(p))

    return whole(walk(key, "social", [int(p) for p in re.split("[- ]", text)], [1000, 100, 10000], valid, back))


def _read_date(text: str) -> tuple[str, int] | None:
    """The order of day, month and year, and the day counted from `FIRST_DAY`; day before month if both can be read."""
    numbers = re.findall("[0-9]+", text)
    for order in ["ymd"] if len(numbers[0]) == 4 else ["dmy", "mdy"]:
        named = dict(zip(order, map(int, numbers)))
        try:
            day = datetime.date(named["y"], named["m"], named["d"]).toordinal() - FIRST_DAY
        except ValueError:
            continue
        if 0 <= day <= LAST_DAY - FIRST_DAY:
            return order, day
    return None


def _is_date(text: str) -> bool:
    return _read_date(text) is not None


def _date(key: bytes, text: str, back: bool, clear: Callable[[str], bool]) -> str:
    order, day = _read_date(text)
    widths = dict(zip(order, map(len, re.findall("[0-9]+", text))))
    side = 271

    def whole(p: list[int]) -> str:
        new = datetime.date.fromordinal(FIRST_DAY + p[0] * side + p[1])
        filled = {"y": f"{new.year:04d}", "m": f"{new.month:0{widths['m']}d}", "d": f"{new.day:0{widths['d']}d}"}
        return "".join(filled[c] for c in order)

    def valid(p: list[int]) -> bool:
        # The notation decides how the new date is written, so it must fit there and be read in the same order.
        if p[0] * side + p[1] > LAST_DAY - FIRST_DAY:
            return False
        digits = whole(p)
        if len(digits) != sum(widths.values()):
            return False
        new = _refill(text, digits, "[0-9]")
        return _read_date(new) == (order, p[0] * side + p[1]) and clear(new)

    narrow = "".join(c for c in "md" if widths[c] == 1)
    tweak = "date" + "m" * (order == "mdy") + (f"/{narrow}" if narrow else "")
    return _refill(text, whole(walk(key, tweak, list(divmod(day, side)), [side, side], valid, back)), "[0-9]")


# What stands in front of a secret. Values that are assigned may be hexadecimal; the others keep the class of each character.
SECRET = re.compile(
    r"\bAKIA[0-9A-Z]{16}\b|\bgh[oprsu]_[A-Za-z0-9]{36,}|\bxox[abprs]-[A-Za-z0-9-]{9,}[A-Za-z0-9]"
    r"|\b(?i:bearer) (?=[A-Za-z._~+/=-]*[0-9])[A-Za-z0-9._~+/=-]{15,}[A-Za-z0-9_~+/=-]"
    r"|(?<![A-Za-z0-9])(?i:password|passwd|passphrase) (?i:is|was) [\"']?(?=[A-Za-z_/+-]*[0-9])"
    r"[A-Za-z0-9_/+-][A-Za-z0-9_/+.:=-]{6,}[A-Za-z0-9_/+=-]"
    r"|(?<![A-Za-z0-9])(?i:password|passwd|passphrase|secret|token|(?:api|secret|private)[_-]?key)\s?[=:]\s?[\"']?"
    r"(?![a-z]{2,8}://)[A-Za-z0-9_/+-][A-Za-z0-9_/+.:=-]{6,}[A-Za-z0-9_/+=-]"
)
SECRET_HEAD = re.compile(
    r"AKIA|gh[oprsu]_|xox[abprs]-|(?i:bearer) |(?i:pass[a-z]+ (?:is|was)) [\"']?|(?P<assigned>[^=:]*[=:]\s?[\"']?)"
)

# Longer secrets are permuted in pieces, so the work grows with their length.
PIECE = 128


def _secret(key: bytes, text: str, back: bool, _: Callable[[str], bool]) -> str:
    head = SECRET_HEAD.match(text)
    value, made = text[head.end() :], []
    for at in range(0, len(value), PIECE):
        piece = value[at : at + PIECE]
        is_hex = head["assigned"] is not None and re.fullmatch("[0-9a-f]+", piece) is not None
        alphabets = [HEX if is_hex else DIGITS + UPPER if head[0] == "AKIA" else _class(c) for c in piece]

        def valid(p: list[int]) -> bool:
            # What is not hexadecimal must not become so, or it would be read in another alphabet.
            new = "".join(a[x] for x, a in zip(p, alphabets))
            return is_hex or head["assigned"] is None or re.fullmatch("[0-9a-f]+", new) is None

        made.append(_spelled(key, f"secret{len(value)}" + (f"/{at}" if at else ""), piece, alphabets, valid, back))
    return head[0] + "".join(made)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: re.Pattern
    make: Callable[..., str]
    # For kinds whose values may run on into what follows: whether a written value is valid, and what may follow one.
    check: Callable[[str], bool] | None = None
    after: re.Pattern | None = None


_no_digit = re.compile("(?![0-9])")

# Numbers with a plus come before IBANs and cards, which may hide in the digits that follow them.
KINDS = (
    Kind("email", re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}"), _email),
    Kind("secret", SECRET, _secret),
    Kind("phone", re.compile(r"(?<![0-9+])\+[0-9]{1,3}[ .-]?(?:\(0\) ?)?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){1,5}(?![0-9])"), _phone, _is_phone, _no_digit),
    Kind("iban", re.compile(r"\b(?:[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?|[a-z]{2}[0-9]{2}(?: ?[0-9a-z]{4}){2,7}(?: ?[0-9a-z]{1,3})?)\b"), _iban, _is_iban, re.compile(r"\b")),
    Kind("card", re.compile(r"(?<![0-9.-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"), _card, _is_card, _no_digit),
    Kind("phone", re.compile(r"(?<![0-9+])(?:\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4})(?![0-9])"), _phone, _is_phone, _no_digit),
    Kind("ip", re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])"), _address, _is_address, re.compile(r"(?!\.?[0-9])")),
    Kind("social", re.compile(r"(?<![0-9-])[0-9]{3}([- ])[0-9]{2}\1[0-9]{4}(?!-?[0-9])"), _social, _is_social, re.compile("(?!-?[0-9])")),
    Kind("date", re.compile(r"(?<![0-9./-])(?:[0-9]{4}([-/.])[0-9]{2}\1[0-9]{2}|[0-9]{4}([-/])[0-9]{1,2}\2[0-9]{1,2}|[0-9]{1,2}([/.-])[0-9]{1,2}\3[0-9]{4})(?![0-9])"), _date, _is_date, _no_digit),
)

_digit_or_at = re.compile("[0-9@]")
_secret_word = re.compile("AKIA|xox|gh[oprsu]_|(?i:passw|passphrase|secret|token|key|bearer)")

# No span that a check is asked about is longer.
LONGEST = 64


class Spans:
    """What was found in a text: values that do not overlap, in the order in which they were found, and the spans that
    failed a check."""

    def __init__(self, text: str):
        self.values: list[tuple[Kind, int, int]] = []
        self.starts, self.ends, self.failed = [], [], []
        for kind in KINDS:
            if kind.check is None:
                for found in kind.pattern.finditer(text):
                    self._take(kind, *found.span())
            else:
                self._search(kind, text)
        self.failed.sort(key=lambda x: x[0])
        self.failed_starts = [x[0] for x in self.failed]

    def _is_free(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end)
        return at == 0 or self.ends[at - 1] <= start

    def _take(self, kind: Kind, start: int, end: int) -> None:
        if self._is_free(start, end):
            at = bisect_left(self.starts, start)
            self.starts.insert(at, start)
            self.ends.insert(at, end)
            self.values.append((kind, start, end))

    def _search(self, kind: Kind, text: str) -> None:
        """The valid values of a kind: at each start the longest one that passes, and after it from its end on."""
        at = 0
        while found := kind.pattern.search(text, at):
            start = found.start()
            at = start + 1
            for end in range(found.end(), start, -1):
                if not kind.after.match(text, end) or not self._is_free(start, end):
                    continue
                if not kind.pattern.fullmatch(text, start, end):
                    continue
                if kind.check(text[start:end]):
                    self._take(kind, start, end)
                    at = end
                    break
                self.failed.append((start, end, kind.check))

    def near(self, start: int, end: int) -> list[tuple[int, int, Callable[[str], bool]]]:
        """The failed spans that share a character with a value."""
        first, last = (bisect_left(self.failed_starts, x) for x in (start - LONGEST, end))
        return [x for x in self.failed[first:last] if x[1] > start]


def findings(text: str, key: bytes, back: bool = False) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, pseudonym) of each value, from left to right; `back` gives the values of pseudonyms."""
    if not _digit_or_at.search(text) and not _secret_word.search(text):
        return []
    spans, now, out = Spans(text), list(text), []
    for kind, start, end in reversed(spans.values) if back else spans.values:
        near = spans.near(start, end)

        def clear(new: str) -> bool:
            for a, b, check in near:
                left, right = "".join(now[a:start]), "".join(now[end:b])
                if check(left + new[max(a - start, 0) : max(b - start, 0)] + right):
                    return False
            return True

        made = kind.make(key, text[start:end], back, clear)
        now[start:end] = made
        out.append((kind.name, start, end, made))
    return sorted(out, key=lambda x: x[1])


def replace(text: str, found: list[tuple[str, int, int, str]]) -> str:
    out, at = [], 0
    for _, start, end, made in found:
        out += [text[at:start], made]
        at = end
    return "".join([*out, text[at:]])


def restore(text: str, key: bytes) -> str:
    """The text before its values were replaced under the same key."""
    return replace(text, findings(text, key, back=True))


def session_key(spark: SparkSession) -> bytes:
    """The key that the session names, else the one for tests, whose pseudonyms anyone can take back."""
    named = spark.conf.get(KEY_SETTING, None)
    return TEST_KEY if named is None else named.encode()


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """The same rows and columns, with pseudonyms in the text."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = [None if t is None else replace(t, findings(t, key)) for t in batch.column(at).to_pylist()]
                columns = list(batch.columns)
                columns[at] = pa.array(made, columns[at].type)
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def spans(docs: DataFrame, key: bytes) -> DataFrame:
    """doc_id, the text with pseudonyms, and where they are: kind, start, end (in characters) and pseudonym."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    row = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("pseudonym", pa.string())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        found = [findings(t or "", key) for t in texts]
        made = [None if t is None else replace(t, f) for t, f in zip(texts, found)]
        lists = [[dict(zip(("kind", "start", "end", "pseudonym"), x)) for x in f] for f in found]
        columns = [batch.column(0), pa.array(made, pa.string()), pa.array(lists, pa.list_(row))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "found"])

    schema = f"doc_id {kind}, text string, found array<struct<kind: string, start: int, end: int, pseudonym: string>>"
    return arrow_map(docs.select("doc_id", "text"), run, schema)
