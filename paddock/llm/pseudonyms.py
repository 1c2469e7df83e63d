"""Format-preserving pseudonyms for personal data.

Patterns propose values and a check validates each (Luhn, mod-97, calendar,
number plan, octets). A validated value is ranked within its format, the
rank is permuted by a keyed Feistel network with cycle walking, and the
value of the new rank replaces it. The permutation depends on the key and
the format only, so equal values stay equal across documents, different
ones stay different, formats and check digits stay valid, and the holder of
the key can invert it.

A run of digit groups, or of groups after a country's letters, may hold more
than the value (an expiry date, a code, a word): its readings that begin and
end at group borders are tried in a fixed order and the first that validates
is replaced. A replacement that would make another reading of its run come
first is permuted again, so that an inversion meets the same reading; only
then does a value's replacement depend on its run. (Where other values of the
same run are replaced too, that is checked against the run as it was.)

Null text stays null; text without values stays as it is; rows are handled
one by one, so ids, repeats and other columns don't matter; an empty table
gives no rows.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import SPACE, ship, text_chunks, text_table

ROUNDS = 8
KINDS = ("email", "phone", "ip", "card", "iban", "ssn", "date", "secret")


class Feistel:
    """A keyed permutation of range(n): a balanced Feistel network on the
    least even number of bits that holds n, walked until inside."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, half: int, tweak: bytes, k: int, width: int) -> int:
        data = half.to_bytes((width + 7) // 8 or 1, "big")
        out = hashlib.blake2b(data, key=self.key, salt=bytes([k]), person=hashlib.blake2b(tweak, digest_size=16).digest(), digest_size=64 if width > 128 else 16).digest()
        while len(out) * 8 < width:
            out += hashlib.blake2b(out, key=self.key, digest_size=64).digest()
        return int.from_bytes(out, "big") & ((1 << width) - 1)

    def _once(self, x: int, width: int, tweak: bytes, back: bool) -> int:
        a, b = x >> width, x & ((1 << width) - 1)
        if back:
            for k in reversed(range(ROUNDS)):
                a, b = b ^ self._round(a, tweak, k, width), a
        else:
            for k in range(ROUNDS):
                a, b = b, a ^ self._round(b, tweak, k, width)
        return a << width | b

    def permute(self, x: int, n: int, tweak: str, back: bool = False) -> int:
        if n < 2:
            return x
        width = (max(2, (n - 1).bit_length()) + 1) // 2
        t = f"{tweak}/{n}".encode()
        while True:
            x = self._once(x, width, t, back)
            if x < n:
                return x


def luhn_digit(body: str) -> int:
    """Check digit that follows ``body``."""
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def luhn_valid(digits: str) -> bool:
    return luhn_digit(digits[:-1]) == int(digits[-1])


def refill(shape: str, values: str, keep: Callable[[str], bool]) -> str:
    """``shape`` with the characters that ``keep`` rejects replaced in turn."""
    it = iter(values)
    return "".join(c if keep(c) else next(it) for c in shape)


def _digits(s: str) -> str:
    return re.sub(r"\D", "", s)


class Pseudonyms:
    """Replacement of one value of each kind; None if it doesn't validate."""

    def __init__(self, key: bytes, back: bool = False):
        self.feistel, self.back = Feistel(key), back

    def _p(self, x: int, n: int, tweak: str) -> int:
        return self.feistel.permute(x, n, tweak, self.back)

    def number(self, digits: str, tweak: str) -> str:
        return str(self._p(int(digits), 10 ** len(digits), tweak)).zfill(len(digits))

    def card(self, s: str) -> str | None:
        d = _digits(s)
        if not 13 <= len(d) <= 19 or len(set(d)) == 1:
            return None
        if not luhn_valid(d):
            return None
        body = d[0] + self.number(d[1:-1], "card")
        return refill(s, body + str(luhn_digit(body)), lambda c: not c.isdigit())

    def phone(self, s: str) -> str | None:
        d = _digits(s)
        if not 7 <= len(d) <= 15:
            return None
        m = re.fullmatch(r"(\+?1[ .-]?)?(\(?[2-9]\d\d\)?[ .-]?[2-9]\d\d[ .-]?\d{4})", s)
        if m:  # the North American plan: area and exchange don't begin with 0 or 1
            head = m[1] or ""
            t = _digits(m[2])
            r = ((int(t[0]) - 2) * 100 + int(t[1:3])) * 8 * 10**6 + (int(t[3]) - 2) * 10**6 + int(t[4:])
            r = self._p(r, 800 * 8 * 10**6, "nanp")
            area, rest = divmod(r, 8 * 10**6)
            return head + refill(m[2], f"{area + 200:03d}{rest + 2 * 10**6:07d}", lambda c: not c.isdigit())
        m = re.match(r"\+\d{1,2}(?=\D)|\+\d", s)
        head = m[0] if m else ""
        rest = s[len(head) :]
        return head + refill(rest, self.number(_digits(rest), "phone" + head), lambda c: not c.isdigit())

    def ip(self, s: str) -> str | None:
        o = s.split(".")
        if any(int(x) > 255 or (len(x) > 1 and x[0] == "0") for x in o):
            return None
        r = self._p(int.from_bytes(bytes(map(int, o)), "big"), 1 << 32, "ip")
        return ".".join(map(str, r.to_bytes(4, "big")))

    def ssn(self, s: str) -> str | None:
        a, g, n = (int(x) for x in s.split("-"))
        if not (0 < a < 900 and a != 666 and g and n):
            return None
        r = self._p(((a - 1 - (a > 666)) * 99 + g - 1) * 9999 + n - 1, 898 * 99 * 9999, "ssn")
        r, n = divmod(r, 9999)
        a, g = divmod(r, 99)
        return f"{a + 1 + (a >= 665):03d}-{g + 1:02d}-{n + 1:04d}"

    def date(self, s: str) -> str | None:
        for order, sep in (("ymd", "-"), ("ymd", "/"), ("dmy", "."), ("dmy", "/"), ("mdy", "/")):
            p = s.split(sep)
            if len(p) != 3 or (order == "ymd") != (len(p[0]) == 4):
                continue
            v = {c: int(x) for c, x in zip(order, p, strict=True)}
            try:
                day = dt.date(v["y"], v["m"], v["d"]).toordinal()
            except ValueError:
                continue
            if not FIRST_DAY <= day < FIRST_DAY + DAYS:
                return None
            new = dt.date.fromordinal(FIRST_DAY + self._p(day - FIRST_DAY, DAYS, f"date{order}{sep}"))
            return sep.join({"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}[c] for c in order)
        return None

    def _classes(self, s: str, tweak: str) -> str:
        """Permute a string within the classes of its characters: lower and
        upper case Latin letters and digits; others stay."""
        n, x = 1, 0
        sizes = []
        for c in s:
            k, v = (10, ord(c) - 48) if "0" <= c <= "9" else (26, ord(c) - 97) if "a" <= c <= "z" else (26, ord(c) - 65) if "A" <= c <= "Z" else (1, 0)
            sizes.append(k)
            x, n = x * k + v, n * k
        shape = re.sub("[0-9]", "0", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", s)))
        x = self._p(x, n, tweak + shape)
        out = []
        for c, k in zip(reversed(s), reversed(sizes), strict=True):
            x, v = divmod(x, k)
            out.append(c if k == 1 else chr({"0": 48, "a": 97, "A": 65}["0" if c.isdigit() else "a" if c.islower() else "A"] + v))
        return "".join(reversed(out))

    def email(self, s: str) -> str | None:
        local, _, domain = s.rpartition("@")
        host, _, top = domain.rpartition(".")
        return f"{self._classes(local, 'local')}@{self._classes(host, 'host')}.{top}"

    def iban(self, s: str) -> str | None:
        flat = s.replace(" ", "")
        if not 15 <= len(flat) <= 34 or iban_check(flat[:2], flat[4:]) != flat[2:4]:
            return None
        body = self._classes(flat[4:], "iban" + flat[:2])
        return refill(s, flat[:2] + iban_check(flat[:2], body) + body, lambda c: c == " ")

    def secret(self, s: str) -> str | None:
        """Long hexadecimal strings, of either case."""
        if s.isdigit() or s.isalpha():
            return None
        upper = any(c.isupper() for c in s)
        new = f"{self._p(int(s, 16), 16 ** len(s), 'hex'):0{len(s)}x}"
        return new.upper() if upper else new


FIRST_DAY = dt.date(1900, 1, 1).toordinal()
DAYS = dt.date(2100, 1, 1).toordinal() - FIRST_DAY


def iban_check(country: str, body: str) -> str:
    n = int("".join(str(int(c, 36)) for c in body + country + "00"))
    return f"{98 - n % 97:02d}"


#: an address is looked for only around an @; the bounds are those of mail addresses
EMAIL = re.compile(r"[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}\b")
NUMBERS = re.compile(
    r"(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))"
    r"|(?P<secret>(?<![A-Za-z0-9])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![A-Za-z0-9]))"
    r"|(?P<ip>(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d))"
    r"|(?P<date>(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\d/-]))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<card>(?<![\d.-])\d(?:[ -]?\d){12,18}(?!\d))"
    r"|(?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{2,4})[ .-]\d{3,4}[ .-]?\d{3,4}(?![\w])|(?<![\w+])\+\d{8,15}(?!\w))"
)


class Scrubber:
    """Replaces all values of a text and counts them by kind; a worker keeps
    the latest replacements."""

    def __init__(self, key: bytes, back: bool = False):
        self.names = Pseudonyms(key, back)
        self.replaced = lru_cache(1 << 16)(self._replaced)
        self.counts: dict[str, int] = {}

    def _replaced(self, kind: str, value: str) -> str | None:
        return getattr(self.names, kind)(value)

    def _email(self, m: re.Match) -> str:
        self.counts["email"] = self.counts.get("email", 0) + 1
        return self.replaced("email", m[0])

    def _number(self, m: re.Match) -> str:
        new = self.replaced(m.lastgroup, m[0])
        if new is None:
            return m[0]
        self.counts[m.lastgroup] = self.counts.get(m.lastgroup, 0) + 1
        return new

    def _first(self, kind: str, text: str, spans: list[tuple[int, int]]) -> tuple[int, int] | None:
        return next((x for x in spans if self.replaced(kind, text[x[0] : x[1]]) is not None), None)

    def _grouped(self, m: re.Match) -> tuple[str, int]:
        """What replaces the text from the match of a card or IBAN on, and up to where."""
        kind, text, at = m.lastgroup, m.string, m.start()
        spans = card_spans(m) if kind == "card" else iban_spans(m)
        found = self._first(kind, text, spans)
        if found is None:
            if kind == "iban":
                return m[0], m.end()
            stop = max([m.end(), *(x.end() for x in PART.finditer(text, at, RUN.match(text, at).end()) if x.start() < m.end())])
            return self._parts(text, at, stop), stop
        s, e = found
        new = self.replaced(kind, text[s:e])
        end = max(x[1] for x in spans)
        while len(spans) > 1 and self._first(kind, new_run := text[at:s] + new + text[e:end], [(x - at, y - at) for x, y in spans]) != (s - at, e - at):
            new = self.replaced(kind, new_run[s - at : e - at])
        self.counts[kind] = self.counts.get(kind, 0) + 1
        return (self._parts(text, at, s) if kind == "card" else text[at:s]) + new, e

    def _parts(self, text: str, s: int, e: int) -> str:
        """Groups that are no card may still hold shorter values of strict formats."""
        out = []
        for m in PART.finditer(text, s, e):
            out += [text[s : m.start()], self._number(m)]
            s = m.end()
        return "".join([*out, text[s:e]])

    def scrub(self, text: str) -> tuple[str, dict[str, int]]:
        self.counts = {}
        if "@" in text:
            text = EMAIL.sub(self._email, text)
        out, at = [], 0
        while m := NUMBERS.search(text, at):
            new, stop = self._grouped(m) if m.lastgroup in ("card", "iban") else (self._number(m), m.end())
            out += [text[at : m.start()], new]
            at = stop
        return "".join([*out, text[at:]]), self.counts


#: a run of digit groups; a card that begins in the first 19 digits ends within so many groups
RUN = re.compile(r"\d+(?:[ -]\d+){0,40}")
DIGITS = re.compile(r"\d+")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
PART = re.compile(
    r"(?P<date>(?<![\d/.-])(?:\d{4}-\d{2}-\d{2})(?![\d/-]))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<phone>(?<![\w+])\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}(?!\w))"
)
#: lengths of card numbers, the most common first
CARDS = (16, 15, 14, 13, 19, 18, 17)
#: lengths of the registered IBANs
IBANS = {
    n: cs.split()
    for n, cs in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL SD FK", 19: "MK SI", 20: "AT BA EE KZ LT LU XK MN", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
        23: "AE GI IL IQ OM TL SO", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
}
IBAN_LENGTH = {c: n for n, cs in IBANS.items() for c in cs}


def card_spans(m: re.Match) -> list[tuple[int, int]]:
    """Readings of a run of digit groups, from border to border: by length, then from the left."""
    groups = [g.span() for g in DIGITS.finditer(m.string, m.start(), RUN.match(m.string, m.start()).end())]
    by_length: dict[int, list[tuple[int, int]]] = {}
    for i, (s, _) in enumerate(groups):
        if s >= m.end():
            break
        n = 0
        for a, e in groups[i:]:
            n += e - a
            if n > CARDS[4]:
                break
            by_length.setdefault(n, []).append((s, e))
    return [x for n in CARDS for x in by_length.get(n, ())]


def iban_spans(m: re.Match) -> list[tuple[int, int]]:
    """Readings of the IBANs that may begin in a match, from a start to a
    border: from the left, the country's length, then the longest."""
    out, inner = [], m
    while inner and inner.start() < m.end():
        s = inner.start()
        ends = [s + k for k, c in enumerate(inner[0]) if c == " "] + [inner.end()]
        sized = [(len(m.string[s:e].replace(" ", "")), e) for e in ends]
        known = IBAN_LENGTH.get(inner[0][:2])
        out += [(s, e) for n, e in sorted(sized, key=lambda x: (x[0] != known, -x[0])) if 15 <= n <= 34]
        inner = IBAN.search(m.string, s + 4)
    return out


_SCRUBBERS: dict[tuple[bytes, bool], Scrubber] = {}


def _scrubber(key: bytes, back: bool) -> Scrubber:
    if (key, back) not in _SCRUBBERS:
        _SCRUBBERS[key, back] = Scrubber(key, back)
    return _SCRUBBERS[key, back]


MARK = np.zeros(256, bool)
MARK[[*range(48, 58), 64]] = True


#: a value's digits are nearer to each other than this, or inside one token
REACH = 24


def stretches(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, stop) of the parts that may hold values: whole tokens
    around every digit and @, joined where they touch."""
    at = np.flatnonzero(MARK[buf])
    row = np.searchsorted(off, at, "right") - 1
    blank = np.concatenate([[-1], np.flatnonzero(SPACE[buf]), [len(buf)]])
    s = np.maximum(blank[np.searchsorted(blank, np.maximum(at - REACH, -1), "right") - 1] + 1, off[row])
    e = np.minimum(blank[np.searchsorted(blank, np.minimum(at + REACH, len(buf)))], off[row + 1])
    fresh = np.ones(len(at), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (s[1:] > e[:-1])
    first = np.flatnonzero(fresh)
    last = np.concatenate([first[1:], [len(at)]])[: len(first)] - 1
    return row[first], s[first], e[last]


def _texts(batch: pa.RecordBatch, scrub: Scrubber) -> tuple[list, list[dict[str, int]]]:
    """New texts and counts; only the stretches around digits and @ are read."""
    column = batch.column(batch.schema.get_field_index("text"))
    texts = column.to_pylist()
    counts: list[dict[str, int]] = [{}] * len(texts)
    for rows, buf, off in text_chunks(batch):
        raw = buf.tobytes()
        row, s, e = stretches(buf, off)
        k = 0
        while k < len(row):
            r = int(row[k])
            pieces, total, at = [], {}, int(off[r])
            while k < len(row) and row[k] == r:
                new, got = scrub.scrub(raw[s[k] : e[k]].decode())
                pieces += [raw[at : s[k]], new.encode()]
                at = int(e[k])
                for kind, n in got.items():
                    total[kind] = total.get(kind, 0) + n
                k += 1
            if total:
                texts[rows.start + r] = b"".join([*pieces, raw[at : off[r + 1]]]).decode()
                counts[rows.start + r] = total
    return texts, counts


def _report(batches: Iterator[pa.RecordBatch], key: bytes, back: bool) -> Iterator[pa.RecordBatch]:
    scrub = _scrubber(key, back)
    for batch in batches:
        texts, counts = _texts(batch, scrub)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(texts, pa.string()), *(pa.array([c.get(k, 0) for c in counts], pa.int64()) for k in KINDS)],
            names=["doc_id", "text", *(f"n_{k}" for k in KINDS)],
        )


def pseudonymise(docs: DataFrame, key: bytes, back: bool = False) -> DataFrame:
    """doc_id, the new text and the number of replaced values of each kind;
    ``back`` inverts an earlier run with the same key."""
    ship(docs.sparkSession)
    schema = "doc_id long, text string, " + ", ".join(f"n_{k} long" for k in KINDS)
    return text_table(docs).mapInArrow(lambda it: _report(it, key, back), schema)


def _rewrite(batches: Iterator[pa.RecordBatch], key: bytes) -> Iterator[pa.RecordBatch]:
    scrub = _scrubber(key, False)
    for batch in batches:
        at = batch.schema.get_field_index("text")
        texts, _ = _texts(batch, scrub)
        cols = [pa.array(texts, batch.schema.field(at).type) if k == at else batch.column(k) for k in range(batch.num_columns)]
        yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)


def replace_in(docs: DataFrame, key: bytes) -> DataFrame:
    """``docs``, all columns, with pseudonyms in ``text``."""
    ship(docs.sparkSession)
    return docs.mapInArrow(lambda it: _rewrite(it, key), docs.schema)
