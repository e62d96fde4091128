"""PII: format-preserving Feistel pseudonyms.

Numbers and dates that pass their checks (Luhn for cards, mod 97 for IBANs,
areas and groups for social security numbers, octets for IP addresses, the
calendar for dates, digit counts for phones) and the local parts of e-mail
addresses are replaced by another valid value of the same format.  The
replacement is a keyed permutation of the format's values (a Feistel network
over the value's number, walked until it falls into range), so equal values
get equal pseudonyms in every document, different ones never meet, and the
holder of the key can turn them back.  Punctuation, spaces and the places of
capitals stay (turned back, a name's capitals may be lost); equal digits
written differently stay linked.

Values that fail their check are ordinary numbers and stay as they are.  A card
or IBAN may be followed or preceded by other numbers: every beginning of the run
is tried, then the next number of it.  Where a part of such a run would pass for
a value beside the pseudonym, the next pseudonym is taken, so that it can be
turned back (there alone, equal values may differ).  Dates with slashes are day
first, and month first where that is no date.

Defined results: null texts stay null with no findings; repeated rows are
treated alike; very long texts are scanned whole in one left-to-right pass;
empty tables give empty tables; other columns are not read.
"""

from __future__ import annotations

import datetime
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlane.llm.common import per_batch

ROUNDS = 8
FIRST_DAY, DAYS = datetime.date(1900, 1, 1).toordinal(), 73049        # to 2099-12-31
_CHARS = "0123456789abcdefghijklmnopqrstuvwxyz"

NUMBER = re.compile(r"""(?<![\dA-Za-z])(?:
    (?P<iso>\d{4}-\d{2}-\d{2}(?![\d-]))
  | (?P<date>(?<!\d[./])\d{1,2}(?P<sep>[./])\d{1,2}(?P=sep)\d{4}(?!\d|[./]\d))
  | (?P<ip>(?<!\d\.)\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d))
  | (?P<ssn>\d{3}-\d{2}-\d{4}(?![\d-]))
  | (?P<phone>\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d) | \(\d{3}\)[ ]?\d{3}[.-]\d{4}(?!\d) | \d{3}[.-]\d{3}[.-]\d{4}(?!\d))
  | (?P<card>\d(?:[ -]?\d){12,18}(?!\d))
  | (?P<iban>[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]){11,30}(?![A-Za-z0-9]))
)""", re.X)
TOKEN = re.compile(r"[\dA-Za-z]+|.", re.S)
#: Length of a country's IBANs.
IBAN_LENGTH = {c[:2]: int(c[2:]) for c in """AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28
    EE20 EG29 ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32
    LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24
    SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30""".split()}
EMAIL = re.compile(r"@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


class Feistel:
    """Keyed permutations of 0..n-1 for any n, one for each tweak."""

    def __init__(self, key: bytes, rounds: int = ROUNDS):
        self.key, self.rounds = hashlib.blake2b(key, digest_size=32).digest(), rounds

    def _f(self, tweak: bytes, r: int, v: int, bits: int) -> int:
        if bits > 256:
            h = hashlib.shake_256(self.key + tweak + bytes((r,)) + v.to_bytes(-(-bits // 8), "big")).digest(-(-bits // 8))
        else:
            h = hashlib.blake2b(tweak + bytes((r,)) + v.to_bytes(32, "big"), key=self.key, digest_size=32).digest()
        return int.from_bytes(h, "big") & ((1 << bits) - 1)

    def permute(self, v: int, n: int, tweak: bytes, back: bool = False) -> int:
        half = max(1, -(-max(1, (n - 1).bit_length()) // 2))
        order = range(self.rounds)
        while True:                                             # the domain is less than 4 n: few steps
            a, b = v >> half, v & ((1 << half) - 1)
            for r in reversed(order) if back else order:
                a, b = (b ^ self._f(tweak, r, a, half), a) if back else (b, a ^ self._f(tweak, r, b, half))
            v = a << half | b
            if v < n:
                return v

    def permute_list(self, v: list[int], base: int, tweak: bytes, back: bool = False) -> list[int]:
        """A permutation of lists of numbers below ``base``, in time linear in their length."""
        v = np.array(v, np.int64)
        halves = [v[:len(v) // 2], v[len(v) // 2:]]
        for r in reversed(range(self.rounds)) if back else range(self.rounds):
            of, to = halves[r % 2], halves[1 - r % 2]
            h = hashlib.shake_256(self.key + tweak + bytes((r,)) + of.astype(">u2").tobytes()).digest(4 * len(to))
            f = np.frombuffer(h, ">u4").astype(np.int64)
            halves[1 - r % 2] = (to - f if back else to + f) % base
        return np.concatenate(halves).tolist()


def luhn_digit(payload: str) -> str:
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return str(-total % 10)


def iban_check(country: str, bban: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in bban + country) + '00') % 97:02d}"


def card_fits(s: str) -> bool:
    d = re.sub(r"\D", "", s)
    return luhn_digit(d[:-1]) == d[-1] and bool(d.strip("0"))


def iban_fits(s: str) -> bool:
    t = s.replace(" ", "")
    return 15 <= len(t) <= 34 and iban_check(t[:2], t[4:]) == t[2:4] and any(c.isdigit() for c in t[4:])


FITS = {"card": card_fits, "iban": iban_fits}


def prefixes(s: str, kind: str) -> list[int]:
    """Lengths of the beginnings of ``s`` that end with a word and may be a value, in the order they are tried:
    cards shortest first, since what follows them is more often another number; IBANs by their country's length, else longest first."""
    least, ends, n = 13 if kind == "card" else 15, [], 0
    for k, c in enumerate(s, 1):
        n += c.isalnum()
        if n >= least and c.isalnum() and (k == len(s) or not s[k].isalnum()):
            ends.append((n, k))
    if kind == "iban":
        ends.sort(key=lambda e: (e[0] != IBAN_LENGTH.get(s[:2]), -e[0]))
    return [k for _, k in ends]


def _refill(shape: str, chars: str) -> str:
    """``chars`` in the places of the letters and digits of ``shape``, letter case kept."""
    it = iter(chars)
    return "".join((next(it).upper() if c.isupper() else next(it)) if c.isalnum() else c for c in shape)


class Pseudonyms:
    def __init__(self, key: bytes):
        self.fpe = Feistel(key)

    def digits(self, s: str, kind: str, back: bool) -> str:
        return str(self.fpe.permute(int(s), 10 ** len(s), f"{kind}{len(s)}".encode(), back)).zfill(len(s))

    def card(self, s: str, back: bool) -> str | None:
        d = re.sub(r"\D", "", s)
        if not card_fits(s):
            return None
        p = self.digits(d[:-1], "card", back)
        while not p.strip("0"):
            p = self.digits(p, "card", back)
        return _refill(s, p + luhn_digit(p))

    def ssn(self, s: str, back: bool) -> str | None:
        d = s.replace("-", "")
        ok = lambda d: d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"
        if not ok(d):
            return None
        while True:
            d = self.digits(d, "ssn", back)
            if ok(d):
                return _refill(s, d)

    def phone(self, s: str, back: bool) -> str | None:
        d = re.sub(r"\D", "", s)
        if not 9 <= len(d) <= 15:
            return None
        keep = len(re.match(r"\+?(\d{1,3})(?=[ .(-])", s)[1]) if s[0] == "+" and re.match(r"\+\d{1,3}[ .(-]", s) else 0
        return _refill(s, d[:keep] + self.digits(d[keep:], "phone", back))

    def ip(self, s: str, back: bool) -> str | None:
        parts = s.split(".")
        if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
            return None
        v = self.fpe.permute(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, b"ip", back)
        return ".".join(map(str, v.to_bytes(4, "big")))

    def day(self, y: int, m: int, d: int, back: bool) -> datetime.date | None:
        """The pseudonym of a date: one whose day and month have as many digits, so that it fits any way to write it."""
        try:
            old = datetime.date(y, m, d)
        except ValueError:
            return None
        n = old.toordinal()
        near = FIRST_DAY <= n < FIRST_DAY + DAYS
        low, size = ((FIRST_DAY, DAYS) if near else (1, FIRST_DAY - 1) if n < FIRST_DAY
                     else (FIRST_DAY + DAYS, datetime.date.max.toordinal() - FIRST_DAY - DAYS + 1))
        while True:
            n = low + self.fpe.permute(n - low, size, b"day" if near else b"far", back)
            new = datetime.date.fromordinal(n)
            if (new.day < 10, new.month < 10) == (old.day < 10, old.month < 10):
                return new

    def iso(self, s: str, back: bool) -> str | None:
        day = self.day(*map(int, s.split("-")), back)
        return day and f"{day.year:04d}-{day.month:02d}-{day.day:02d}"

    def date(self, s: str, back: bool) -> str | None:
        sep = "." if "." in s else "/"
        one, two, year = s.split(sep)
        d, m, y = int(one), int(two), int(year)
        write = lambda a, b, y: f"{a:0{len(one)}d}{sep}{b:0{len(two)}d}{sep}{y:04d}"
        day = self.day(y, m, d, back)          # day first
        if day is None and sep == "/" and (day := self.day(y, d, m, back)):
            while day.day <= 12:               # month first: a day that cannot be read as a month
                day = self.day(day.year, day.month, day.day, back)
            return write(day.month, day.day, day.year)
        return day and write(day.day, day.month, day.year)

    def iban(self, s: str, back: bool) -> str | None:
        t = s.replace(" ", "")
        if not iban_fits(s):
            return None
        digits = "".join(c for c in t[4:] if c.isdigit())
        it = iter(self.digits(digits, "iban", back))
        bban = "".join(next(it) if c.isdigit() else c for c in t[4:])
        return _refill(s, t[:2] + iban_check(t[:2], bban) + bban)

    def local(self, s: str, back: bool) -> str:
        chars = "".join(c.lower() for c in s if c.isalnum())
        if not chars:
            return s
        places = self.fpe.permute_list([_CHARS.index(c) for c in chars], 36, f"mail{len(chars)}".encode(), back)
        return _refill(s, "".join(_CHARS[i] for i in places))

    def apart(self, text: str, a: int, s: str, kind: str, back: bool, before: list, failed: list) -> str:
        """The pseudonym of the card or IBAN ``s`` at ``a``; walked on while a span that was no value, and is read before it, would be one."""
        new = first = getattr(self, kind)(s, back)
        while True:
            line = {x: (y, n) for x, y, k, n in [*before, (a, a + len(s), kind, new)] if k in FITS}
            for x, y, k in failed:
                piece = list(text[x:y])
                for c, (d, n) in line.items():
                    for i in range(max(c, x), min(d, y)):
                        piece[i - x] = n[i - c]
                if FITS[k]("".join(piece)):
                    break
            else:
                return new
            new = getattr(self, kind)(new, back)
            if new == first:                                     # no pseudonym is better
                return new

    def rewrite(self, text: str, back: bool = False) -> tuple[str, list[tuple[int, int, str]]]:
        """The text with pseudonyms, and what was found where (code points of the original)."""
        found: list[tuple[int, int, str, str]] = []
        for m in EMAIL.finditer(text):
            a = m.start()
            while a and text[a - 1] in LOCAL:
                a -= 1
            while a < m.start() and text[a] in ".-+%":
                a += 1
            if a < m.start():
                found.append((a, m.start(), "email", self.local(text[a: m.start()], back)))
        mails = len(found)
        at = end = 0
        failed: list[tuple[int, int, str]] = []                  # spans that are no value, but may become one beside a pseudonym
        while m := NUMBER.search(text, end):
            kind = m.lastgroup if m.lastgroup != "sep" else "date"
            a, b = m.span()
            end = TOKEN.match(text, a).end()                     # where to go on if this is no value
            while at < mails and found[at][1] <= a:
                at += 1
            limit = found[at][0] if at < mails else len(text)    # the next address
            if limit <= a:
                end = found[at][1]
            elif kind in FITS:
                failed = [f for f in failed if f[1] > a]
                for k in prefixes(m[0], kind):
                    if a + k > limit:
                        continue
                    if FITS[kind](m[0][:k]):
                        found.append((a, a + k, kind, self.apart(text, a, m[0][:k], kind, back, found[max(mails, len(found) - 3):], failed)))
                        end = a + k
                        break
                    failed.append((a, a + k, kind))
            elif b <= limit and (new := getattr(self, kind)(m[0], back)) is not None:
                found.append((a, b, kind, new))
                end = b
        found.sort()
        out, end = [], 0
        for a, b, _, new in found:
            out += (text[end:a], new)
            end = b
        return "".join(out) + text[end:], [f[:3] for f in found]


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, text (with pseudonyms) and findings (start, end, kind)."""
    def make():
        p = Pseudonyms(key.encode())
        digit = re.compile(r"\d|@")

        def judge(b):
            done = [p.rewrite(t) if t and digit.search(t) else (t, []) for t in b.column("body").to_pylist()]
            return {"text": [d[0] for d in done], "findings": [[{"start": a, "end": e, "kind": k} for a, e, k in d[1]] for d in done]}
        return judge
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))
    finding = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])
    return per_batch(rows, ["id"], "text string, findings array<struct<start:int,end:int,kind:string>>",
                     {"text": pa.string(), "findings": pa.list_(finding)}, make)
