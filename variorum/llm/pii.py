"""Personal data: format-preserving Feistel pseudonyms, so that equal values stay linked.

Each kind of value is a number within the domain of its format: digits between a country
code and the end of a phone number, days of two centuries, the letters and digits of a mail
address.  A keyed Feistel network permutes that domain (stepping on until it lands inside
it), so the pseudonym has the same format, is valid where the value was, is the same in
every document, and can be turned back with the key.  Values that fail their check (Luhn,
mod 97, ranges, calendar) are not personal data and stay.
"""

from __future__ import annotations

import datetime
import re
from collections import Counter
from collections.abc import Callable, Iterator
from hashlib import blake2b

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

KINDS = ("email", "iban", "ip", "ssn", "phone", "card", "date")
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "ip": r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w+])\+\d{1,3}(?:[ .-]?\(\d{1,4}\)|[ .-]?\d{2,4}){2,5}(?!\d)|(?<![\w+.-])(?:\(\d{3}\) ?|\d{3}[-.])\d{3}[-.]\d{4}(?![\w-])",
    "card": r"(?<!\w)(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?!\w)",
    "date": r"(?<![\w.-])\d{4}-\d{2}-\d{2}(?![\w-])|(?<![\w./])\d{1,2}([./])\d{1,2}\1\d{4}(?![\w/])",
}
_ANY = re.compile("|".join(f"(?P<{k}>{p})".replace(r"([./])", r"(?P<sep>[./])").replace(r"\1", "(?P=sep)") for k, p in PATTERNS.items()), re.ASCII)
_MAYBE = re.compile(r"[@0-9]")
_FIRST_DAY, _DAYS = datetime.date(1900, 1, 1).toordinal(), (datetime.date(2100, 1, 1) - datetime.date(1900, 1, 1)).days


class Feistel:
    """A keyed permutation of range(n) for any n, by a balanced Feistel network and cycle walking."""

    ROUNDS = 8

    def __init__(self, key: bytes, inverse: bool = False):
        self.key, self.inverse = key, inverse

    def _pass(self, x: int, half: int, tweak: bytes) -> int:
        mask = (1 << half) - 1
        left, right = x >> half, x & mask
        size = (half + 7) // 8
        for r in range(self.ROUNDS):
            r, known = (self.ROUNDS - 1 - r, left) if self.inverse else (r, right)
            f = int.from_bytes(blake2b(known.to_bytes(size, "big"), digest_size=min(64, size + 8), key=self.key, person=b"%d" % r, salt=tweak).digest(), "big") & mask
            left, right = (right ^ f, left) if self.inverse else (right, left ^ f)
        return left << half | right

    def permute(self, x: int, n: int, tweak: str, inside: Callable[[int], bool] = lambda x: True) -> int:
        """x of range(n) to another of it; both lie in the part that `inside` tells."""
        half = max(1, ((n - 1).bit_length() + 1) // 2)
        salt = blake2b(f"{tweak}:{n}".encode(), digest_size=16).digest()
        while True:
            x = self._pass(x, half, salt)
            if x < n and inside(x):
                return x


def _fill(shape: str, chars: Iterator[str]) -> str:
    """The shape with its letters and digits replaced in turn, in the case of the old ones."""
    return "".join(next(chars).upper() if c.isupper() else next(chars) if c.isalnum() else c for c in shape)


def _by_class(text: str, fp: Feistel, tweak: str) -> str:
    """Every digit to a digit and every letter to a letter, as one mixed-radix number."""
    radix = [10 if c.isdigit() else 26 for c in text if c.isalnum()]
    x = n = 0
    n = 1
    for c, r in zip((c for c in text.lower() if c.isalnum()), radix, strict=True):
        x, n = x * r + (ord(c) - (48 if r == 10 else 97)), n * r
    x = fp.permute(x, n, tweak)
    out = []
    for r in reversed(radix):
        x, d = divmod(x, r)
        out.append(chr(d + (48 if r == 10 else 97)))
    return _fill(text, reversed(out))


def _luhn(digits: str) -> int:
    """The check digit that completes the digits."""
    total = sum(d if i % 2 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
    return -total % 10


def _email(v: str, fp: Feistel) -> str:
    name, _, top = v.rpartition(".")  # the last label stays: it names no one
    return f"{_by_class(name, fp, 'email')}.{top}"


def _iban(v: str, fp: Feistel) -> str | None:
    flat = v.replace(" ", "")
    value = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(flat) <= 34 or value(flat[4:] + flat[:4]) % 97 != 1:
        return None
    body = _by_class(flat[4:], fp, "iban" + flat[:2])
    made = f"{flat[:2]}{98 - value(body + flat[:2] + '00') % 97:02d}{body}"
    at = iter(made)
    return "".join(next(at) if c != " " else c for c in v)


def _ip(v: str, fp: Feistel) -> str | None:
    parts = v.split(".")
    if any(int(p) > 255 or str(int(p)) != p for p in parts):
        return None
    x = fp.permute(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, "ip")
    return ".".join(map(str, x.to_bytes(4, "big")))


def _ssn(v: str, fp: Feistel) -> str | None:
    area, group, serial = map(int, v.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    x = fp.permute((area - 1 - (area > 666)) * 99 * 9999 + (group - 1) * 9999 + serial - 1, 898 * 99 * 9999, "ssn")
    area = x // (99 * 9999) + 1
    return f"{area + (area >= 666):03d}-{x // 9999 % 99 + 1:02d}-{x % 9999 + 1:04d}"


def _phone(v: str, fp: Feistel) -> str | None:
    digits = [i for i, c in enumerate(v) if c.isdigit()]
    if not 7 <= len(digits) <= 15:
        return None
    code = len(re.match(r"\+\d{1,3}", v)[0]) if v[0] == "+" else 0
    rest = [i for i in digits if i >= code]
    if not rest:
        return None
    flat = "".join(v[i] for i in rest)
    made = iter(f"{fp.permute(int(flat), 10 ** len(flat), 'phone' + v[:code]):0{len(flat)}d}")
    return v[:code] + _fill(v[code:], made)


def _card(v: str, fp: Feistel) -> str | None:
    flat = re.sub(r"\D", "", v)
    if int(flat[-1]) != _luhn(flat[:-1]) or flat == flat[0] * len(flat):
        return None
    n = len(flat) - 2  # the first digit stays, the last is the check
    body = flat[0] + f"{fp.permute(int(flat[1:-1]), 10**n, 'card' + flat[0]):0{n}d}"
    return _fill(v, iter(f"{body}{_luhn(body)}"))


def _date(v: str, fp: Feistel) -> str | None:
    iso = v[4:5] == "-"
    sep = "-" if iso else next(c for c in v if not c.isdigit())
    parts = v.split(sep)
    orders = [(0, 1, 2)] if iso else [(2, 1, 0), (2, 0, 1)]  # year, month, day; day first where it can be
    for k, order in enumerate(orders):
        try:
            day = datetime.date(*(int(parts[i]) for i in order))
        except ValueError:
            continue
        x = day.toordinal() - _FIRST_DAY
        if not 0 <= x < _DAYS:
            return None
        late = lambda x: datetime.date.fromordinal(x + _FIRST_DAY).day > 12
        new = datetime.date.fromordinal(fp.permute(x, _DAYS, "date" + "dm"[k], late if k else lambda x: True) + _FIRST_DAY)
        out = ["", "", ""]
        for i, value in zip(order, (new.year, new.month, new.day), strict=True):
            out[i] = f"{value:0{2 if len(parts[1]) == 2 else 1}d}" if value < 1000 else str(value)
        return sep.join(out)
    return None


_MAKERS = {"email": _email, "iban": _iban, "ip": _ip, "ssn": _ssn, "phone": _phone, "card": _card, "date": _date}


def pseudonymise(text: str, fp: Feistel) -> tuple[str, Counter]:
    """The text with every personal value replaced, and how many of each kind there were."""
    found: Counter = Counter()
    if not _MAYBE.search(text):
        return text, found
    out, done, at = [], 0, 0
    while m := _ANY.search(text, at):
        kind = next(k for k in KINDS if m[k] is not None)
        made = _MAKERS[kind](m[kind], fp)
        if made is None:
            at = m.start() + 1
            continue
        found[kind] += 1
        out += (text[done : m.start()], made)
        done = at = m.end()
    return "".join(out) + text[done:], found


def replaced(text: Column, key: bytes, inverse: bool = False) -> Column:
    """struct(text, n_email, ...): the text with pseudonyms, or with `inverse` the values again."""
    kind = StructType([StructField("text", StringType()), *(StructField(f"n_{k}", LongType()) for k in KINDS)])

    @F.pandas_udf(kind)
    def run(texts: pd.Series) -> pd.DataFrame:
        fp = Feistel(key, inverse)
        rows = []
        for t in texts:
            new, found = pseudonymise(t, fp) if t is not None else (None, Counter())
            rows.append((new, *(found[k] for k in KINDS)))
        return pd.DataFrame(rows, columns=["text", *(f"n_{k}" for k in KINDS)])

    return run(text)


def pseudonyms(docs: DataFrame, key: bytes, text_col: str = "text", inverse: bool = False) -> DataFrame:
    """docs with pseudonyms in `text_col` and the columns n_email, n_iban, n_ip, n_ssn, n_phone, n_card, n_date.

    A null text stays null with counts of 0, an empty one empty.  Columns of `docs` that bear
    the name of a count are replaced.  Rows are independent of each other.
    """
    counts = [f"n_{k}" for k in KINDS]
    kept = [c for c in docs.columns if c not in counts]
    out = docs.select(*kept, replaced(F.col(text_col).cast("string"), key, inverse).alias("__pii"))
    return out.select(*(F.col("__pii.text").alias(c) if c == text_col else F.col(c) for c in kept), *(F.col(f"__pii.{c}").alias(c) for c in counts))
