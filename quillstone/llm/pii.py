"""PII: format-preserving Feistel pseudonyms.

Validated numbers, dates and addresses are replaced by others of the same
format: the value's digits and letters become one integer, a keyed Feistel
network permutes the integers of that many bits, and cycle walking stays inside
the format.  The permutation depends on the key and the format only, so equal
values stay linked across documents and the mapping can be undone with the key.

Values of more than ``LONG`` letters and digits take the same rounds character
by character: a half is shifted by a keyed stream that the other half sets, in
linear time, so a value of any length is mixed whole.

The key comes from the caller or from the session setting ``KEY_SETTING``;
without one nothing is pseudonymised and a ValueError is raised.

Kinds, in the order in which they are tried at a place: secret (a value of 8 or
more characters after a name like token or password), email, iban (mod 97),
ipv4 (octets to 255), date (of the years 1900 to 2099; year first, or day or
month first), ssn (issued areas), card (Luhn), phone.  Check digits are made
again, so a pseudonym is as valid as its value.  Values that do not validate
are left alone.

Defined results: null text stays null; very long texts are read whole; repeated
rows give equal rows; an empty table gives an empty result; other columns pass
through.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, others

KEY_SETTING = "spark.quillstone.pii.key"
ROUNDS = 8
LONG = 64
KINDS = ("secret", "email", "iban", "ipv4", "date", "ssn", "card", "phone")
CACHE_VALUES = 100_000

_PATTERN = re.compile(
    r"""
    (?P<secret>(?i:(?<![^\W_])(?:token|secret|password|passwd|pwd|api[_\-]?key|access[_\-]?key|auth[_\-]?key|private[_\-]?key)\b["']?\s*(?::|=>?)\s*["']?)(?P<value>[A-Za-z0-9+/_\-]{8,}))
    |(?P<email>(?<![A-Za-z0-9._%+\-])[A-Za-z0-9][A-Za-z0-9._%+\-]{0,63}@(?:[A-Za-z0-9](?:[A-Za-z0-9\-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![A-Za-z0-9]))
    |(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))
    |(?P<ipv4>(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9]))
    |(?P<date>(?<![0-9./\-])(?:(?:19|20)[0-9]{2}(?P<s1>[-/.])[0-9]{1,2}(?P=s1)[0-9]{1,2}|[0-9]{1,2}(?P<s2>[-/.])[0-9]{1,2}(?P=s2)(?:19|20)[0-9]{2})(?![0-9]|[./\-][0-9]))
    |(?P<ssn>(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9]))
    |(?P<card>(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?P<s3>[ \-])[0-9]{4}(?P=s3)[0-9]{4}(?P=s3)[0-9]{1,7}|[0-9]{4}(?P<s4>[ \-])[0-9]{6}(?P=s4)[0-9]{5})(?![0-9]))
    |(?P<phone>\+1[ .\-]?\(?[0-9]{3}\)?[ .\-]?[0-9]{3}[ .\-]?[0-9]{4}(?![0-9])
        |\+[2-9][0-9]{0,2}(?:[ .\-]?\(?[0-9]{1,5}\)?){2,6}(?![0-9])
        |(?<![0-9])\([0-9]{3}\)[ .\-]?[0-9]{3}[ .\-]?[0-9]{4}(?![0-9])
        |(?<![0-9.\-])[0-9]{3}(?P<s5>[.\-])[0-9]{3}(?P=s5)[0-9]{4}(?![0-9]|[.\-][0-9]))
    """,
    re.X,
)
#: No value is without a digit or one of these.
_HINT = re.compile(r"[0-9@:=]")


class Feistel:
    """Keyed permutations of range(n), one for each tweak."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _f(self, tweak: bytes, i: int, half: bytes, size: int) -> bytes:
        """``size`` keyed bytes, all of them set by the whole of ``half``."""
        d = hashlib.blake2b(half, key=self.key, person=bytes([i]), salt=hashlib.blake2b(tweak, digest_size=16).digest()).digest()
        return d[:size] if size <= len(d) else hashlib.shake_256(d).digest(size)

    def _bits(self, tweak: bytes, i: int, half: int, bits: int) -> int:
        d = self._f(tweak, i, half.to_bytes((bits + 7) // 8 or 1, "big"), (bits + 7) // 8 + 8)
        return int.from_bytes(d, "big") & ((1 << bits) - 1)

    def shift(self, digits: np.ndarray, radix: np.ndarray, tweak: bytes, back: bool = False) -> np.ndarray:
        """The image of ``digits``, each below its ``radix``: an alternating
        network whose halves are shifted by keyed streams."""
        cut = len(digits) // 2
        parts = [slice(0, cut), slice(cut, None)]
        out = digits.copy()
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            here, other = parts[i % 2], parts[1 - i % 2]
            stream = np.frombuffer(self._f(tweak, i, out[other].astype(np.uint8).tobytes(), 8 * len(out[here])), np.uint64)
            step = (stream % radix[here].astype(np.uint64)).astype(np.int64)
            out[here] = (out[here] - step if back else out[here] + step) % radix[here]
        return out

    def permute(self, x: int, n: int, tweak: bytes, keeps: Callable[[int], bool] | None = None, back: bool = False) -> int:
        """The image of x in range(n); ``keeps`` narrows the range to what it
        is true of, x included."""
        if n < 2:
            return x
        half = max(1, ((n - 1).bit_length() + 1) // 2)
        mask = (1 << half) - 1
        tweak = tweak + b"|%d" % n
        while True:
            a, b = x >> half, x & mask
            for i in range(ROUNDS):
                if back:
                    a, b = b ^ self._bits(tweak, ROUNDS - 1 - i, a, half), a
                else:
                    a, b = b, a ^ self._bits(tweak, i, b, half)
            x = a << half | b
            if x < n and (keeps is None or keeps(x)):
                return x


def luhn(digits: str) -> int:
    """The check digit that belongs behind ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


_ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER_HEX, _UPPER_HEX = "0123456789abcdef", "0123456789ABCDEF"


def _refill(value: str, new: Iterator[str]) -> str:
    """``value`` with its ASCII digits replaced one by one."""
    return "".join(next(new) if c in _ALPHABETS[0] else c for c in value)


class Pseudonyms:
    """Replaces values; with ``back`` it restores them."""

    def __init__(self, key: bytes, back: bool = False):
        self.cipher, self.back = Feistel(key), back
        self.known: dict[tuple[str, str], str | None] = {}

    def _digits(self, digits: str, tweak: bytes, keeps=None) -> str:
        n = len(digits)
        made = self.cipher.permute(int(digits), 10**n, tweak, keeps and (lambda x: keeps(f"{x:0{n}}")), self.back)
        return f"{made:0{n}}"

    def _letters(self, value: str, tweak: bytes, hexes: str = "") -> str:
        """Digits, letters and capitals each stay of their kind; ``hexes``:
        every character is one of these, and some letter among them stays."""
        kinds = [hexes or next((a for a in _ALPHABETS if c in a), "") for c in value]
        tweak += bytes(len(a) for a in kinds)
        if len(value) > LONG:
            return self._shifted(value, kinds, tweak, hexes)
        n, x = 1, 0
        for c, a in zip(value, kinds):
            if a:
                n, x = n * len(a), x * len(a) + a.index(c)
        letter = (lambda y: any(c in "abcdef" for c in f"{y:x}")) if hexes else None
        x = self.cipher.permute(x, n, tweak, letter, self.back)
        out = []
        for c, a in zip(reversed(value), reversed(kinds)):
            if a:
                x, k = divmod(x, len(a))
                c = a[k]
            out.append(c)
        return "".join(reversed(out))

    def _shifted(self, value: str, kinds: list[str], tweak: bytes, hexes: str) -> str:
        at = [k for k, a in enumerate(kinds) if a]
        radix = np.array([len(kinds[k]) for k in at], np.int64)
        digits = np.array([kinds[k].index(value[k]) for k in at], np.int64)
        while True:
            digits = self.cipher.shift(digits, radix, tweak, self.back)
            if not hexes or (digits > 9).any():
                break
        out = list(value)
        for k, d in zip(at, digits.tolist()):
            out[k] = kinds[k][d]
        return "".join(out)

    def secret(self, v: str) -> str | None:
        if not any(c in _ALPHABETS[0] for c in v):
            return None
        hexes = next((h for h in (_LOWER_HEX, _UPPER_HEX) if len(v) >= 16 and all(c in h for c in v) and not v.isdigit()), "")
        return self._letters(v, b"secret", hexes)

    def email(self, v: str) -> str | None:
        local, _, domain = v.partition("@")
        if ".." in v or local.endswith("."):
            return None
        name, _, top = domain.rpartition(".")
        return self._letters(f"{local}@{name}", b"email") + "." + top

    def iban(self, v: str) -> str | None:
        plain = v.replace(" ", "")
        if not 15 <= len(plain) <= 34 or _mod97(plain) != 1:
            return None
        body = self._letters(plain[4:], b"iban" + plain[:2].encode())
        check = 98 - _mod97(plain[:2] + "00" + body)
        new = iter(f"{plain[:2]}{check:02}{body}")
        return "".join(c if c == " " else next(new) for c in v)

    def ipv4(self, v: str) -> str | None:
        octets = v.split(".")
        if any(int(o) > 255 or o != str(int(o)) for o in octets):
            return None
        x = int.from_bytes(bytes(map(int, octets)), "big")
        return ".".join(map(str, self.cipher.permute(x, 1 << 32, b"ipv4", None, self.back).to_bytes(4, "big")))

    def date(self, v: str) -> str | None:
        sep = next(c for c in v if c in "-/.")
        parts = v.split(sep)
        ymd = len(parts[0]) == 4
        year, rest = (parts[0], parts[1:]) if ymd else (parts[2], parts[:2])
        # Day first with dots, or where the first number is no month.
        day_first = not ymd and (sep == "." or int(rest[0]) > 12)
        month, day = (rest[1], rest[0]) if day_first else (rest[0], rest[1])
        try:
            d = datetime.date(int(year), int(month), int(day))
        except ValueError:
            return None
        first = datetime.date(1900, 1, 1)
        wide = all(len(p) == 2 for p in rest)
        if not wide and any(len(p) == 2 and p[0] == "0" for p in rest):
            return None

        def write(x: int) -> str:
            t = first + datetime.timedelta(x)
            m, k = (f"{t.month:02}", f"{t.day:02}") if wide else (str(t.month), str(t.day))
            return sep.join([str(t.year), m, k] if ymd else [k, m, str(t.year)] if day_first else [m, k, str(t.year)])

        def same_format(x: int) -> bool:
            t = first + datetime.timedelta(x)
            if not wide and t.month > 9 and t.day > 9:
                return False  # it would read as a date with padded numbers
            return ymd or sep == "." or (t.day > 12) == day_first or (not day_first)

        days = (datetime.date(2100, 1, 1) - first).days
        tweak = b"date" + bytes([wide, ymd, day_first and sep != "."])
        return write(self.cipher.permute((d - first).days, days, tweak, same_format, self.back))

    def ssn(self, v: str) -> str | None:
        ok = lambda s: s[:3] not in ("000", "666") and s[0] != "9" and s[3:5] != "00" and s[5:] != "0000"
        plain = v.replace("-", "")
        return _refill(v, iter(self._digits(plain, b"ssn", ok))) if ok(plain) else None

    def card(self, v: str) -> str | None:
        plain = re.sub(r"[ \-]", "", v)
        if luhn(plain[:-1]) != int(plain[-1]) or not int(plain):
            return None
        body = self._digits(plain[:-1], b"card", lambda s: s.strip("0") != "")
        return _refill(v, iter(f"{body}{luhn(body)}"))

    def phone(self, v: str) -> str | None:
        plain = re.sub(r"[^0-9]", "", v)
        if not 8 <= len(plain) <= 15:
            return None
        fixed = 0
        if v[0] == "+":  # the country code stays, of one digit or two
            fixed = 1 if plain[0] in "17" else 2
        return _refill(v, iter(plain[:fixed] + self._digits(plain[fixed:], b"phone" + plain[:fixed].encode())))

    def of(self, kind: str, value: str) -> str | None:
        """The pseudonym, or None where the value does not validate."""
        if (kind, value) not in self.known:
            if len(self.known) >= CACHE_VALUES:
                self.known.clear()
            self.known[kind, value] = getattr(self, kind)(value)
        return self.known[kind, value]

    def replace(self, text: str) -> tuple[str, list[tuple[str, int, int]]]:
        """The text with pseudonyms, and (kind, start, end) of each in it, in
        code points."""
        if not _HINT.search(text):
            return text, []
        out, spans, at, size = [], [], 0, 0
        pos = 0
        while (m := _PATTERN.search(text, pos)) is not None:
            kind = next(k for k in KINDS if m[k] is not None)
            lo, hi = m.span("value") if kind == "secret" else m.span()
            new = self.of(kind, text[lo:hi])
            if new is None:
                # What follows the first number may be a value of its own.
                pos = self._past(text, m.start(), m.end())
                continue
            out += [text[at:lo], new]
            size += lo - at
            spans.append((kind, size, size + len(new)))
            size += len(new)
            at = pos = hi
        return "".join([*out, text[at:]]), spans

    @staticmethod
    def _past(text: str, lo: int, hi: int) -> int:
        k = lo + 1
        while k < hi and (text[k].isalnum() and text[k - 1].isalnum()):
            k += 1
        return max(k, lo + 1)


def session_key(spark: SparkSession) -> bytes:
    """The key that the session's settings name."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        raise ValueError(f"no key for pseudonyms: pass one or set {KEY_SETTING}")
    return key.encode()


def pseudonymize(df: DataFrame, text: str = "text", key: bytes | None = None, back: bool = False, spans: str | None = "spans") -> DataFrame:
    """All columns with the text replaced, and ``spans``: an array of (kind,
    start, end) of the pseudonyms in the new text."""
    key = key or session_key(df.sparkSession)
    names = others(df, spans) if spans else df.columns
    df, at = df.select(*names), names.index(text)
    span = pa.list_(pa.struct([("kind", pa.string()), ("from", pa.int32()), ("to", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Pseudonyms(key, back)
        for b in batches:
            for i in range(0, len(b), 1_000):
                part = b.slice(i, 1_000)
                made = [(None, []) if t is None else own.replace(t) for t in part.column(at).to_pylist()]
                cols = list(part.columns)
                cols[at] = pa.array([m[0] for m in made], pa.string())
                found = pa.array([[dict(zip(("kind", "from", "to"), s)) for s in m[1]] for m in made], span)
                yield pa.RecordBatch.from_arrays([*cols, found], names=[*(f"k{k}" for k in range(len(names))), "spans"])

    given = df.toDF(*(f"k{k}" for k in range(len(names))))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in given.schema] + [T.StructField("spans", T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("from", T.IntegerType()), T.StructField("to", T.IntegerType())])))])
    out = given.mapInArrow(run, schema)
    return out.toDF(*names, spans) if spans else out.drop("spans").toDF(*names)


def span_counts(df: DataFrame, spans: str = "spans") -> DataFrame:
    """One long column n_<kind> for each kind, in place of the spans."""
    def count(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    return df.withColumns({f"n_{kind}": count(kind) for kind in KINDS}).drop(spans)
