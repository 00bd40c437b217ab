"""Surrogates for personal data.

Entities are found by patterns and replaced by keyed surrogates of their own kind. A surrogate keeps the format: length,
separators, letter case, script, vowels and consonants, the country code of a phone number, the first digit and checksum
state of a card number, the private or public range of an address, the title and the last letter of a name (which carry
its gender). Parts that say who belongs together, an address's domain or a person's family name, are replaced alike
wherever they occur, and spellings that differ in separators or case are one entity.

A name is found behind a title or another cue (a line of a sender, a closing, "my name is"); all further mentions of it
or of its parts in that text are names, too.

Within one shape the replacement is a permutation under the key without fixed points, so different entities stay
different and the same one stays the same in all documents without a table of them. ``collisions`` checks that over the
entities of a corpus; ``redrawn`` draws again for those it finds.

Defined cases: NULL stays NULL; a text without entities is returned as it is. Where matches overlap, the earlier and then
the longer one counts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlantern.llm.common import stored

RESULT = "text string, entities array<struct<kind: string, start: int, end: int>>"
ROUNDS = 8

# Letters by script and sound. A letter is replaced by one of its own line.
ALPHABETS = (
    "0123456789",
    "aeiou",
    "bcdfghjklmnpqrstvwxyz",
    "àáâäãåæèéêëìíîïòóôöõøœùúûü",
    "çñšžýÿ",
    "аеёиоуыэюя",
    "бвгджзйклмнпрстфхцчшщ",
    "αεηιουω",
    "βγδζθκλμνξπρστφχψ",
)
LETTER = {c: a for a in ALPHABETS for c in a}
HEX = "0123456789abcdef"

# Titles before a name.
TITLES = "Mr Mrs Ms Miss Dr Prof Sir Lady Herr Frau Monsieur Madame Mme Mlle Señor Señora Sr Sra Don Doña".split()

# Country codes of one and of two digits; the others have three.
CODE = re.compile(r"[17]|2[07]|3[0123469]|4[013456789]|5[12345678]|6[0123456]|8[1246]|9[0123458]|\d{3}")

_UPPER = "A-ZÀ-ÖØ-ÞА-ЯΑ-Ω"
_NAME = rf"[{_UPPER}][^\W\d_]+(?:[-'’][{_UPPER}][^\W\d_]+)*"
PATTERNS = {
    "email": re.compile(r"(?<![\w.+-])[\w.+-]*\w@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    "ip": re.compile(r"(?<![\w.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?!\w|\.\d)", re.ASCII),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)", re.ASCII),
    "card": re.compile(r"(?<!\w)(?<!\d[.-])\d(?:[ -]?\d){12,18}(?!\w)", re.ASCII),
    "ssn": re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", re.ASCII),
    "phone": re.compile(
        r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,5}\)[ .-]?|\d{2,5}[ .-])\d{3,4}[ .-]\d{3,5}(?!\w)|(?<!\w)\+\d{8,14}(?!\w)",
        re.ASCII,
    ),
    "secret": re.compile(r"(?<!\w)(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?!\w)"),
    "name": re.compile(rf"(?<!\w)(?:{'|'.join(TITLES)})\.?[  ](?P<name>{_NAME}(?: {_NAME}){{0,2}})"),
}
# Cues of a name besides titles, each with a word that has to be in the text.
CUES = [
    (word, re.compile(rf"{cue}(?P<name>{_NAME}(?: {_NAME}){{0,2}})", re.MULTILINE))
    for word, cue in (
        ("name is ", r"(?<!\w)[Mm]y name is "),
        ("From:", r"^From:[ \t]*\"?"),
        *((w, rf"(?<!\w){w}[^\S\n]*[,.!]?[^\S\n]*\n\s*") for w in "regards Regards wishes Sincerely sincerely truly faithfully Cheers Grüßen Cordialement Saludos".split()),
    )
]
_CAPITAL = re.compile(rf"(?<![^\W_])[{_UPPER}][^\W\d_]+(?![^\W_])")
# Words that a sentence starts with, no names when they stand alone.
PLAIN = frozenset(
    "the a an and or but if in on at of to for from by with as is was it he she we they you his her its this that these those "
    "then there when who what how not no yes so my our your der die das und ein eine ich er sie es wir le la les un une et je il "
    "elle nous el los las y yo".split()
)


class Permutation:
    """A keyed permutation of 0 .. n-1 without fixed points: a step along a cycle through all numbers in a secret
    order. Numbers are split in two for a network of keyed rounds, and walk on until they are below n."""

    def __init__(self, key: bytes, purpose: str, n: int) -> None:
        self.key, self.purpose, self.n = hashlib.blake2b(key, digest_size=32).digest(), purpose.encode(), n
        self.low = 1 << ((n - 1).bit_length() + 1) // 2
        self.high = max(1, -(-n // self.low))
        self.step = 1 + self._hash(b"step", 0) % max(n - 1, 1)

    def _hash(self, name: bytes, x: int) -> int:
        data = self.purpose + b"\0" + name + b"\0" + x.to_bytes(80, "big")
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=64).digest(), "big")

    def _walk(self, x: int, sign: int) -> int:
        while True:
            top, rest = divmod(x, self.low)
            for i in range(ROUNDS)[::sign]:
                name = b"%d" % i
                if i % 2:
                    rest = (rest + sign * self._hash(name, top)) % self.low
                else:
                    top = (top + sign * self._hash(name, rest)) % self.high
            x = top * self.low + rest
            if x < self.n:
                return x

    def __call__(self, x: int) -> int:
        return self._walk((self._walk(x, 1) + self.step) % self.n, -1) if self.n > 1 else x


@lru_cache(maxsize=4096)
def _permutation(key: bytes, purpose: str, n: int) -> Permutation:
    return Permutation(key, purpose, n)


def permuted(key: bytes, purpose: str, text: str, alphabets: list[str], accept: Callable[[str], bool] | None = None) -> str:
    """``text`` with every character replaced within its alphabet ("" keeps it); all texts of the same alphabets are
    permuted among each other, and only among those that ``accept`` judges alike."""
    n = 1
    for a in alphabets:
        n *= len(a) or 1
    shape = "\1".join(a or c for c, a in zip(text, alphabets, strict=True))
    turn, x = _permutation(key, f"{purpose}\0{shape}", n), 0
    for c, a in zip(text, alphabets, strict=True):
        x = x * len(a) + a.index(c) if a else x
    wanted = accept(text) if accept else None
    while True:
        x = turn(x)
        rest, found = x, []
        for c, a in zip(text[::-1], alphabets[::-1], strict=True):
            rest, at = divmod(rest, len(a)) if a else (rest, 0)
            found.append(a[at] if a else c)
        made = "".join(found[::-1])
        if accept is None or accept(made) == wanted:
            return made


def _letters(text: str) -> list[str]:
    return [LETTER.get(c, "") for c in text]


def _lower(text: str) -> str:
    """Lower case character by character, whatever stands beside it."""
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in text).replace("ς", "σ")


def _cased(pattern: str, text: str) -> str:
    return "".join("ς" if p == "ς" and t == "σ" else t.upper() if p.isupper() and len(t.upper()) == 1 else t for p, t in zip(pattern, text, strict=True))


def _word(key: bytes, purpose: str, text: str, keep_last: bool = False) -> str:
    """A word of the same letters' classes; of a name the last letter stays if others are left to change."""
    low = _lower(text)
    alphabets = _letters(low)
    if keep_last and sum(map(bool, alphabets)) > 1:
        alphabets[-1] = ""
    return _cased(text, permuted(key, purpose, low, alphabets))


def luhn(digits: str) -> bool:
    double = [2 * int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(d - 9 if d > 9 else d for d in double)) % 10 == 0


def _refill(pattern: str, digits: str) -> str:
    """``pattern`` with its digits replaced one by one."""
    source = iter(digits)
    return "".join(next(source) if c.isdigit() else c for c in pattern)


def _private(address: str) -> tuple[bool, ...]:
    a, b = map(int, address.split(".")[:2])
    return (a == 10 or (a, b) == (192, 168) or (a == 172 and 16 <= b < 32), a == 127, a >= 224, a == 0)


def _address(key: bytes, text: str) -> str:
    parts = [int(p) for p in text.split(".")]
    text = ".".join(map(str, parts))
    x = int.from_bytes(bytes(parts), "big")
    kind, turn = _private(text), _permutation(key, "ip", 1 << 32)
    if kind[0]:  # within its own private block, which is small
        bits = 24 if parts[0] == 10 else 20 if parts[0] == 172 else 16
        y = (x >> bits << bits) + _permutation(key, f"ip/{bits}", 1 << bits)(x & ((1 << bits) - 1))
        return ".".join(map(str, y.to_bytes(4, "big")))
    while True:
        x = turn(x)
        found = ".".join(map(str, x.to_bytes(4, "big")))
        if _private(found) == kind:
            return found


def surrogate(key: bytes, kind: str, text: str) -> str:
    """The replacement of one entity."""
    digits = "".join(c for c in text if c.isdigit())
    if kind == "email":
        local, _, domain = text.rpartition("@")
        host, _, top = domain.lower().rpartition(".")
        return f"{_word(key, 'local', local)}@{_cased(domain, _word(key, 'host', host) + '.' + top)}"
    if kind == "ip":
        return _address(key, text)
    if kind == "card":
        alphabets = ["", *[ALPHABETS[0]] * (len(digits) - 1)]
        return _refill(text, permuted(key, "card", digits, alphabets, luhn))
    if kind == "ssn":
        return _refill(text, permuted(key, "ssn", digits, [ALPHABETS[0]] * 9))
    if kind == "phone":
        fixed = CODE.match(digits).end() if text[0] == "+" else 0
        return _refill(text, permuted(key, "phone+" * (text[0] == "+"), digits, [""] * fixed + [ALPHABETS[0]] * (len(digits) - fixed)))
    if kind == "secret":
        return _cased(text, permuted(key, "secret", text.lower(), [HEX] * len(text))) if not text.isupper() else permuted(key, "secret", text.lower(), [HEX] * len(text)).upper()
    if kind == "iban":
        plain = text.replace(" ", "").lower()
        made = permuted(key, "iban", plain, ["", "", *_letters(plain[2:])])
        source = iter(made.upper())
        return "".join(c if c == " " else next(source) for c in text)
    words = re.split(r"([ '’-])", text)
    return "".join(w if len(w) < 2 else _word(key, "name", w, keep_last=True) for w in words)


def _mentions(text: str, names: set[str]) -> list[tuple[int, int]]:
    """Where words of ``names`` stand with a capital letter, those side by side as one."""
    found: list[tuple[int, int]] = []
    for m in _CAPITAL.finditer(text):
        if _lower(m.group()) in names:
            if found and m.start() - found[-1][1] == 1 and text[m.start() - 1] in " '’-":
                found[-1] = (found[-1][0], m.end())
            else:
                found.append(m.span())
    return found


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the entities, none overlapping."""
    hits = []
    for kind, pattern in PATTERNS.items():
        if kind == "email" and "@" not in text:
            continue
        group = "name" if kind == "name" else 0
        hits += [(m.start(group), -m.end(group), i, kind) for i, m in enumerate(pattern.finditer(text))]
    for word, pattern in CUES:
        if word in text:
            hits += [(m.start("name"), -m.end("name"), i, "name") for i, m in enumerate(pattern.finditer(text))]
    names = {w for a, b, _, kind in hits if kind == "name" for w in re.split(r"[ '’-]", _lower(text[a:-b]))}
    names = {w for w in names if len(w) > 1} - PLAIN
    if names:
        parts, at = [], 0  # the text without the entities of other kinds
        for start, stop in sorted((a, -b) for a, b, _, kind in hits if kind != "name"):
            parts += [text[at:start], "\0" * (stop - max(at, start))]
            at = max(at, stop)
        hits += [(a, -b, 0, "name") for a, b in _mentions("".join([*parts, text[at:]]), names)]
    found, reach = [], 0
    for start, stop, _, kind in sorted(hits):
        if start >= reach:
            found.append((start, -stop, kind))
            reach = -stop
    return found


def canonical(kind: str, text: str) -> str:
    """One spelling for all spellings of an entity."""
    if kind == "phone":
        return "+" * (text[0] == "+") + "".join(c for c in text if c.isdigit())
    if kind in ("card", "ssn"):
        return "".join(c for c in text if c.isdigit())
    if kind == "ip":
        return ".".join(str(int(p)) for p in text.split("."))
    return text.replace(" ", "").lower() if kind == "iban" else _lower(text)


def drawn(key: bytes, kind: str, text: str, again: dict[tuple[str, str], int]) -> str:
    """The replacement of one entity, by another key if ``again`` has how often it was drawn again. What its format
    leaves as it is gets letters of a keyed word."""
    times = again.get((kind, canonical(kind, text)), 0)
    if not times:
        return surrogate(key, kind, text)
    other = hashlib.blake2b(b"again %d" % times, key=hashlib.blake2b(key, digest_size=32).digest()).digest()
    made = surrogate(other, kind, text)
    if canonical(kind, made) != canonical(kind, text):
        return made
    word = hashlib.blake2b(canonical(kind, text).encode(), key=other[:32]).digest()
    source = iter("".join(ALPHABETS[2 - i % 2][b % len(ALPHABETS[2 - i % 2])] for i, b in enumerate(word)) * (1 + len(text) // 64))
    return _cased(text, "".join(next(source) if c.isalnum() else c for c in text))


def replace(key: bytes, text: str, again: dict[tuple[str, str], int] | None = None) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with surrogates, and where they stand in it."""
    parts, spans, at, length = [], [], 0, 0
    for start, stop, kind in find(text):
        made = drawn(key, kind, text[start:stop], again or {})
        parts += [text[at:start], made]
        length += start - at
        spans.append((length, length + len(made), kind))
        length, at = length + len(made), stop
    return "".join([*parts, text[at:]]) if parts else text, spans


def replaced(text: str, key: bytes, again: dict[tuple[str, str], int] | None = None) -> Column:
    """A struct column: the text with surrogates, and the kind and place of each; ``again`` is of ``redrawn``."""

    @F.pandas_udf(RESULT)
    def apply(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = [(None, []) if t is None else replace(key, t, again) for t in part]
            spans = [[{"kind": k, "start": a, "end": b} for a, b, k in s] for _, s in rows]
            yield pd.DataFrame({"text": [t for t, _ in rows], "entities": spans})

    return apply(F.col(text))


def entities(docs: DataFrame, key: bytes) -> DataFrame:
    """The distinct (kind, entity, surrogate) of ``docs`` (text), in one spelling each."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for text in batch["text"].to_pylist():
                for start, stop, kind in find(text or ""):
                    own = text[start:stop]
                    found.add((kind, canonical(kind, own), canonical(kind, surrogate(key, kind, own))))
            columns = zip(*sorted(found), strict=True) if found else [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["kind", "entity", "surrogate"])

    return docs.select("text").mapInArrow(read, "kind string, entity string, surrogate string").distinct()


def collisions(found: DataFrame) -> DataFrame:
    """What ``entities`` must not hold: a surrogate of two entities, an entity with two, or one that was not changed."""
    shared = found.groupBy("kind", "surrogate").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    split = found.groupBy("kind", "entity").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    same = found.where(F.col("entity") == F.col("surrogate")).groupBy("kind", "entity").agg(F.count("*").alias("n"))
    named = [t.withColumnRenamed(t.columns[1], "value").withColumn("fault", F.lit(f)) for t, f in ((shared, "shared"), (split, "split"), (same, "kept"))]
    return named[0].union(named[1]).union(named[2])


def redrawn(docs: DataFrame, key: bytes) -> dict[tuple[str, str], int]:
    """How often the entities of ``docs`` whose surrogates would not be distinct are drawn again until all are: few, as
    only those without a character to replace can be at fault. Of entities with one surrogate the first keeps it."""
    found = stored(entities(docs, key), "entities")
    again: dict[tuple[str, str], int] = {}
    while True:
        now = found
        if again:
            spark = docs.sparkSession
            rows = [(k, e, canonical(k, drawn(key, k, e, again))) for k, e in again]
            new = spark.createDataFrame(rows, "kind string, entity string, drawn string")
            now = found.join(new, ["kind", "entity"], "left").select("kind", "entity", F.coalesce("drawn", "surrogate").alias("surrogate"))
            now = stored(now.distinct(), "entities")
        faults = collisions(now)
        shared = now.join(faults.where(F.col("fault") == "shared").select("kind", F.col("value").alias("surrogate")), ["kind", "surrogate"])
        first = shared.groupBy("kind", "surrogate").agg(F.min("entity").alias("first"))
        shared = shared.join(first, ["kind", "surrogate"]).where(F.col("entity") != F.col("first")).select("kind", "entity")
        own = faults.where(F.col("fault") != "shared").select("kind", F.col("value").alias("entity"))
        todo = shared.union(own).distinct().collect()
        if not todo:
            return again
        for r in todo:
            again[r.kind, r.entity] = again.get((r.kind, r.entity), 0) + 1
