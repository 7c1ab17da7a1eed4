"""PII: keyed, type-consistent surrogates.

Detected: e-mail addresses, phone numbers, payment cards (Luhn), IBANs
(mod 97), social security numbers, IPv4 addresses, access keys, passwords
and tokens in assignments, and names after a title (and later bare mentions
of their parts in the same text).  An entity is its type and canonical form,
so mentions in other formats are the same entity everywhere.

A surrogate is drawn from HMAC-SHA256(key, type, canonical form, attempt)
and keeps the type: digits for digits with valid check digits, letters in
the same case and script, names of the same gender and script.  A value
without letters or digits (a masked password) becomes a longer run of
letters; a value whose like-sized surrogates run out gets longer ones from
attempt SAME_LENGTH on, so every entity finds one.  A
distributed check compares the surrogates of all entities of the corpus:
where two entities get one surrogate, or a surrogate is some real entity,
all but one draw again, until every entity has a surrogate of its own.
Mentions are then rendered in their own format.

Entities and their surrogates stay distributed; texts without entities are
not shuffled at all.

Defined cases: null text stays null; empty texts and texts without
entities stay as they are; null ids stay; repeated rows are replaced alike;
an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import hmac
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import spread, stage_table

# Titles by gender, and name syllables by script.
MALE = ("Mr", "Herr", "Señor", "Sr", "Monsieur", "M", "Don", "Sir", "г-н", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Doña", "г-жа", "Κυρία")
NEUTRAL = ("Dr", "Prof", "Mx")
SYLLABLES = {
    "latin": ("ba", "den", "fi", "gor", "ha", "jo", "kel", "li", "mar", "no", "pe", "ri", "sa",
              "tor", "vi", "wen"),
    "cyrillic": ("ба", "ве", "го", "ди", "ка", "ли", "ма", "но", "пе", "ро", "са", "ти"),
    "greek": ("βα", "γε", "δη", "κα", "λι", "μα", "νο", "πε", "ρο", "σα", "τη", "φι"),
}
ENDINGS = {"latin": ("n", "a", "e"), "cyrillic": ("н", "а", "о"), "greek": ("ς", "α", "ο")}

SAME_LENGTH = 12        # attempts at a surrogate of the entity's own length

_TITLES = "|".join(sorted(map(re.escape, MALE + FEMALE + NEUTRAL), key=len, reverse=True))
_NAME = r"[^\W\d_a-zß-öø-ÿα-ωа-я][^\W\d_]+(?:-[^\W\d_]+)?"
# type, what a text must hold for the pattern to be tried, pattern
PATTERNS = [
    ("email", "at", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")),
    ("secret", "key", re.compile(r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b")),
    ("secret", "assign", re.compile(r"(?i)\b(?:password|passwd|pwd|secret|token|api[_-]?key)\s*[=:]\s*[\"']?"
                          r"([^\s\"',;]{8,})")),
    ("iban", "digit", re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")),
    ("ipv4", "digit", re.compile(r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}"
                        r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])")),
    ("ssn", "digit", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")),
    ("card", "digit", re.compile(r"(?<![0-9-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9-])")),
    ("phone", "digit", re.compile(r"(?<![\w.])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])"
                         r"[0-9]{3}[ .-][0-9]{3,4}(?![\w-])")),
    ("phone", "digit", re.compile(r"(?<![\w.])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}(?![\w-])")),
]
_BEFORE = "([{\"'„“«¿¡,;:.!?/"   # marks that may stand right before a title
_NAMED = re.compile(rf"(?:^|(?<=[\s{re.escape(_BEFORE)}]))({_TITLES})\.? ({_NAME})(?: ({_NAME}))?")
_TITLE_SET = frozenset(MALE + FEMALE + NEUTRAL)
_DIGITS = b"0123456789"


def _holds(text: str) -> set[str]:
    """Cheap marks that keep most texts away from the patterns."""
    raw = text.encode("utf-8", "surrogatepass")
    out = set()
    if b"@" in raw:
        out.add("at")
    if b"AKIA" in raw or b"ASIA" in raw:
        out.add("key")
    if b"=" in raw or b":" in raw:
        out.add("assign")
    if len(raw.translate(None, _DIGITS)) != len(raw):
        out.add("digit")
    plain = text
    for mark in _BEFORE:
        if mark in plain:
            plain = plain.replace(mark, " ")
    if not _TITLE_SET.isdisjoint(plain.split()):
        out.add("title")
    return out


def luhn(digits: str) -> int:
    """The check sum; 0 for a valid number."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10


def mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def script(word: str) -> str:
    c = ord(word[0])
    return "cyrillic" if 0x400 <= c < 0x530 else "greek" if 0x370 <= c < 0x400 else "latin"


def canonical(kind: str, mention: str) -> str:
    if kind in ("phone", "card", "ssn"):
        return re.sub(r"\D", "", mention)
    if kind == "iban":
        return mention.replace(" ", "")
    return mention.lower() if kind == "email" else mention


def detect(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, type, canonical form), in order, without overlaps."""
    if not text:
        return []
    found = []
    holds = _holds(text)
    if not holds:
        return []
    for kind, needs, pattern in PATTERNS:
        if needs not in holds:
            continue
        for m in pattern.finditer(text):
            a, b = m.span(1) if m.re.groups else m.span()
            value = canonical(kind, text[a:b])
            if kind == "card" and luhn(value) or kind == "iban" and mod97(value) != 1:
                continue
            found.append((a, b, kind, value))
    parts: dict[str, str] = {}
    for m in _NAMED.finditer(text) if "title" in holds else ():
        gender = "m" if m[1] in MALE else "f" if m[1] in FEMALE else "n"
        if m[3]:
            parts[m[2]] = f"given-{gender}-{script(m[2])}"
            parts[m[3]] = f"family-{script(m[3])}"
        else:
            parts.setdefault(m[2], f"family-{script(m[2])}")
    if parts:
        bare = re.compile(r"(?<!\w)(" + "|".join(map(re.escape, parts)) + r")(?!\w)")
        found += [(*m.span(), parts[m[1]], m[1]) for m in bare.finditer(text)]
    # of overlapping mentions, the first of the earlier pattern stays
    out: list[tuple[int, int, str, str]] = []
    taken = bytearray(len(text) + 1)
    for a, b, kind, value in found:
        if not any(taken[a:b]):
            taken[a:b] = b"\1" * (b - a)
            out.append((a, b, kind, value))
    return sorted(out)


def _stream(key: bytes, kind: str, value: str, attempt: int) -> Iterator[int]:
    n = 0
    while True:
        message = f"{kind}\0{value}\0{attempt}\0{n}".encode("utf-8", "surrogatepass")
        yield from hmac.new(key, message, hashlib.sha256).digest()
        n += 1


ALPHABETS = ("abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщъыьэюя",
             "αβγδεζηθικλμνξοπρστυφχψω")


@functools.lru_cache(maxsize=65536)
def _pool(c: str) -> str:
    """The characters that may stand for ``c``: digits of its script, letters
    of its script and case, or nothing."""
    kind = unicodedata.category(c)
    if kind == "Nd":
        return "".join(chr(ord(c) - unicodedata.digit(c) + d) for d in range(10))
    if kind[0] not in "LN":
        return ""
    name = unicodedata.name(c, "").split(" ")[0]
    if name in ("LATIN", "CYRILLIC", "GREEK") and kind in ("Lu", "Ll"):
        letters = ALPHABETS[("LATIN", "CYRILLIC", "GREEK").index(name)]
        return letters.upper() if kind == "Lu" else letters
    page = ord(c) & ~0xFF
    like = "".join(x for x in map(chr, range(page, page + 256)) if unicodedata.category(x) == kind
                   and unicodedata.name(x, "").split(" ")[0] == name)
    return like if len(like) > 1 else "0123456789" if kind[0] == "N" else ALPHABETS[0]


def _like(text: str, stream: Iterator[int]) -> str:
    """Digits for digits, letters for letters of the same script and case; rest kept."""
    out = []
    for c in text:
        pool = _pool(c)
        out.append(pool[next(stream) % len(pool)] if pool else c)
    return "".join(out)


def _letters(n: int, stream: Iterator[int]) -> str:
    return _like("a" * n, stream)


def surrogate(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """The canonical form of an entity's surrogate at this attempt."""
    s = _stream(key, kind, value, attempt)
    more = max(0, attempt - SAME_LENGTH + 1)     # characters past the entity's own length
    if kind == "email":
        local, _, domain = value.rpartition("@")
        host, _, top = domain.rpartition(".")
        more += not any(map(_pool, local + host))
        return f"{_like(local, s)}{_letters(more, s)}@{_like(host, s)}.{top}"
    if kind == "ipv4":
        return ".".join(str(1 + next(s) % 254) for _ in range(4 + more))
    if kind == "card":
        body = value[0] + _like(value[1:-1] + "0" * more, s)
        return body + str(next(d for d in range(10) if luhn(body + str(d)) == 0))
    if kind == "iban":
        body = _like(value[4:] + "0" * more, s)
        return f"{value[:2]}{98 - mod97(value[:2] + '00' + body):02d}{body}"
    if kind == "secret" and value[:4] in ("AKIA", "ASIA"):
        return value[:4] + _like(value[4:] + "A" * more, s)
    if kind == "secret" and re.fullmatch("[0-9a-f]+", value):
        return "".join("0123456789abcdef"[next(s) % 16] for _ in range(len(value) + more))
    if kind.startswith(("given", "family")):
        letters = kind.rpartition("-")[2]
        pool = SYLLABLES[letters]
        end = ENDINGS[letters]["mfn".index(kind.split("-")[1]) if kind.startswith("given") else 0]
        n = 2 + attempt // 4 + next(s) % 2
        return ("".join(pool[next(s) % len(pool)] for _ in range(n)) + end).capitalize()
    if kind == "secret":
        if not any(map(_pool, value)):
            return _letters(len(value) + 1 + more, s)
        return _like(value, s) + _letters(more, s)
    if kind == "phone" and len(value) > 10:
        return value[:-10] + _like(value[-10:] + "0" * more, s)
    return _like(value + "0" * more, s)


def render(kind: str, mention: str, new: str) -> str:
    """The surrogate in the mention's format."""
    if kind in ("phone", "card", "ssn"):
        digits = iter(new)
        return "".join(next(digits, "0") if c.isdigit() else c for c in mention) + "".join(digits)
    if kind == "iban":
        chars = iter(new)
        return "".join(c if c == " " else next(chars) for c in mention) + "".join(chars)
    if kind == "email":
        return "".join(n.upper() if o.isupper() else n for o, n in zip(mention, new)) + \
            new[len(mention):]
    return new


def resolve(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, surrogate), distinct per kind and never a real entity."""
    entities = stage_table(entities.select("kind", "value").distinct(), "entities")

    def draw(attempt: int):
        @F.pandas_udf("string")
        def run(kind: pd.Series, value: pd.Series) -> pd.Series:
            return pd.Series([surrogate(key, k, v, attempt) for k, v in zip(kind, value)],
                             dtype=object)
        return run

    real = entities.select("kind", F.col("value").alias("surrogate"))
    left, done, attempt = entities, None, 0
    while True:
        drawn = stage_table(left.withColumn("surrogate", draw(attempt)("kind", "value")), "drawn")
        best = drawn.groupBy("kind", "surrogate").agg(F.min("value").alias("value"))
        free = best.join(real, ["kind", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        free = stage_table(free.select("kind", "value", "surrogate"), "surrogates")
        done = free if done is None else done.unionByName(free)
        left = stage_table(left.join(free, ["kind", "value"], "left_anti"), "undecided")
        if left.isEmpty():
            return done
        attempt += 1


def replace_entities(docs: DataFrame, key: bytes, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """doc_id, text (with surrogates), n_entities, changed per document."""
    rows = spread(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                              F.col(text_col).alias("text")))

    def split(want: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                got = [detect(t) for t in batch.column(1).to_pylist()]
                keep = pa.array([bool(g) == want for g in got])
                part = batch.filter(keep)
                if want:
                    part = part.append_column("kinds", pa.array(
                        [[e[2] for e in g] for g in got if g], pa.list_(pa.string())))
                    part = part.append_column("entities", pa.array(
                        [[e[3] for e in g] for g in got if g], pa.list_(pa.string())))
                yield part
        return run

    hit = rows.mapInArrow(split(True), "doc_id long, text string, kinds array<string>, "
                                       "entities array<string>")
    hit = stage_table(hit.withColumn("row", F.monotonically_increasing_id()), "pii-texts")
    mentions = hit.select("row", F.explode(F.arrays_zip("kinds", "entities")).alias("e")).select(
        "row", F.col("e.kinds").alias("kind"), F.col("e.entities").alias("value")).distinct()
    mentions = stage_table(mentions, "mentions")
    names = mentions.join(resolve(mentions, key), ["kind", "value"]).groupBy("row").agg(
        F.collect_list(F.struct("kind", "value", "surrogate")).alias("names"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            for text, names in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                new = {(n["kind"], n["value"]): n["surrogate"] for n in names}
                out, at, n = [], 0, 0
                for a, b, kind, value in detect(text):
                    out += [text[at:a], render(kind, text[a:b], new[kind, value])]
                    at, n = b, n + 1
                texts.append("".join(out) + text[at:])
                counts.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int32())],
                names=["doc_id", "text", "n_entities"])

    changed = hit.join(names, "row").select("doc_id", "text", "names").mapInArrow(
        put, "doc_id long, text string, n_entities int").withColumn("changed", F.lit(True))
    same = rows.mapInArrow(split(False), "doc_id long, text string").withColumn(
        "n_entities", F.lit(0)).withColumn("changed", F.lit(False))
    return changed.unionByName(same)
