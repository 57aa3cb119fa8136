"""Operator 9: surrogates for personal data.

Detected entities are replaced by keyed surrogates of the same type: digits stand for digits, letters for letters of the
same script and case, and punctuation stays; card numbers keep whether their check digit holds, telephone numbers their
country code, mail addresses their top-level domain, and names get names of the same gender and script (from lists for Latin
and Cyrillic, of letters of the script for others). A surrogate is an HMAC of the entity's canonical form, so that all
mentions of an entity, however formatted, agree in all documents. A name that a title shows to be one is replaced wherever its
words stand in the same document, with or without a title.

Every pattern starts only where a run of its characters starts or has a bounded length, so that the time grows with the text's
length, also for a text that is one run of letters or digits.

Distinctness: the distinct entities of all documents are gathered, and a surrogate that two entities of a type share, or
that is itself an entity of the documents, is drawn anew (with the next attempt number) for all but the first. Names
grow with the attempt. What still collides after RANDOM_DRAWS attempts is given a free value of its format: the attempt is
then RANDOM_DRAWS and the value's place in a keyed order of all values of the format, after which come those with
one more character, then two, so that there is always one. What
the documents need to know besides the key is the attempt of these few entities: they are broadcast while at most
EXCEPTIONS_BROADCAST, and joined to the documents that mention them beyond that.

Defined results: null and empty texts and texts without entities stay as they are; in a changed text n_chars, where there
is such an integer column, is its new number of code points; other columns, null doc_ids and repeated rows stay; an
empty table gives an empty result."""

from __future__ import annotations

import hashlib
import hmac
import itertools
import math
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

#: Entities with a redrawn surrogate that are broadcast; more are joined.
EXCEPTIONS_BROADCAST = 100_000
#: Draws at random; later ones of types other than names are the free values of the format in order.
RANDOM_DRAWS = 12
#: Values of a format that are tried first, besides as many as there are entities; twice as many in each further round.
TRIED = 16

#: Titles before a name, by gender.
TITLES = {"m": ("Mr", "Herr", "Herrn", "Monsieur", "Señor", "Signor", "господин"),
          "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mademoiselle", "Señora", "Señorita", "Signora", "госпожа"),
          "n": ("Dr", "Prof")}
#: Given names by script and gender.
GIVEN = {"latin": {"m": "Adam Albert Bruno Carl Daniel David Edgar Felix George Henry Ivan Jacob Karl Leo Martin Noah "
                        "Oscar Paul Robert Simon Thomas Victor Walter Xavier".split(),
                   "f": "Ada Alice Bella Clara Diana Emma Fiona Grace Helen Irene Julia Karin Laura Maria Nora Olivia "
                        "Paula Rosa Sarah Teresa Ursula Vera Wanda Zoe".split()},
         "cyrillic": {"m": "Алексей Борис Виктор Григорий Дмитрий Егор Иван Кирилл Михаил Николай Павел Сергей".split(),
                      "f": "Алла Вера Галина Дарья Елена Зоя Ирина Ксения Мария Нина Ольга Татьяна".split()}}
SYLLABLES = {"latin": "ba be bo da de do fa fe ka ke ko la le lo ma me mo na ne no ra re ro sa se so ta te to va".split(),
             "cyrillic": "ба бе бо ва ве во да де до ка ке ко ла ле ло ма ме мо на не но ра ре ро са се со та те".split()}

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_TITLE = "|".join(t for k in TITLES.values() for t in sorted(k, key=len, reverse=True))
#: A word that may be a name or part of one.
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")
_NAME = r"[^\W\d_a-zа-яà-ÿ][^\W\d_]+(?:-[^\W\d_]+)?"
ENTITY = re.compile("|".join((
    r"(?P<email>(?<![\w.%+-])[\w.%+-]+@(?:[\w-]+\.)+[^\W\d_]{2,})",
    r"(?i:\b(?:token|key|secret|password|passwd|api[_-]?key)[\"']?\s*[=:]\s*[\"'](?P<secret>[\w+/=.-]{8,})[\"'])",
    r"(?P<hex>\b[0-9a-f]{32,128}\b|\b[0-9A-F]{32,128}\b)",
    rf"(?P<ip>(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\w]|\.\d))",
    r"(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))",
    r"(?P<phone>(?<!\w)(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\w)"
    r"|(?<!\w)\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\w)|(?<![\w.-])(?<!\d )\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-]| \d))",
    r"(?P<card>(?<![\w-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-]))",
    rf"(?:(?<!\w)(?P<title>{_TITLE})\.? (?P<name>{_NAME}(?: {_NAME})?))")))

_HINT = np.zeros(256, bool)
_HINT[ord("@")] = _HINT[0x30:0x3A] = True
_SPACE = rb"[\s\x1c-\x1f\x80-\xff]*[\"']"
_DIGITS = [c.encode() for c in map(chr, range(0x80, sys.maxunicode + 1)) if c.isdecimal()]
#: Titles by their first letters, the assignment before a quoted secret, and digits that aren't ASCII. What follows an assignment
#: isn't consumed: it may be digits of the next row.
_HINTS = re.compile(b"|".join([*(t.encode() for t in sorted({t[:3] for k in TITLES.values() for t in k})),
                               b"=(?=" + _SPACE + b")", b":(?=" + _SPACE + b")",
                               *(h + b"[" + b"".join(d[-1:] for d in _DIGITS if d[:-1] == h) + b"]"
                                 for h in sorted({d[:-1] for d in _DIGITS}))]))
#: 32 letters of a hexadecimal number; it consumes one, so that no match hides one of the next row.
_HEX_HINT = re.compile(rb"[a-fA-F](?=[a-fA-F]{31})")
_LETTERS = {"accented": "àâäçèéêëîïñóôöùûüíáú", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя",
            "greek": "αβγδεζηθικλμνξοπρστυφχψω", "latin": "abcdefghijklmnopqrstuvwxyz"}
#: Code points of scripts whose letters are many; other scripts' letters are collected from the planes' first 64 K.
_RANGES = {"cjk": (0x4E00, 0x9FA6), "hangul": (0xAC00, 0xD7A4)}


class Draw:
    """A keyed stream of numbers for one entity and attempt."""

    def __init__(self, key: bytes, kind: str, canonical: str, attempt: int):
        self.key, self.seed, self.n, self.pool = key, f"{kind}\0{canonical}\0{attempt}".encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 8:
            self.pool += hmac.new(self.key, self.seed + self.n.to_bytes(4, "big"), hashlib.sha256).digest()
            self.n += 1
        value, self.pool = int.from_bytes(self.pool[:8], "big"), self.pool[8:]
        return value % n


@cache
def _script(c: str) -> str:
    """The script of a letter: the first word of its name, with Latin apart into ASCII and accented letters."""
    if c.isascii():
        return "latin"
    script = unicodedata.name(c, "LATIN").split(" ")[0].lower()
    return "accented" if script == "latin" or not _other_letters(script) else script


@cache
def _other_letters(script: str) -> str:
    """The letters of a script that stand alone: no capitals, none that is composed of others."""
    if script in _LETTERS:
        return _LETTERS[script]
    if script in _RANGES:
        return "".join(map(chr, range(*_RANGES[script])))
    named = re.compile(f"{re.escape(script.upper())} (?:SMALL )?LETTER ")
    return "".join(c for c in map(chr, range(0x250, 0x10000)) if c.isalpha() and not c.isupper() and len(c.upper()) == 1
                   and named.match(unicodedata.name(c, "")) and not unicodedata.decomposition(c))


def _alike(text: str, draw: Draw) -> str:
    """Digits for digits, letters for letters of the same script and case, all else unchanged."""
    out = []
    for c in text:
        if c.isdigit():
            out.append(str(draw.below(10)))
        elif c.isalpha():
            letters = _other_letters(_script(c))
            new = letters[draw.below(len(letters))]
            out.append(new.upper() if c.isupper() else new)
        else:
            out.append(c)
    return "".join(out)


def _luhn(digits: str) -> int:
    total = sum(int(d) if i % 2 == 0 else (2 * int(d) - 9 if int(d) > 4 else 2 * int(d))
                for i, d in enumerate(reversed(digits)))
    return total % 10


def surrogate(key: bytes, kind: str, canonical: str, attempt: int) -> str:
    """The canonical form of an entity's surrogate."""
    base, _, detail = kind.partition(":")
    if attempt >= RANDOM_DRAWS and base not in ("given", "surname"):
        return _nth(key, kind, canonical, attempt - RANDOM_DRAWS)
    draw = Draw(key, kind, canonical, attempt)
    if base == "email":
        local, _, domain = canonical.rpartition("@")
        host, _, top = domain.rpartition(".")
        return f"{_alike(local, draw)}@{_alike(host, Draw(key, 'domain', domain, 0))}.{top}"
    if base == "ip":
        first = [n for n in range(1, 224) if n not in (10, 127, 169, 172, 192)][draw.below(218)]
        return ".".join(str(x) for x in (first, *(draw.below(256) for _ in range(3))))
    if base == "phone":  # detail: the country code's number of digits
        code = int(detail)
        rest = _alike(canonical[code:], draw)
        return canonical[:code] + (str(2 + draw.below(8)) + rest[1:] if rest else "")
    if base == "card":
        body = _alike(canonical[:-1], draw)
        check = (10 - _luhn(body + "0")) % 10
        return body + str(check if _luhn(canonical) == 0 else (check + 1 + draw.below(9)) % 10)
    if base in ("given", "surname") and detail.split(":")[0] not in GIVEN:
        # letters of the name's script in its length, one more with each further attempt
        return _alike(canonical + canonical[-1] * attempt, draw)
    if base == "given":
        script, gender = detail.split(":")
        names = GIVEN[script][gender] if gender != "n" else GIVEN[script]["m"] + GIVEN[script]["f"]
        # the pool is small: beyond it syllables, more with further attempts, keep names apart
        extra = "".join(SYLLABLES[script][draw.below(len(SYLLABLES[script]))] for _ in range((attempt + 1) // 2))
        return (names[draw.below(len(names))] + extra).lower()
    if base == "surname":
        script, gender = detail.split(":")
        syllables = SYLLABLES[script]
        word = "".join(syllables[draw.below(len(syllables))] for _ in range(3 + attempt // 5))
        return word + ({"m": "в", "f": "ва"}[gender] if script == "cyrillic" else "")
    if base == "secret" and re.fullmatch("[0-9a-f]+|[0-9A-F]+", canonical):
        hexes = "0123456789ABCDEF" if canonical.upper() == canonical else "0123456789abcdef"
        return "".join(hexes[draw.below(16)] for _ in canonical)
    return _alike(canonical, draw)  # other secrets, social security numbers


def _format(key: bytes, kind: str, canonical: str) -> tuple[str, list[list[str]], str, list[str]]:
    """What entities of equal formats share: a name of the format, the choices at each place of its values, what follows
    these places, and the choices at each further place of longer values."""
    digits, base = list("0123456789"), kind.partition(":")[0]
    if base == "ip":
        octets = [str(n) for n in range(256)]
        first = [str(n) for n in range(1, 224) if n not in (10, 127, 169, 172, 192)]
        return kind, [first, *[["." + n for n in octets]] * 3], "", ["." + n for n in octets]
    if base == "phone":
        code, rest = int(kind.partition(":")[2]), len(canonical)
        places = [[c] for c in canonical[:code]] + [list("23456789"), *[digits] * (rest - code - 1)][:rest - code]
        return f"{kind}:{canonical[:code]}:{rest}", places, "", digits
    if base == "card":
        valid = _luhn(canonical) == 0
        places = [digits] * (len(canonical) - 1)  # the check digit follows; of an invalid number it has 9 values
        return f"card:{valid}:{len(canonical)}", places if valid else [*places, digits[:9]], "", digits
    if base == "secret" and re.fullmatch("[0-9a-f]+|[0-9A-F]+", canonical):
        hexes = list("0123456789ABCDEF" if canonical.upper() == canonical else "0123456789abcdef")
        return f"secret:{hexes[-1]}:{len(canonical)}", [hexes] * len(canonical), "", hexes
    end = ""
    if base == "email":
        canonical, _, domain = canonical.rpartition("@")
        host, _, top = domain.rpartition(".")
        end = f"@{_alike(host, Draw(key, 'domain', domain, 0))}.{top}"
    places = []
    for c in canonical:
        letters = _other_letters(_script(c))
        places.append(digits if c.isdigit() else [c] if not c.isalpha() else
                      list(dict.fromkeys(letters.upper() if c.isupper() else letters)))
    shape = "".join(p[0] for p in places)
    return f"{base}:{shape}{end}", places, end, digits if base == "ssn" else list(_LETTERS["latin"])


def _nth(key: bytes, kind: str, canonical: str, n: int) -> str:
    """Value number n of an entity's format in a keyed order: all values of the format, then all of one more place, ..."""
    name, places, end, further = _format(key, kind, canonical)
    size = math.prod(map(len, places))
    while n >= size:
        n -= size
        places = [*places, further]
        size *= len(further)
    draw = Draw(key, "order", f"{name}\0{len(places)}", 0)
    factor = 1 + draw.below(size)
    while math.gcd(factor, size) > 1:
        factor = 1 + draw.below(size)
    n = (n * factor + draw.below(size)) % size
    out = []
    for p in reversed(places):
        n, at = divmod(n, len(p))
        out.append(p[at])
    value = "".join(reversed(out))
    if kind == "card":
        valid = _luhn(canonical) == 0
        body, more = (value, 0) if valid else (value[:len(canonical) - 1] + value[len(canonical):], 1 + int(value[len(canonical) - 1]))
        value = body + str((10 - _luhn(body + "0") + more) % 10)
    return value + end


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def parts(m: re.Match) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form) of what is replaced in a match."""
    kind = m.lastgroup
    if kind == "name":
        gender = next(g for g, titles in TITLES.items() if m["title"] in titles)
        at, out = m.start("name"), []
        words = m["name"].split(" ")
        for i, w in enumerate(words):
            script = _script(w[0])
            script = "latin" if script == "accented" else script
            # a surname is one entity for both genders, so that a family keeps one name; Cyrillic ones end by gender
            family = (gender if gender != "n" else "m") if script == "cyrillic" else "m"
            label = f"given:{script}:{gender}" if i < len(words) - 1 else f"surname:{script}:{family}"
            out.append((at, at + len(w), label, w.lower()))
            at += len(w) + 1
        return out
    text, start, end = m[kind], m.start(kind), m.end(kind)
    if kind == "email":
        return [(start, end, kind, text.lower())]
    if kind == "phone":
        code = len(re.match(r"\+?(\d*)", text)[1]) if text.startswith("+") and re.match(r"\+\d{1,3}[ .(-]", text) else 0
        return [(start, end, f"phone:{code}", _digits(text))]
    if kind in ("card", "ssn"):
        return [(start, end, kind, _digits(text))]
    return [(start, end, "secret" if kind == "hex" else kind, text)]


def rendered(kind: str, mention: str, new: str) -> str:
    """A surrogate's canonical form in the format of a mention."""
    base = kind.partition(":")[0]
    if base in ("phone", "card", "ssn"):
        digits = iter(new)
        return "".join(next(digits) if c.isdigit() else c for c in mention) + "".join(digits)
    if base in ("given", "surname"):
        return new.upper() if mention.isupper() and len(mention) > 1 else new.capitalize()
    if base == "email":
        return "".join(n.upper() if c.isupper() else n for c, n in zip(mention, new)) if len(mention) == len(new) else new
    return new


def _hinted(body: np.ndarray, offsets: np.ndarray) -> list[int]:
    """Rows that may hold an entity: all that ENTITY matches has a digit (of any script), an at sign, the beginning of a
    title, an assignment of something quoted, or many hexadecimal letters."""
    raw = body.tobytes()
    at = [np.flatnonzero(_HINT[body])]
    at += [np.array([m.start() for m in hint.finditer(raw)], np.int64) for hint in (_HINTS, _HEX_HINT)]
    return np.unique(np.searchsorted(offsets, np.concatenate(at), "right") - 1).tolist()


def _entities(text: str) -> list[tuple[int, int, str, str]]:
    found = [p for m in ENTITY.finditer(text) for p in parts(m)]
    names = {text[a:b]: (kind, canonical) for a, b, kind, canonical in reversed(found) if kind.startswith(("given", "surname"))}
    if not names:
        return found
    out, spans = [], iter([*found, (len(text) + 1, len(text) + 1, "", "")])
    span = next(spans)
    for m in _WORD.finditer(text):  # mentions of the names without a title, beside what is found already
        while span[1] <= m.start():
            out.append(span)
            span = next(spans)
        known = names.get(m[0])
        if known and m.end() <= span[0]:
            out.append((m.start(), m.end(), *known))
    return out + [x for x in (span, *spans) if x[2]]


def entities(documents: DataFrame) -> DataFrame:
    """The distinct entities of all texts: kind, canonical."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = C.utf8_column(batch.column(0))
            raw, found = memoryview(body), set()
            for r in _hinted(body, offsets):
                found.update((k, c) for _, _, k, c in _entities(str(raw[offsets[r]:offsets[r + 1]], "utf-8")))
            rows = sorted(found)
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], pa.string()) for i in (0, 1)],
                                             names=["kind", "canonical"])

    return C.text_rows(documents, "text").mapInArrow(find, "kind string, canonical string").distinct()


def attempts(found: DataFrame, key: bytes) -> DataFrame:
    """kind, canonical, surrogate and attempt of every distinct entity, without collisions."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, names, tries = (batch.column(i).to_pylist() for i in range(3))
            new = [surrogate(key, k, c, t) for k, c, t in zip(kinds, names, tries)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())],
                                             names=["kind", "canonical", "attempt", "surrogate"])

    def drawn(df: DataFrame) -> DataFrame:
        return df.select("kind", "canonical", F.col("attempt").cast("long").alias("attempt")).mapInArrow(
            draw, "kind string, canonical string, attempt long, surrogate string")

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [_format(key, k, c)[0] for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string())],
                                             names=["kind", "canonical", "attempt", "surrogate", "format"])

    # types are compared without their details, so that also a name of another gender counts
    base = F.split("kind", ":")[0]

    def assigned(left: DataFrame, used: DataFrame, doublings: int) -> DataFrame:
        """`left`, each with the next free one of the first values of its format; as it was, where these are all used."""
        by_format = Window.partitionBy("format")
        left = C.written(left.select("kind", "canonical", "attempt", "surrogate").mapInArrow(
            formatted, "kind string, canonical string, attempt long, surrogate string, format string").withColumn(
            "nth", F.row_number().over(by_format.orderBy("canonical", "kind"))), "left")
        formats = left.groupBy("format").agg(F.min(F.struct("kind", "canonical")).alias("one"), F.count("*").alias("n"))
        blocks = formats.withColumn("tried", (F.col("n") + TRIED) * (1 << doublings)).withColumn(
            "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tried") - 1, F.lit(4096).cast("long"))))
        tried = blocks.select("format", "one.kind", "one.canonical", F.explode(F.sequence(
            F.col("block") + RANDOM_DRAWS, F.least(F.col("block") + 4096, "tried") - 1 + RANDOM_DRAWS)).alias("attempt"))
        # equal attempts of equal formats have equal values, so the format's one entity stands for all
        values = C.written(drawn(tried).join(formats.select("format", "one.kind", "one.canonical"), ["kind", "canonical"]), "values")
        free = values.withColumn("base", base).join(used, ["base", "surrogate"], "left_anti")
        free = free.select("format", F.row_number().over(by_format.orderBy("attempt")).alias("nth"),
                           F.col("attempt").alias("next"), F.col("surrogate").alias("new"))
        return left.join(free, ["format", "nth"], "left").select(
            "kind", "canonical", F.coalesce("next", "attempt").alias("attempt"), F.coalesce("new", "surrogate").alias("surrogate"))

    real = C.written(found, "entities")
    given = C.written(drawn(real.withColumn("attempt", F.lit(0))), "surrogates")
    taken = real.select(base.alias("base"), F.col("canonical").alias("surrogate"), F.lit(True).alias("taken")).distinct()
    for attempt in itertools.count(1):
        # of equal surrogates the earliest drawn, then the smallest entity, keeps it; an entity's own form is no surrogate
        first = given.groupBy(base.alias("base"), "surrogate").agg(F.min(F.struct("attempt", "canonical", "kind")).alias("w"))
        judged = given.withColumn("base", base).join(first, ["base", "surrogate"]).join(taken, ["base", "surrogate"], "left")
        judged = C.written(judged.select("kind", "canonical", "attempt", "surrogate", (
            F.col("taken").isNotNull() | (F.col("w.canonical") != F.col("canonical")) | (F.col("w.kind") != F.col("kind"))
        ).alias("again")), "judged")
        if judged.where("again").isEmpty():
            return given
        kept, again = judged.where("not again").drop("again"), judged.where("again")
        named = base.isin("given", "surname") if attempt >= RANDOM_DRAWS else F.lit(True)
        new = drawn(again.where(named).withColumn("attempt", F.col("attempt") + 1))
        if attempt >= RANDOM_DRAWS:
            used = kept.select(base.alias("base"), "surrogate").unionByName(taken.drop("taken"))
            new = new.unionByName(assigned(again.where(~named), used, attempt - RANDOM_DRAWS))
        given = C.written(kept.unionByName(new), "surrogates")


def replaced(documents: DataFrame, *, key: bytes = b"tillroll surrogate key", count: str | None = None) -> DataFrame:
    """The documents with all their columns and surrogates in `text`; `count` names a further column with the number of
    replaced mentions. Pass a secret `key`: whoever has it can test guesses."""
    found = attempts(entities(documents), key).where("attempt > 0").select("kind", "canonical", "attempt")
    spark, known = documents.sparkSession, found.count()
    schema, names = documents.schema, documents.columns
    if count:
        schema = documents.withColumn(count, F.lit(0).cast("long")).schema
    at = names.index("text")
    chars = names.index("n_chars") if "n_chars" in names else None
    if known <= EXCEPTIONS_BROADCAST:
        table = spark.sparkContext.broadcast({(r["kind"], r["canonical"]): r["attempt"] for r in found.collect()})
        rows, extra = documents, False
    else:
        rows, extra = _with_attempts(documents, found), True

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = C.utf8_column(batch.column(at))
            raw, texts, sizes = memoryview(body), {}, np.zeros(batch.num_rows, np.int64)
            for r in _hinted(body, offsets):
                text = str(raw[offsets[r]:offsets[r + 1]], "utf-8")
                if extra:
                    redrawn = {(x["kind"], x["canonical"]): x["attempt"] for x in batch.column(len(names))[r].as_py() or ()}
                else:
                    redrawn = table.value
                out, end = [], 0
                for a, b, kind, canonical in _entities(text):
                    new = surrogate(key, kind, canonical, redrawn.get((kind, canonical), 0))
                    out += [text[end:a], rendered(kind, text[a:b], new)]
                    end, sizes[r] = b, sizes[r] + 1
                if out:
                    texts[r] = "".join(out) + text[end:]
            columns = list(batch.columns[:len(names)])
            if texts:
                kind = batch.column(at).type
                changed = np.zeros(batch.num_rows, bool)
                changed[list(texts)] = True
                order = sorted(texts)
                mask = pa.array(changed)
                columns[at] = columns[at].cast(pa.string())
                columns[at] = pa.compute.replace_with_mask(
                    columns[at], mask, pa.array([texts[r] for r in order], pa.string())).cast(kind)
                if chars is not None and pa.types.is_integer(columns[chars].type):
                    columns[chars] = pa.compute.replace_with_mask(
                        columns[chars], mask, pa.array([len(texts[r]) for r in order], columns[chars].type))
            if count:
                columns.append(pa.array(sizes))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(replace, schema)


def _with_attempts(documents: DataFrame, found: DataFrame) -> DataFrame:
    """The documents with, in a last column, the redrawn entities that each mentions."""
    row = "row_number"
    while row in documents.columns:
        row += "_"
    rows = C.written(documents.withColumn(row, F.monotonically_increasing_id()), "texts")

    def mention(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = C.utf8_column(batch.column(1))
            raw, out, ids = memoryview(body), [], batch.column(0).to_pylist()
            for r in _hinted(body, offsets):
                seen = {(k, c) for _, _, k, c in _entities(str(raw[offsets[r]:offsets[r + 1]], "utf-8"))}
                out += [(ids[r], k, c) for k, c in sorted(seen)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.string(), pa.string()))],
                names=[row, "kind", "canonical"])

    mentions = rows.select(row, "text").mapInArrow(mention, f"`{row}` long, kind string, canonical string")
    # at most as many entries as one text has entities
    listed = mentions.join(found, ["kind", "canonical"]).groupBy(row).agg(
        F.collect_list(F.struct("kind", "canonical", "attempt")).alias(f"{row}_attempts"))
    return rows.join(listed, row, "left").drop(row)


def report(documents: DataFrame, *, key: bytes = b"tillroll surrogate key") -> DataFrame:
    """doc_id, the text with surrogates and the number of replaced mentions."""
    return replaced(C.text_rows(documents, "doc_id", "text"), key=key, count="n_replaced")
