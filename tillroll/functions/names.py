"""Company-name normalisation as built-in column expressions.

null -> '', lower-case, transliterate to ASCII, drop combining accents, '&' -> ' and ', all but letters, digits and the vowel
signs of other scripts -> space, drop company-form words, squeeze spaces, trim. All JVM-side (`translate`, `regexp_replace`,
`transform`), no UDF. Latin, Greek, Cyrillic, full width, kana and Hangul become ASCII; letters of other scripts (such as Han
characters, which would need a dictionary) stay as they are, so that no name becomes empty.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Company-form words removed from names (the reference's list, in its order).
COMPANY_SUFFIXES = (
    "ltd", "limited", "inc", "corp", "corporation", "co", "company", "gmbh", "ag", "plc", "llc", "llp", "pte", "pty",
    "bv", "nv", "sas", "sl", "sa", r"sp\s*z\s*o\s*o", "oy", "oyj", "ab",
)
# Lower-case letters and signs whose ASCII form is not their decomposition's base letter.
MULTI_LETTER = {"ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ð": "d", "ø": "o", "đ": "d", "ł": "l", "ı": "i", "ħ": "h",
                "ŀ": "l", "ŋ": "ng", "ĸ": "q", "ŉ": "'n", "ſ": "s", "ĳ": "ij", "ﬁ": "fi", "ﬂ": "fl", "™": "tm"}
# Common transliteration of Cyrillic and Greek lower-case letters.
CYRILLIC = {"а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i", "й": "i", "к": "k",
            "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh",
            "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "iu", "я": "ia",
            "ё": "e", "є": "ie", "і": "i", "ї": "i", "ґ": "g"}
GREEK = {"α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k", "λ": "l",
         "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s", "ς": "s", "τ": "t", "υ": "u", "φ": "ph",
         "χ": "kh", "ψ": "ps", "ω": "o", "ά": "a", "έ": "e", "ή": "e", "ί": "i", "ό": "o", "ύ": "u", "ώ": "o"}
SEVERAL = MULTI_LETTER | CYRILLIC | GREEK
# The letters of a Hangul syllable's first, middle and last part, in the order of their code points.
HANGUL_FIRST = "g gg n d dd r m b bb s ss - j jj c k t p h".split()
HANGUL_MIDDLE = "a ae ya yae eo e yeo ye o wa wae oe yo u weo we wi yu eu yi i".split()
HANGUL_LAST = "- g gg gs n nj nh d l lg lm lb ls lt lp lh m b bs s ss ng j c k t p h".split()
# Hiragana by rows of a, i, u, e, o; a dash where a row has no such letter.
KANA_ROWS = (("あいうえお", "a i u e o"), ("かきくけこ", "ka ki ku ke ko"), ("がぎぐげご", "ga gi gu ge go"),
             ("さしすせそ", "sa shi su se so"), ("ざじずぜぞ", "za ji zu ze zo"), ("たちつてと", "ta chi tsu te to"),
             ("だぢづでど", "da ji zu de do"), ("なにぬねの", "na ni nu ne no"), ("はひふへほ", "ha hi fu he ho"),
             ("ばびぶべぼ", "ba bi bu be bo"), ("ぱぴぷぺぽ", "pa pi pu pe po"), ("まみむめも", "ma mi mu me mo"),
             ("やゆよ", "ya yu yo"), ("らりるれろ", "ra ri ru re ro"), ("わゐゑをん", "wa wi we wo n"), ("ぁぃぅぇぉ", "a i u e o"),
             ("ゃゅょ", "ya yu yo"), ("っゎゔ", "tsu wa vu"))
#: Katakana stand this far behind the hiragana of the same sound.
KATAKANA = 0x60


def kana() -> dict[str, str]:
    table = {c: v for letters, values in KANA_ROWS for c, v in zip(letters, values.split())}
    return table | {chr(ord(c) + KATAKANA): v for c, v in table.items()} | {"ー": ""}


def single_letters() -> dict[str, str]:
    """Accented Latin and full-width characters mapped to their compatibility decomposition's base letter (rule-built)."""
    table = {}
    for code in (*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)):
        ch = chr(code)
        base = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c)).lower()
        if ch not in SEVERAL and len(base) == 1 and base.isascii() and base != ch:
            table[ch] = base
    return table


_SINGLE = single_letters() | {k: v for k, v in SEVERAL.items() if len(v) == 1}
_SRC, _DST = "".join(_SINGLE), "".join(_SINGLE.values())
_REPLACED = {k: v for k, v in SEVERAL.items() if len(v) != 1}
SUFFIX_PATTERN = r"\b(" + "|".join(COMPANY_SUFFIXES) + r")\b"


def _letters(values: list[str]) -> Column:
    return F.array(*[F.lit("" if v == "-" else v) for v in values])


def _syllables(text: Column) -> Column:
    """Kana by table and Hangul by arithmetic on its code points, character by character; other texts as they are."""
    table = F.create_map(*[F.lit(x) for pair in kana().items() for x in pair])

    def one(ch: Column) -> Column:
        at = F.ascii(ch) - 0xAC00
        middle = len(HANGUL_MIDDLE) * len(HANGUL_LAST)
        hangul = F.concat(F.get(_letters(HANGUL_FIRST), F.floor(at / middle).cast("int")),
                          F.get(_letters(HANGUL_MIDDLE), F.floor(at % middle / len(HANGUL_LAST)).cast("int")),
                          F.get(_letters(HANGUL_LAST), (at % len(HANGUL_LAST)).cast("int")))
        return F.when(ch.between("\uac00", "\ud7a3"), hangul).otherwise(F.coalesce(F.try_element_at(table, ch), ch))

    return F.when(text.rlike("[\u3041-\u30ff\uac00-\ud7a3]"), F.array_join(F.transform(F.split(text, ""), one), "")).otherwise(text)


#: Accents that combine with any letter, and the optional vowel points of Hebrew and Arabic.
ACCENTS = "[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f\u0591-\u05c7\u064b-\u0652]"


def transliterate(col: Column) -> Column:
    """Lower-case text in ASCII where a rule or table has its letters; others stay. Accents are dropped, whether they were
    written as part of a letter or after it."""
    out = F.translate(col, _SRC, _DST)
    for k, v in _REPLACED.items():
        out = F.replace(out, F.lit(k), F.lit(v))
    return _syllables(F.regexp_replace(out, ACCENTS, ""))


def normalize_name(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    s = transliterate(F.lower(F.coalesce(c.cast("string"), F.lit(""))))
    s = F.replace(s, F.lit("&"), F.lit(" and "))
    s = F.regexp_replace(s, r"[^\p{L}\p{M}\p{N}\s]", " ")  # letters of other scripts stay, so that no name becomes empty
    s = F.regexp_replace(s, SUFFIX_PATTERN, " ")
    s = F.regexp_replace(s, r"\s+", " ")
    return F.trim(s)


def block_key(norm: Column | str, n: int = 3) -> Column:
    """first n characters of the normalised name (the optional v1 blocking)."""
    c = F.col(norm) if isinstance(norm, str) else norm
    return F.substring(c, 1, n)
