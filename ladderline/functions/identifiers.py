"""Table and column names: transliteration (C9), byte-bounded names (C10), aliases."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ladderline.functions.text import strip

NAME_BYTES = 63

# Cyrillic to Latin.
TRANSLITERATION = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "yo", "ж": "zh", "з": "z",
    "и": "i", "й": "y", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r",
    "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch",
    "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya",
}


def latin_identifier(text: Column) -> Column:
    """A lower-case Latin snake_case name: CamelCase split, transliterated, at most 63 characters."""
    words = F.regexp_replace(strip(text), "(?<=[a-zа-яё0-9])(?=[A-ZА-ЯЁ])", "_")
    several = {k: v for k, v in TRANSLITERATION.items() if len(v) > 1}
    single = {k: v for k, v in TRANSLITERATION.items() if len(v) == 1}
    dropped = [k for k, v in TRANSLITERATION.items() if not v]
    latin = reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), several.items(), F.lower(words))
    latin = F.translate(latin, "".join([*single, *dropped]), "".join(single.values()))
    name = F.btrim(F.regexp_replace(latin, "[^a-z0-9]+", "_"), F.lit("_"))
    name = F.btrim(F.left(name, F.lit(NAME_BYTES)), F.lit("_"))
    return F.coalesce(F.nullif(F.regexp_replace(name, "^(?=[0-9])", "t_"), F.lit("")), F.lit("report"))


def truncate_bytes(name: Column, limit: int = NAME_BYTES) -> Column:
    """The longest prefix of ``name`` that fits ``limit`` UTF-8 bytes, never cutting a character.

    A UTF-8 character has at most four bytes, so one of the last four cuts always ends on a character.
    """
    raw = name.cast("binary")
    cuts = [
        F.try_validate_utf8(F.substring(raw, F.lit(1), F.lit(size)).cast("string"))
        for size in range(limit, limit - 4, -1)
    ]
    return F.coalesce(*cuts)


def column_alias(name: Column) -> Column:
    """The default alias of a header: lower case, spaces and points become underscores."""
    return F.translate(F.lower(name), " .", "__")
