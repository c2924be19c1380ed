"""Names, places and addresses."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The block of Hangul syllables and the letters they consist of.
HANGUL_FIRST, HANGUL_LAST = 0xAC00, 0xD7A3
LEAD_FIRST, LEADS = 0x1100, 19
VOWEL_FIRST, VOWELS = 0x1161, 21
TAIL_FIRST, TAILS = 0x11A7, 28
# Spelling variants merged after normalising.
DISTRICT_ALIASES = {
    "ATE VITARTE": "ATE",
    "LIMA CERCADO": "LIMA",
    "MAGDALENA": "MAGDALENA DEL MAR",
}


def location_parts(location: Column) -> tuple[Column, Column]:
    """BR2: (first, last) non-blank comma part; a single part has no city."""
    parts = F.filter(F.transform(F.split(location, ","), lambda part: F.trim(part)), lambda part: part != "")
    return (
        F.try_element_at(parts, F.lit(1)),
        F.when(F.size(parts) > 1, F.try_element_at(parts, F.lit(-1))),
    )


def absolute_url(url: Column, base_url: str) -> Column:
    """BR3: keep absolute addresses, prefix relative ones, '' counts as missing."""
    present = F.nullif(url, F.lit(""))
    return F.when(present.startswith("http"), present).otherwise(F.concat(F.lit(base_url), present))


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str, dict[str, str]]:
    """(accented characters, their plain ones, characters of several base letters with these).

    Derived from the Unicode database: canonical decompositions without nonspacing marks, on all
    planes. Hangul syllables follow a formula and are left out.
    """
    accented, plain, several = [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        if not unicodedata.decomposition(char):
            continue
        base = "".join(c for c in unicodedata.normalize("NFD", char) if unicodedata.category(c) != "Mn")
        if len(base) > 1:
            several[char] = base
        elif base and base != char:
            accented.append(char)
            plain.append(base)
    return "".join(accented), "".join(plain), several


def _jamo(syllable: Column) -> Column:
    """The letters of one Hangul syllable, by its place in the block."""
    place = F.ascii(syllable) - HANGUL_FIRST
    tail = (place % TAILS).cast("int")
    lead, vowel = F.floor(place / (VOWELS * TAILS)), F.floor(place % (VOWELS * TAILS) / TAILS)

    def letter(first: int, number: int, at: Column) -> Column:
        return F.substring(F.lit("".join(map(chr, range(first, first + number)))), at.cast("int") + 1, F.lit(1))

    last = F.when(tail > 0, letter(TAIL_FIRST, TAILS, tail)).otherwise("")
    return F.concat(letter(LEAD_FIRST, LEADS, lead), letter(VOWEL_FIRST, VOWELS, vowel), last)


def base_letters(text: Column) -> Column:
    """Canonical decomposition without nonspacing marks.

    Characters of several base letters are rare: only texts that hold one are cut at them.
    """
    accented, plain, several = accent_table()
    bare = F.translate(F.regexp_replace(text, r"\p{Mn}+", ""), accented, plain)
    hangul = f"[{chr(HANGUL_FIRST)}-{chr(HANGUL_LAST)}]"
    long = f"{hangul[:-1]}{''.join(several)}]"
    letters = F.create_map(*[F.lit(t) for pair in several.items() for t in pair])
    pieces = F.regexp_extract_all(bare, F.lit(f"{long}|[^{long[1:]}+"), F.lit(0))
    spelled = F.transform(
        pieces,
        lambda p: F.when(p.rlike(f"^{hangul}$"), _jamo(p)).otherwise(F.coalesce(F.try_element_at(letters, p), p)),
    )
    return F.when(bare.rlike(long), F.array_join(spelled, "")).otherwise(bare)


def name_key(name: Column) -> Column:
    """SV4: accent-, case- and whitespace-insensitive key; NULL becomes ''."""
    bare = base_letters(F.coalesce(name, F.lit("")))
    return F.upper(F.trim(F.regexp_replace(bare, r"(?U)\s+", " ")))


def district_key(name: Column) -> Column:
    """SV5: normalised name with known aliases merged."""
    aliases = F.create_map(*[F.lit(t) for pair in DISTRICT_ALIASES.items() for t in pair])
    key = name_key(name)
    return F.coalesce(F.try_element_at(aliases, key), key)


def column_key(name: str) -> str:
    """Comparison form of a column name: no case, accents or underscores."""
    bare = "".join(c for c in unicodedata.normalize("NFD", name) if unicodedata.category(c) != "Mn")
    return " ".join(bare.split()).upper().replace("_", "")
