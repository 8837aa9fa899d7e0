"""Text standardisation as column expressions (no Python code runs per row)."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.fixed_values import LEGAL_ACRONYMS

def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """Compatibility decompositions without combining marks, for every code point of the Unicode data.

    One-letter ones and marks (which go) as the two strings of ``translate``, longer ones as a map.
    """
    single, several, marks = {}, {}, []
    for letter in map(chr, (p for p in range(0x80, 0x110000) if not 0xD800 <= p < 0xE000)):
        if not (unicodedata.decomposition(letter) or unicodedata.combining(letter) or "가" <= letter <= "힣"):
            continue
        plain = "".join(ch for ch in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(ch))
        if not plain:
            marks.append(letter)
        elif plain != letter:
            (single if len(plain) == 1 else several)[letter] = plain
    return "".join([*single, *marks]), "".join(single.values()), several


# ``translate`` pairs characters by position and drops those beyond the second string.
FOLD_FROM, FOLD_TO, FOLD_SEVERAL = _fold_tables()


def _ranges(letters: Iterable[str]) -> str:
    """A character class that holds exactly ``letters``."""
    points, runs = sorted(map(ord, letters)), []
    for point in points:
        if runs and runs[-1][1] == point - 1:
            runs[-1][1] = point
        else:
            runs.append([point, point])
    return "[" + "".join(rf"\x{{{low:X}}}-\x{{{high:X}}}" for low, high in runs) + "]"


# Only texts that hold one of these letters pay for the lookup letter by letter.
_HAS_SEVERAL = _ranges(FOLD_SEVERAL)
_SEVERAL_TEXT = "\x01".join(f"{letter}\x02{plain}" for letter, plain in FOLD_SEVERAL.items())


# Every white-space character of Unicode, by rule.
WHITE_SPACE = "".join(chr(point) for point in range(0x3001) if chr(point).isspace())


def let(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use(c)`` with ``c`` evaluated once a row, however often ``use`` names it.

    A column that an expression names several times is copied into each of its branches. Where its own expression is long,
    the code generated for a row outgrows what the JVM compiles (8000 bytes a method) and is interpreted from then on.
    """
    return F.get(F.transform(F.array(c), use), F.lit(0))


def strip_space(c: Column) -> Column:
    """Trim every kind of white space, not only the blank that ``trim`` removes.

    Trimming a set of characters is slow; a text that has a visible ASCII character at both ends without its blanks is done.
    """
    bare = F.trim(c)
    visible = [(end >= "!") & (end < "\x7f") for end in (bare, F.substring(bare, -1, 1))]
    return F.when(visible[0] & visible[1], bare).otherwise(F.btrim(c, F.lit(WHITE_SPACE)))


def collapse_space(c: Column) -> Column:
    return F.regexp_replace(strip_space(c), r"(?U)\s+", " ")


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def digits(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), "[^0-9]", "")


def code_key(c: Column) -> Column:
    """Join form of a business code whose case and padding differ between sources."""
    return F.upper(F.trim(c))


def fold_accents(c: Column) -> Column:
    """Every letter by its compatibility decomposition, ligatures included, without combining marks."""
    table = F.str_to_map(F.lit(_SEVERAL_TEXT), F.lit("\x01"), F.lit("\x02"))
    letters = F.transform(F.split(c, ""), lambda letter: F.coalesce(F.try_element_at(table, letter), letter))
    whole = F.when(c.rlike(_HAS_SEVERAL), F.array_join(letters, "")).otherwise(c)
    return F.translate(whole, FOLD_FROM, FOLD_TO)


def match_key(c: Column) -> Column:
    """Accent-free lower-case form with ``.`` and ``-`` read as blanks; NULL becomes the empty text."""
    spaced = F.regexp_replace(F.lower(fold_accents(c)), r"[.\-]", " ")
    return F.coalesce(collapse_space(spaced), F.lit(""))


def lookup_map(mapping: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def map_value(c: Column, mapping: Mapping) -> Column:
    """Value of a small literal map; NULL for a missing key."""
    return F.try_element_at(lookup_map(mapping), c)


def canonical(c: Column, variants: Mapping[str, str]) -> Column:
    """Canonical value of any known spelling; NULL when the spelling is unknown."""
    return map_value(match_key(c), variants)


def title_name(c: Column, acronyms: Mapping[str, str] = LEGAL_ACRONYMS) -> Column:
    """Capital after every non-letter (``S/A``, ``D'Agua``), single spaces, company acronyms restored."""
    pieces = F.split(F.lower(collapse_space(c)), r"(?<=\P{L})(?=\p{L})")
    titled = F.array_join(F.transform(pieces, F.initcap), "")
    for spelled, wanted in acronyms.items():
        titled = F.regexp_replace(titled, rf"(^| ){spelled}(?= |$)", f"$1{wanted}")
    return titled
