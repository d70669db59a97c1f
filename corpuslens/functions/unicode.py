"""Unicode helpers: which rows need decoding, and the Arrow pass that decodes them.

Spark has no built-in for NFKC or HTML entities. Only rows that can change are sent to Python;
all others travel as nulls and keep their JVM value.
"""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpuslens.functions.grams import RUN_BYTES, runs, sizes_of
from corpuslens.functions.memory import trim


def _ranges(spans) -> str:
    """Java character-class body for inclusive code point spans."""
    return "".join(f"\\x{{{low:x}}}-\\x{{{high:x}}}" for low, high in spans)


# Code points that count as white space, word characters, apostrophes to straighten,
# and combining marks.
SPACE_SPANS = (
    (0x09, 0x0D),
    (0x1C, 0x20),
    (0x85, 0x85),
    (0xA0, 0xA0),
    (0x1680, 0x1680),
    (0x2000, 0x200A),
    (0x2028, 0x2029),
    (0x202F, 0x202F),
    (0x205F, 0x205F),
    (0x3000, 0x3000),
)
# The same set as a short class body: few alternatives keep the regex engine fast.
SPACES = r"\s\x1c-\x1f\x85\p{Z}"
SPACE_CHARS = "".join(chr(c) for low, high in SPACE_SPANS for c in range(low, high + 1))
WORD = r"\p{L}\p{N}_"
# Apostrophes read as the plain one.
CURLY_APOSTROPHES = "’‘"
COMBINING_SPANS = ((0x300, 0x36F), (0x1AB0, 0x1AFF), (0x1DC0, 0x1DFF), (0x20D0, 0x20FF), (0xFE20, 0xFE2F))
COMBINING = _ranges(COMBINING_SPANS)

# Characters that NFKC provably leaves alone whatever stands next to them: ASCII, the Latin,
# Cyrillic, Hebrew, kana, Han and Hangul blocks without compatibility forms, and plain
# punctuation. Everything else (and anything that looks like an entity) takes the Arrow pass.
STABLE_SPANS = (
    (0x00, 0x7F),
    (0xA1, 0xA7),
    (0xA9, 0xA9),
    (0xAB, 0xAE),
    (0xB0, 0xB1),
    (0xB6, 0xB7),
    (0xBB, 0xBB),
    (0xBF, 0x131),
    (0x134, 0x13E),
    (0x141, 0x148),
    (0x14A, 0x17E),
    (0x180, 0x1C3),
    (0x1CD, 0x1F0),
    (0x1F4, 0x2AF),
    (0x391, 0x3A1),
    (0x3A3, 0x3C9),
    (0x400, 0x482),
    (0x48A, 0x52F),
    (0x5D0, 0x5EA),
    (0x1E00, 0x1E99),
    (0x1E9E, 0x1EFF),
    (0x2010, 0x2010),
    (0x2012, 0x2015),
    (0x2018, 0x201F),
    (0x2020, 0x2022),
    (0x2030, 0x2030),
    (0x2039, 0x203A),
    (0x20AC, 0x20AC),
    (0x3001, 0x3002),
    (0x3041, 0x3096),
    (0x30A1, 0x30FA),
    (0x4E00, 0x9FFF),
    (0xAC00, 0xD7A3),
)
# ASCII, all of it stable, fails at the first of the two tests, long before the many spans.
_UNSTABLE = rf"[\x{{80}}-\x{{10ffff}}&&[^{_ranges(STABLE_SPANS)}]]"
_ENTITY = r"&[#A-Za-z]"


def needs_decoding(text: Column) -> Column:
    """True where NFKC or entity decoding could change the value."""
    entity = F.contains(text, F.lit("&")) & text.rlike(_ENTITY)
    return entity | text.rlike(_UNSTABLE)


_STRAIGHT = str.maketrans(dict.fromkeys(CURLY_APOSTROPHES, "'"))


def _decoded(value: str | None) -> str | None:
    if value is None:
        return None
    value = unicodedata.normalize("NFKC", value).translate(_STRAIGHT)
    return html.unescape(value) if "&" in value else value


# A function of iterators, while scoring uses plain ones: Spark chains Python functions of one kind by
# inlining everything between them, which would repeat the normaliser inside every guard.
@F.arrow_udf(StringType())
def _decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Texts become Python strings a few megabytes at a time, whatever the size of a batch."""
    try:
        for batch in batches:
            parts = [pa.array([], pa.string())]
            for start, rows in runs(sizes_of(batch), RUN_BYTES):
                parts.append(pa.array([_decoded(v) for v in batch.slice(start, rows).to_pylist()], pa.string()))
            yield pa.concat_arrays(parts)
            trim()
    finally:
        trim()


def straighten(text: Column) -> Column:
    """Curly apostrophes become straight ones."""
    return F.translate(text, CURLY_APOSTROPHES, "''")


def decode(text: Column) -> Column:
    """NFKC, straight apostrophes, then HTML entities."""
    hard = F.when(needs_decoding(text), text)
    return F.coalesce(_decode(hard), straighten(text))


def _accent_pairs() -> tuple[str, str]:
    """Precomposed letters whose canonical base is one ASCII letter (Latin blocks)."""
    source, target = [], []
    for block in (range(0xC0, 0x250), range(0x1E00, 0x1F00)):
        for code in block:
            letter = chr(code)
            base = "".join(
                c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c)
            )
            if base != letter and len(base) == 1:
                source.append(letter)
                target.append(base)
    return "".join(source), "".join(target)


ACCENTED, UNACCENTED = _accent_pairs()


def strip_accents(text: Column) -> Column:
    """Drop diacritics from Latin letters; pure ASCII values skip the character walk."""
    plain = F.regexp_replace(
        F.translate(text, ACCENTED, UNACCENTED), F.lit(rf"[{COMBINING}]+"), F.lit("")
    )
    return F.when(F.length(text) == F.octet_length(text), text).otherwise(plain)
