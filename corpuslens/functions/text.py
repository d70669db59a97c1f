"""Text normaliser and fingerprints as Column expressions.

Each step is a function ``Column -> Column``; the normaliser is their ordered composition.
``with_normalized`` stacks the steps as projections so that a cheap substring test can skip the
expensive expressions on rows that cannot match; ``normalize`` is the plain composition.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.config import SEPARATOR, TextOptions
from corpuslens.functions import unicode as uni

_W, _S = uni.WORD, uni.SPACES
_START = rf"(?<![{_W}])"
_END = rf"(?![{_W}])"
_EDGE = rf"(?:(?<=[{_W}])(?![{_W}])|(?<![{_W}])(?=[{_W}]))"

# The patterns and substitutions of the normaliser, in Java syntax with Unicode
# word boundaries spelled out.
EMAIL = rf"(?iu){_EDGE}[{_W}.+-]++@[{_W}.-]+\.[a-z]{{2,}}{_EDGE}"
URL = rf"(?iu)(?:https?://|www\.)[^{_S}]+"
TAG = r"<[^>]++>"
SOURCE_PREFIX = (
    rf"(?iu)^[{_S}]*(?:[A-Z][A-Z .'-]{{1,35}})?[{_S}]*"
    rf"\((?:Reuters|AP)\)[{_S}]*[-–—:][{_S}]*"
)
SOURCE_MARKER = (
    rf"(?iu)(?=[rac]){_START}(?:reuters|associated[{_S}]+press|copyright[{_S}]+\p{{Nd}}{{4}}){_END}"
)
REPEATED = r"(?iu)([a-z])\1{3,}"
NUMBER = rf"{_START}\p{{Nd}}+(?:[.,]\p{{Nd}}+)*{_END}"
NOT_TEXT = r"[^\p{L}\p{N}!?'\-<>]+"
CONTRACTIONS = {
    "can't": "can not",
    "cannot": "can not",
    "won't": "will not",
    "n't": " not",
    "'re": " are",
    "'ve": " have",
    "'ll": " will",
    "'d": " would",
    "'m": " am",
    "it's": "it is",
}
EMAIL_TOKEN = " emailtoken "
URL_TOKEN = " urltoken "
NUMBER_TOKEN = " numbertoken "

Step = Callable[[Column], Column]


def _sub(pattern: str, replacement: str) -> Step:
    return lambda c: F.regexp_replace(c, F.lit(pattern), F.lit(replacement))


def _has_any(*needles: str) -> Step:
    def test(c: Column) -> Column:
        out = F.lit(False)
        for needle in needles:
            out = out | F.contains(c, F.lit(needle))
        return out

    return test


strip_tags: Step = _sub(TAG, " ")
mask_emails: Step = _sub(EMAIL, EMAIL_TOKEN)
mask_urls: Step = _sub(URL, URL_TOKEN)
drop_urls: Step = _sub(URL, " ")
strip_source_prefix: Step = _sub(SOURCE_PREFIX, " ")
strip_source_markers: Step = _sub(SOURCE_MARKER, " ")
collapse_repeats: Step = _sub(REPEATED, "$1$1$1")
mask_numbers: Step = _sub(NUMBER, NUMBER_TOKEN)


def expand_contractions(text: Column) -> Column:
    """Ordered literal substitutions; earlier pairs win."""
    for short, full in CONTRACTIONS.items():
        text = F.replace(text, F.lit(short), F.lit(full))
    return text


def keep_text(text: Column) -> Column:
    """Blank out everything but letters, digits and ``! ? ' - < >``; single spaces, stripped.

    Spaces and underscores are outside the kept set too, so one pass does the work of
    replacing, collapsing and stripping.
    """
    return F.trim(_sub(NOT_TEXT, " ")(text))


def strip(text: Column) -> Column:
    """Remove leading and trailing Unicode whitespace (``trim`` only knows the space)."""
    return F.btrim(text, F.lit(uni.SPACE_CHARS))


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words; 0 for a blank value."""
    return F.regexp_count(text, F.lit(rf"[^{_S}]+"))


def normalization_steps(options: TextOptions = TextOptions()) -> list[tuple[Step | None, Step]]:
    """(guard, step) pairs; a guard of None means the step always runs."""
    decode = uni.decode if options.decode else uni.straighten
    steps: list[tuple[Step | None, Step]] = [
        (None, lambda c: decode(F.coalesce(c.cast("string"), F.lit("")))),
        (_has_any("<"), strip_tags),
        (_has_any("@"), mask_emails),
        (
            _has_any("://", "ww.", "wW.", "Ww.", "WW."),
            mask_urls if options.replace_urls else drop_urls,
        ),
    ]
    if options.remove_source_markers:
        steps += [(_has_any(")"), strip_source_prefix), (None, strip_source_markers)]
    if options.lowercase:
        steps.append((None, F.lower))
    steps += [(_has_any("'", "cannot"), expand_contractions), (None, collapse_repeats)]
    if options.replace_numbers:
        steps.append((None, mask_numbers))
    return [*steps, (None, keep_text)]


def normalize(text: Column, options: TextOptions = TextOptions()) -> Column:
    """The whole normaliser as one expression."""
    for _, step in normalization_steps(options):
        text = step(text)
    return text


def with_normalized(
    df: DataFrame, columns: dict[str, str], options: TextOptions = TextOptions()
) -> DataFrame:
    """Add normalised columns (source -> target), one guarded projection per step."""
    df = df.withColumns({target: F.col(source) for source, target in columns.items()})
    for guard, step in normalization_steps(options):
        changed = {}
        for target in columns.values():
            current = F.col(target)
            changed[target] = step(current)
            if guard is not None:
                changed[target] = F.when(guard(current), step(current)).otherwise(current)
        df = df.withColumns(changed)
    return df


def combine(title: Column, body: Column, separator: str = SEPARATOR) -> Column:
    """Stripped title, separator token, stripped body."""
    empty = F.lit("")
    return strip(
        F.concat(
            strip(F.coalesce(title, empty)), F.lit(separator), strip(F.coalesce(body, empty))
        )
    )


def fingerprint(normalized: Column) -> Column:
    """SHA-256 of an already normalised text."""
    return F.sha2(normalized, 256)


def title_group(normalized_title: Column, fallback: Column, words: int = 30) -> Column:
    """Hash of the first words of the normalised title, or of ``fallback`` when it is empty."""
    key = F.substring_index(normalized_title, " ", words)
    return F.sha2(F.when(key == "", fallback).otherwise(key), 256)
