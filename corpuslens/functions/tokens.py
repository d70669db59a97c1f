"""Tokenisers and n-grams as array expressions; nothing here explodes or shuffles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuslens.functions.unicode import WORD as _W
from corpuslens.functions.unicode import strip_accents

_EDGE = rf"(?:(?<=[{_W}])(?![{_W}])|(?<![{_W}])(?=[{_W}]))"

# Token patterns of model words, of report words and of the input gate.
MODEL_TOKEN = rf"(?<![{_W}])[a-zA-Z][a-zA-Z'-]+{_EDGE}"
REPORT_TOKEN = rf"[{_W}]{{2,}}"
GATE_TOKEN = rf"{_EDGE}[{_W}'-]+{_EDGE}"


def _all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def model_tokens(clean: Column, accents: bool = True) -> Column:
    """Words of a normalised text for features."""
    lowered = F.lower(clean)
    return _all(strip_accents(lowered) if accents else lowered, MODEL_TOKEN)


def report_tokens(text: Column) -> Column:
    """Lower-cased runs of two or more word characters, for audits and profiles."""
    return _all(F.lower(text), REPORT_TOKEN)


def gate_tokens(text: Column) -> Column:
    """Words counted by the input gate (case kept)."""
    return _all(text, GATE_TOKEN)


def drop_stop_words(tokens: Column, words: tuple[str, ...]) -> Column:
    """Remove stop words, keeping order and repeats."""
    return F.filter(tokens, lambda t: ~t.isin(*words)) if words else tokens


def ngrams(tokens: Column, n: int) -> Column:
    """Space-joined runs of ``n`` neighbouring tokens."""
    if n == 1:
        return tokens
    span = F.greatest(F.size(tokens) - F.lit(n - 1), F.lit(0))
    return reduce(
        lambda left, right: F.zip_with(left, right, lambda a, b: F.concat_ws(" ", a, b)),
        [F.slice(tokens, F.lit(i + 1), span) for i in range(n)],
    )


def ngram_range(tokens: Column, low: int, high: int) -> Column:
    """All n-grams for n in ``low..high``."""
    grams = [ngrams(tokens, n) for n in range(low, high + 1)]
    return grams[0] if len(grams) == 1 else F.concat(*grams)


def char_ngrams(clean: Column, low: int = 3, high: int = 5) -> Column:
    """Character n-grams inside words padded with one space on each side.

    Normalised text has single spaces, so an n-gram of a padded word is a window whose inner
    characters are not spaces. A zero-width match reads each window while consuming one character,
    which is linear in the text however long a word is.
    """
    padded = F.concat(F.lit(" "), F.lower(clean), F.lit(" "))
    if low < 2:
        raise ValueError("character n-grams need at least two characters")
    # Two spaces in a row only occur around an empty text.
    grams = [
        _all(padded, rf"(?s)(?! {{2}})(?=(.[^ ]{{{n - 2}}}.)).", 1) for n in range(low, high + 1)
    ]
    if low > 3:
        # A padded word shorter than the smallest n counts once, whole.
        grams.append(_all(padded, rf"(?s)(?=( [^ ]{{1,{low - 3}}} )).", 1))
    return F.concat(*grams)
