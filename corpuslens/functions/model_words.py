"""Model words of single words between spaces, in Python.

The words of a text are those of its parts between spaces: a model word holds no space, and at its edges a space is as good as
an end. So tasks that have the distinct parts of many texts need the pattern for each of them once.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from corpuslens.functions import unicode as uni

# The patterns of ``tokens.MODEL_TOKEN`` and ``unicode.COMBINING``; ``\w`` is a letter, a number or the underscore.
_TOKEN = re.compile(r"(?<!\w)[a-zA-Z][a-zA-Z'-]+(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))")
_COMBINING = re.compile("[" + "".join(f"{chr(low)}-{chr(high)}" for low, high in uni.COMBINING_SPANS) + "]+")
_PLAIN = str.maketrans(uni.ACCENTED, uni.UNACCENTED)


@dataclass(frozen=True)
class ModelWords:
    """``tokens.model_tokens`` without stop words, of a lower-cased part of a text."""

    accents: bool
    stop: frozenset[str]

    def __call__(self, part: str) -> list[str]:
        if self.accents and not part.isascii():
            part = _COMBINING.sub("", part.translate(_PLAIN))
        return [t for t in _TOKEN.findall(part) if t not in self.stop]
