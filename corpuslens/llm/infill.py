"""Fill-in-the-middle transformation by repeated-capture matching.

One ``fullmatch`` of ``(unit)*`` with the ``regex`` library walks a text once and keeps every repetition of its
group: ``ends(1)`` is the list of unit ends, so its length is the number of units and two look-ups give both cuts.
A match holds about 200 bytes for each unit of the text at hand. Only cuts come back from Python; form, output and
restored text are JVM expressions over the text, which never leaves its row.

Cases: a null text counts as empty and stays plain; a null key hashes as an empty one; rows are independent, so repeated
rows give repeated results and an empty table an empty result; other columns stay, ``into`` must be a free name.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.llm.common import fresh_name

#: Lines with their line ends. Possessive, since a unit taken is never given back.
LINE = r"[^\n]*+\n|[^\n]++"
SEED, RATE, SPM_SHARE = 7, 100, 50
PLAIN, PSM, SPM = "plain", "psm", "spm"

CUT = T.StructType([T.StructField("n", T.LongType()), T.StructField("first", T.IntegerType()), T.StructField("second", T.IntegerType())])


@dataclass(frozen=True)
class Markers:
    """Marker strings. No marker may be a part of another one or overlap with itself."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    @property
    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def cuts(pattern, text: str, one: int, other: int) -> tuple[int, int, int]:
    """Number of units, and the code points before the middle and before the suffix.

    The cuts stand after ``one`` and ``other`` modulo (units + 1) units, the smaller first.
    """
    match = pattern.fullmatch(text)
    if match is None:
        raise ValueError("the unit pattern must cover every text from start to end")
    ends = match.ends(1)
    first, second = sorted((one % (len(ends) + 1), other % (len(ends) + 1)))
    return len(ends), ends[first - 1] if first else 0, ends[second - 1] if second else 0


def cutter(unit: str):
    """Arrow function (text, hash, hash) -> ``CUT``."""
    whole = f"({unit})*+"

    @F.arrow_udf(CUT)
    def cut(text: pa.Array, one: pa.Array, other: pa.Array) -> pa.Array:
        import regex

        pattern = regex.compile(whole)
        found = [cuts(pattern, t.as_py(), a, b) for t, a, b in zip(text, one.to_pylist(), other.to_pylist())]
        n, first, second = zip(*found) if found else ((), (), ())
        columns = [pa.array(n, pa.int64()), pa.array(first, pa.int32()), pa.array(second, pa.int32())]
        return pa.StructArray.from_arrays(columns, names=CUT.names)

    return cut


def hashes(key: Column, seed: int) -> list[Column]:
    """The first four groups of eight hex digits of the SHA-256 of ``seed:key`` as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transform(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", seed: int = SEED, rate: int = RATE,
    spm_share: int = SPM_SHARE, unit: str = LINE, markers: Markers = Markers(), into: str = "infill",
) -> DataFrame:
    """All columns and a struct ``into``: n (units), form, prefix_chars, middle_chars, output.

    The form is plain where the text is empty, contains a marker or its third hash falls outside ``rate`` percent; the
    lengths are null there and the output is the text. Else ``spm_share`` percent by the fourth hash are
    suffix-prefix-middle, the others prefix-suffix-middle.
    """
    whole, cut, form = (fresh_name(name, docs.columns) for name in ("whole", "cut", "form"))
    h1, h2, h3, h4 = hashes(F.col(key), seed)
    rows = docs.withColumn(whole, F.coalesce(F.col(text), F.lit("")))
    rows = rows.withColumn(cut, cutter(unit)(F.col(whole), h1, h2))
    body = F.col(whole)
    plain = (body == "") | (h3 % 100 >= rate)
    for marker in markers.all:
        plain = plain | F.contains(body, F.lit(marker))
    rows = rows.withColumn(form, F.when(plain, PLAIN).when(h4 % 100 < spm_share, SPM).otherwise(PSM))
    first, second = F.col(cut)["first"], F.col(cut)["second"]
    prefix = F.substring(body, F.lit(1), first)
    middle = F.substring(body, first + 1, second - first)
    suffix = F.substring(body, second + 1, F.lit(2**31 - 1))
    p, s, m = (F.lit(marker) for marker in markers.all)
    output = (
        F.when(F.col(form) == PSM, F.concat(p, prefix, s, suffix, m, middle))
        .when(F.col(form) == SPM, F.concat(s, suffix, p, prefix, m, middle))
        .otherwise(body)
    )
    changed = F.col(form) != PLAIN
    made = F.struct(
        F.col(cut)["n"].alias("n"), F.col(form).alias("form"),
        F.when(changed, first.cast("long")).alias("prefix_chars"),
        F.when(changed, (second - first).cast("long")).alias("middle_chars"),
        output.alias("output"),
    )
    return rows.select(*docs.columns, made.alias(into))


def restore(form: Column, output: Column, markers: Markers = Markers()) -> Column:
    """The text an output was made of. Markers do not occur in its parts, so the first ones are the true ones."""
    p, s, m = markers.all

    def parts(opening: str, between: str) -> tuple[Column, Column, Column]:
        body = F.substring(output, F.lit(len(opening) + 1), F.lit(2**31 - 1))
        one = F.substring_index(body, between, 1)
        rest = F.substring(body, F.length(one) + len(between) + 1, F.lit(2**31 - 1))
        two = F.substring_index(rest, m, 1)
        return one, two, F.substring(rest, F.length(two) + len(m) + 1, F.lit(2**31 - 1))

    prefix, suffix, middle = parts(p, s)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(s, p)
    return F.when(form == PSM, psm).when(form == SPM, F.concat(prefix, middle, suffix)).otherwise(output)
