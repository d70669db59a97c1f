"""Train/validation/test assignment, folds, and their audits.

Assignments are map-only: exact cut points are found first from counts (``order_statistics``),
then every row compares its own key with them. The wide table is never sorted or shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.config import SplitOptions
from corpuslens.functions import text as tx
from corpuslens.functions.dates import parse_date
from corpuslens.functions.hashing import seeded, unit
from corpuslens.operators.order import below, order_statistics
from corpuslens.sources.tables import materialize

SPLITS = ("train", "validation", "test")
_LAST = (1 << 62) - 1


@dataclass(frozen=True)
class Assigned:
    """Rows with ``split``, and the strategy that was asked for and the one that applied."""

    rows: DataFrame
    requested: str
    applied: str


def with_title_group(df: DataFrame) -> DataFrame:
    """Add ``title_group``: titles that agree in their first words stay together."""
    group = tx.title_group(F.col("__title"), F.col("document_hash"))
    named = tx.with_normalized(df, {"title": "__title"})
    return named.withColumn("title_group", group).drop("__title")


def _by_share(position: Column, o: SplitOptions) -> Column:
    return (
        F.when(position < o.train_size, "train")
        .when(position < o.train_size + o.validation_size, "validation")
        .otherwise("test")
    )


def split_groups(df: DataFrame, o: SplitOptions = SplitOptions()) -> DataFrame:
    """Duplicate-safe split: each title group hashes to a position in [0, 1)."""
    grouped = df if "title_group" in df.columns else with_title_group(df)
    return grouped.withColumn("split", _by_share(unit(seeded(F.col("title_group"), o.seed)), o))


def _sizes(total: int, o: SplitOptions) -> tuple[int, int]:
    """Training and validation rows of one class."""
    train = int(total * o.train_size)
    rest = total - train
    relative = o.test_size / (o.validation_size + o.test_size)
    return train, rest - math.ceil(rest * relative)


def _class_counts(df: DataFrame) -> dict[int, int]:
    return {r["label"]: r["n"] for r in df.groupBy("label").agg(F.count("*").alias("n")).collect()}


def _order_keys(df: DataFrame, seed: int) -> DataFrame:
    return df.withColumn("__hash", seeded(F.col("row_id"), seed))


def _class_cuts(df: DataFrame, per_class: dict[int, list[int]], seed: int) -> dict:
    """Cut keys (hash, id) per label for ranks counted inside the label."""
    counts = _class_counts(df)
    start, wanted = 0, {}
    for label in sorted(counts):
        for rank in per_class[label]:
            if rank < counts[label]:
                wanted[(label, rank)] = start + rank
        start += counts[label]
    keys = ["label", "__hash", "row_id"]
    narrow = _order_keys(df.select("label", "row_id"), seed)
    found = order_statistics(narrow, keys, list(wanted.values())) if wanted else {}
    return {key: found[rank][1:] for key, rank in wanted.items()}


def _before(label: int, rank: int, cuts: dict) -> Column:
    """Rows of ``label`` that come before ``rank``; all of them when the rank is past the end."""
    inside = F.col("label") == label
    cut = cuts.get((label, rank))
    return inside if cut is None else inside & below(["__hash", "row_id"], cut)


def split_stratified(df: DataFrame, o: SplitOptions = SplitOptions()) -> DataFrame:
    """Exact quotas inside every label, in seeded hash order. Needs non-null labels."""
    counts = _class_counts(df)
    ends = {}
    for label, total in counts.items():
        train, validation = _sizes(total, o)
        ends[label] = [train, train + validation]
    cuts = _class_cuts(df, ends, o.seed)
    chosen = F.lit("test")
    for name, position in (("validation", 1), ("train", 0)):
        for label in sorted(counts):
            chosen = F.when(_before(label, ends[label][position], cuts), name).otherwise(chosen)
    return _order_keys(df, o.seed).withColumn("split", chosen).drop("__hash")


def assign_folds(df: DataFrame, folds: int, seed: int = 42, column: str = "fold") -> DataFrame:
    """Stratified folds: equal runs of the seeded hash order inside every label.

    The number of folds is limited by the smallest class; fewer than two gives fold null.
    """
    counts = _class_counts(df)
    effective = min([folds, *counts.values()]) if counts else 0
    if effective < 2:
        return df.withColumn(column, F.lit(None).cast("int"))
    ends = {}
    for label, total in counts.items():
        base, extra = divmod(total, effective)
        sizes = [base + (i < extra) for i in range(effective)]
        ends[label] = [sum(sizes[: i + 1]) for i in range(effective - 1)]
    cuts = _class_cuts(df, ends, seed)
    chosen = F.lit(effective - 1)
    for fold in reversed(range(effective - 1)):
        for label in sorted(counts):
            chosen = F.when(_before(label, ends[label][fold], cuts), fold).otherwise(chosen)
    return _order_keys(df, seed).withColumn(column, chosen.cast("int")).drop("__hash")


def valid_date_share(df: DataFrame, date: str = "date") -> float:
    share = df.agg(F.avg(parse_date(F.col(date)).isNotNull().cast("double"))).first()[0]
    return share or 0.0


def split_by_time(df: DataFrame, o: SplitOptions = SplitOptions(), date: str = "date") -> DataFrame:
    """Oldest rows train, newest test; undated rows come last; ties by ``row_id``."""
    moment = F.coalesce(F.unix_micros(parse_date(F.col(date))), F.lit(_LAST))
    keyed = df.withColumn("__moment", moment)
    # Two numbers per row, written once: dates are parsed once for all counting passes.
    narrow = materialize(keyed.select("__moment", "row_id"), "moments")
    total = narrow.count()
    train = int(total * o.train_size)
    ends = [train, train + int(total * o.validation_size)]
    found = order_statistics(narrow, ["__moment", "row_id"], [e for e in ends if e < total])
    chosen = F.lit("test")
    for name, end in (("validation", ends[1]), ("train", ends[0])):
        inside = below(["__moment", "row_id"], found[end]) if end < total else F.lit(True)
        chosen = F.when(inside, name).otherwise(chosen)
    return keyed.withColumn("split", chosen).drop("__moment")


def assign_splits(df: DataFrame, o: SplitOptions = SplitOptions()) -> Assigned:
    """Dispatch on the strategy; time-aware falls back when dates are missing or mostly invalid."""
    if o.strategy == "time_aware" and "date" in df.columns:
        if valid_date_share(df) >= o.minimum_valid_dates:
            return Assigned(split_by_time(df, o), o.strategy, "time_aware")
    if o.strategy == "baseline":
        return Assigned(split_stratified(df, o), o.strategy, "baseline")
    return Assigned(split_groups(df, o), o.strategy, "duplicate_safe")


def split_summary(df: DataFrame) -> DataFrame:
    """Rows, classes and date range per split; every split is listed."""
    names = F.array(*[F.lit(s) for s in SPLITS])
    named = df.sparkSession.range(1).select(F.explode(names).alias("split"))
    dated = "date" in df.columns
    moment = parse_date(F.col("date")) if dated else F.lit(None).cast("timestamp")
    summary = (
        df.withColumn("__moment", moment)
        .groupBy("split")
        .agg(
            F.count("*").alias("rows"),
            F.count_if(F.col("label") == 0).alias("class_0"),
            F.count_if(F.col("label") == 1).alias("class_1"),
            F.min("__moment").alias("date_min"),
            F.max("__moment").alias("date_max"),
        )
    )
    return named.join(F.broadcast(summary), "split", "left").na.fill(0, ["rows", "class_0", "class_1"])


def split_overlap(df: DataFrame) -> DataFrame:
    """Document hashes shared by each pair of splits, in one pass."""
    seen = df.groupBy("document_hash").agg(
        *[F.bool_or(F.col("split") == s).alias(s) for s in SPLITS]
    )
    train, validation, test = (F.col(s) for s in SPLITS)
    return seen.agg(
        F.count_if(train & validation).alias("train_validation"),
        F.count_if(train & test).alias("train_test"),
        F.count_if(validation & test).alias("validation_test"),
    )


def split_pivot(df: DataFrame) -> DataFrame:
    """Rows per split and label, one column per label."""
    return (
        df.groupBy("split")
        .pivot("label", [0, 1])
        .count()
        .na.fill(0)
        .withColumnsRenamed({"0": "label_0", "1": "label_1"})
    )


def split_rolling(df: DataFrame, windows: int = 4, span: int | None = None, date: str = "date") -> DataFrame:
    """Rolling evaluation: ``window`` and ``split`` (train or test) beside each row, once for every window it is in.

    Time is cut into ``windows + 1`` equal runs of rows. Window w tests on run w + 1 and trains on all runs before it,
    or on the last ``span`` ones. Undated rows come last, ties go by ``row_id``. The cuts come from one
    ``order_statistics`` call; each row finds its windows by comparing its own key with them.
    """
    moment = F.coalesce(F.unix_micros(parse_date(F.col(date))), F.lit(_LAST))
    keyed = df.withColumn("__moment", moment)
    narrow = materialize(keyed.select("__moment", "row_id"), "moments")
    keys, total = ["__moment", "row_id"], narrow.count()
    ranks = [total * k // (windows + 1) for k in range(1, windows + 1)]
    found = order_statistics(narrow, keys, [r for r in ranks if r < total])
    run = F.lit(0)
    for rank in ranks:
        inside = below(keys, found[rank]) if rank < total else F.lit(True)
        run = run + F.when(inside, 0).otherwise(1)
    places = []
    for window in range(windows):
        train = F.col("__run") <= window
        if span is not None:
            train = train & (F.col("__run") > window - span)
        part = F.when(F.col("__run") == window + 1, "test").when(train, "train")
        places.append(F.struct(F.lit(window).alias("window"), part.alias("split")))
    rows = keyed.withColumn("__run", run).withColumn("__place", F.explode(F.filter(F.array(*places), lambda p: p["split"].isNotNull())))
    return rows.select(*df.columns, "__place.window", "__place.split")


def split_sources(df: DataFrame, o: SplitOptions = SplitOptions(), source: str = "subject", heavy: float = 0.001) -> DataFrame:
    """Source-held-out split: all rows of a source are in one split, near the wanted shares.

    Sources with at least the share ``heavy`` of the rows (at most 1 / ``heavy`` of them) go one by one, the largest
    first, to the split that lacks most rows; ties go to the smaller name and the earlier split. The others go by a seeded hash in
    proportion to what is then lacking. Rows without a source form one of their own.
    """
    name = F.coalesce(F.col(source), F.lit(""))
    counts = df.groupBy(name.alias("__source")).agg(F.count("*").alias("n"))
    total = df.count()
    large = counts.filter(F.col("n") >= heavy * total).orderBy(F.col("n").desc(), "__source").collect()
    lacking = [share * total for share in (o.train_size, o.validation_size, o.test_size)]
    chosen = []
    for r in large:
        place = max(range(3), key=lambda k: (lacking[k], -k))
        lacking[place] -= r["n"]
        chosen.append((r["__source"], SPLITS[place]))
    rest = [max(0.0, x) for x in lacking]
    whole = sum(rest) or 1.0
    position = unit(seeded(F.col("__source"), o.seed))
    light = (
        F.when(position < rest[0] / whole, SPLITS[0])
        .when(position < (rest[0] + rest[1]) / whole, SPLITS[1])
        .otherwise(SPLITS[2])
    )
    table = df.sparkSession.createDataFrame(chosen, "__source string, __split string")
    rows = df.withColumn("__source", name).join(F.broadcast(table), "__source", "left")
    return rows.withColumn("split", F.coalesce("__split", light)).select(*df.columns, "split")
