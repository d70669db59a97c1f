"""CSV input bound by header names, with a whole-file fallback to Latin-1, and labelled union of sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.errors import DataContractError

#: Columns that the articles may bring; more stay as they are.
REQUIRED = ("title", "text")
OPTIONAL = ("subject", "date")


def file_encodings(spark: SparkSession, path: str) -> DataFrame:
    """Folder-safe path of every file under ``path`` and whether all its bytes are UTF-8.

    The text source keeps raw bytes, so the check is one splittable scan that ends in a row per file.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.is_valid_utf8("value").alias("good"))
    return lines.groupBy("file").agg(F.bool_and("good").alias("utf8"))


def _plain(uri: str) -> str:
    """The metadata column quotes blanks and the like; readers want the path itself."""
    from urllib.parse import unquote

    return unquote(uri)


def read_articles(spark: SparkSession, path: str, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """Article CSV with a header and quoted line breaks; Latin-1 for files that are not UTF-8.

    Columns are found by their names, in any order and in each file; all are read as text, spellings such as
    ``NA`` too, and empty fields are null. A missing required column raises an error, missing optional ones are null.
    A quoted line break keeps a file from being split; convert large inputs to Parquet once. One line
    per file reaches the driver.
    """
    try:
        files = file_encodings(spark, path).collect()
    except Exception as problem:
        if "PATH_NOT_FOUND" in str(problem):
            raise DataContractError(f"no such input: {path}") from problem
        raise

    def scan(encoding: str, paths: list[str]) -> list[DataFrame]:
        # files of one folder may differ in their headers, and the reader looks at one header only
        reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", encoding)
        groups: dict[tuple[str, ...], list[str]] = {}
        for name in paths:
            groups.setdefault(tuple(reader.csv(name).columns), []).append(name)
        return [reader.csv(names) for names in groups.values()]

    parts = []
    for encoding, wanted in (("UTF-8", True), ("ISO-8859-1", False)):
        parts += scan(encoding, sorted(_plain(r["file"]) for r in files if bool(r["utf8"]) == wanted))
    if not parts:
        raise DataContractError(f"no rows and no header: {path}")
    for part in parts:
        lacking = sorted(set(required) - set(part.columns))
        if lacking:
            raise DataContractError(f"a file has no column {' or '.join(lacking)}: {part.inputFiles()[0]}")
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return merged.withColumns({c: F.lit(None).cast("string") for c in OPTIONAL if c not in merged.columns})


def label_and_union(sources: dict[int, DataFrame]) -> DataFrame:
    """Attach a constant label per source and align columns."""
    labelled = [df.withColumn("label", F.lit(label)) for label, df in sorted(sources.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), labelled)
