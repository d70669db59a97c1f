"""Token totals by source, language and tokenizer version, kept up to date by signed deltas.

A batch of changes (inserts, deletes, revised counts) becomes one small table of signed sums, written to a folder
named by the batch id. Writing the same batch again replaces that folder, so a commit may be repeated after any
failure. Totals are the sum of a snapshot and of the batches it does not cover; ``compact`` moves
batches into the next snapshot. Sums are additive, so batches may be committed in any order.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "tokenizer")
DELTA = "source string, lang string, tokenizer string, docs long, tokens long, changes long"

#: Tokenizer versions that need no vocabulary: words between white space, and words of letters and digits.
WORD_COUNTS = {
    "space-1": r"[^\x20\x09-\x0D]+",
    "alnum-1": r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+",
}


def word_count(text: Column, version: str) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_COUNTS[version])).cast("long")


def inserts(rows: DataFrame) -> DataFrame:
    """Changes from rows with source, lang, tokenizer, tokens: one more document each."""
    return rows.select(*KEYS, F.lit(1).alias("docs"), "tokens")


def deletes(rows: DataFrame) -> DataFrame:
    return rows.select(*KEYS, F.lit(-1).alias("docs"), (-F.col("tokens")).alias("tokens"))


def revisions(rows: DataFrame) -> DataFrame:
    """Changes from rows with the count before (``was``) and the count now (``tokens``)."""
    return rows.select(*KEYS, F.lit(0).alias("docs"), (F.col("tokens") - F.col("was")).alias("tokens"))


@dataclass
class Rollup:
    spark: SparkSession
    root: str

    def commit(self, batch: str, changes: DataFrame) -> None:
        """Write a batch's signed sums. A hot source is summed in each task before anything is moved.

        Null counts add nothing; null keys form groups of their own. A batch without changes is committed too. Rows
        may repeat and may have other columns; only keys, docs and tokens are read.
        """
        if not re.fullmatch(r"[\w-]+", batch):
            raise ValueError("a batch id has letters, digits, _ and - only")
        sums = changes.groupBy(*KEYS).agg(
            F.sum("docs").cast("long").alias("docs"), F.coalesce(F.sum("tokens"), F.lit(0)).cast("long").alias("tokens"), F.count("*").alias("changes"))
        sums.write.mode("overwrite").parquet(f"{self.root}/deltas/batch={batch}")

    def _read(self, folder: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).option("basePath", f"{self.root}/{folder}").parquet(f"{self.root}/{folder}")
        except Exception as problem:
            if "PATH_NOT_FOUND" not in str(problem):
                raise
            return self.spark.createDataFrame([], schema)

    def deltas(self) -> DataFrame:
        """Signed sums of every committed batch, with its id."""
        return self._read("deltas", f"{DELTA}, batch string")

    def snapshots(self) -> DataFrame:
        return self._read("snapshots", f"{DELTA}, batches array<string>, number int")

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, docs, tokens, changes over all batches, each once; no rows before the first batch."""
        number, covered = self._latest()
        return self._sum(number, self.deltas().where(~F.col("batch").isin(covered)) if covered else self.deltas())

    def _sum(self, number: int, batches: DataFrame) -> DataFrame:
        """Snapshot ``number`` (0 is none) and ``batches`` that it does not cover."""
        parts = batches.select(*KEYS, "docs", "tokens", "changes")
        if number:
            parts = parts.unionByName(self.snapshots().where(F.col("number") == number).where("changes IS NOT NULL").select(*KEYS, "docs", "tokens", "changes"))
        return parts.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in ("docs", "tokens", "changes")])

    def compact(self) -> None:
        """Write a snapshot of all batches committed so far; a later commit of one of them changes nothing.

        The batches are listed once, and the snapshot sums exactly those: one that is committed meanwhile stays open.
        Compactions of one book must not run side by side. The list grows with the number of batches, not with rows.
        """
        number, covered = self._latest()
        fresh = sorted({r[0] for r in self.deltas().select("batch").distinct().collect()} - set(covered))
        batches = sorted({*covered, *fresh})
        listed = F.array(*[F.lit(b) for b in batches]) if batches else F.array().cast("array<string>")
        marker = self.spark.range(1).select(*[F.lit(None).cast(kind).alias(name) for name, kind in (c.split() for c in DELTA.split(", "))])
        summed = self._sum(number, self.deltas().where(F.col("batch").isin(fresh)))
        # the marker alone carries the list, so that rows do not repeat it
        rows = summed.withColumn("batches", F.lit(None).cast("array<string>")).unionByName(marker.withColumn("batches", listed))
        rows.write.mode("overwrite").parquet(f"{self.root}/snapshots/number={number + 1}")

    def _latest(self) -> tuple[int, list[str]]:
        """Number of the newest snapshot and the batches in it (0 and none before the first)."""
        last = self.snapshots().where("changes IS NULL").orderBy(F.desc("number")).limit(1).collect()
        return (last[0]["number"], list(last[0]["batches"])) if last else (0, [])


def counted(docs: DataFrame, versions: tuple[str, ...] = tuple(WORD_COUNTS)) -> DataFrame:
    """One row per document and tokenizer version: doc_id, source, lang, n_chars, tokenizer, tokens.

    Null and empty texts count 0; repeated rows count each time; an empty table gives an empty result. Other columns
    are not read.
    """
    each = F.explode(F.array(*[F.struct(F.lit(v).alias("tokenizer"), word_count(F.col("text"), v).alias("tokens")) for v in versions]))
    return docs.select("doc_id", "source", "lang", "n_chars", each.alias("count")).select("doc_id", "source", "lang", "n_chars", "count.tokenizer", "count.tokens")


def vocabulary_counts(docs: DataFrame, path: str, version: str) -> DataFrame:
    """doc_id, source, lang, tokenizer and the number of ids that a tokenizer file gives; cases as in ``counted``."""
    from corpuslens.llm.packing import id_counts

    return id_counts(docs, path).withColumn("tokenizer", F.lit(version))
