"""Label leakage audit: known markers and class-associated terms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.functions import tokens as tk
from corpuslens.functions.stopwords import ENGLISH
from corpuslens.functions.unicode import WORD as _W

# Audited markers, whether the normaliser removes them, and report wording.
PATTERNS = {
    "reuters_marker": rf"(?iu)(?<![{_W}])reuters(?![{_W}])",
    "associated_press_marker": rf"(?iu)(?<![{_W}])associated press(?![{_W}])",
    "url": r"(?iu)(?:https?://|www\.)",
    "copyright": rf"(?iu)(?<![{_W}])copyright(?![{_W}])",
    "date_pattern": (
        rf"(?iu)(?<![{_W}])(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)"
        rf"[{_W}]* \p{{Nd}}{{1,2}}, \p{{Nd}}{{4}}(?![{_W}])"
    ),
}
REMOVED = ("reuters_marker", "associated_press_marker", "copyright")
REMOVED_REASON = "Removed as likely source/boilerplate leakage."
RETAINED_REASON = "Normalized or retained because it may carry legitimate context."
REVIEW_STATUS = "flagged_for_manual_review"
MITIGATION = (
    "Raw file origin is never supplied as a feature.",
    "Subject and date are excluded from the modeling pipeline.",
    "Known agency and copyright markers are removed by the persisted preprocessor.",
    "Normalized duplicates and contradictory duplicate labels are removed before splitting.",
    "The default split groups identical normalized documents together.",
)


def known_patterns(df: DataFrame) -> DataFrame:
    """Rows per class that contain each marker: one pass, one small aggregate."""
    counts = []
    for name, pattern in PATTERNS.items():
        hit = F.col("content").rlike(pattern)
        for label in (0, 1):
            counts.append(F.count_if(hit & (F.col("label") == label)).alias(f"{name}_{label}"))
    wide = df.agg(*counts)
    lines = [
        F.struct(
            F.lit(name).alias("feature"),
            F.col(f"{name}_0").alias("fake_rows"),
            F.col(f"{name}_1").alias("real_rows"),
            F.lit(name in REMOVED).alias("removed"),
            F.lit(REMOVED_REASON if name in REMOVED else RETAINED_REASON).alias("reason"),
        )
        for name in PATTERNS
    ]
    return wide.select(F.inline(F.array(*lines)))


def mitigation_notes(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    return spark.createDataFrame(list(enumerate(MITIGATION, 1)), "position int, statement string")


def term_frequencies(
    df: DataFrame,
    *,
    minimum_df: int = 10,
    max_features: int = 25_000,
    stop_words: tuple[str, ...] = ENGLISH,
) -> DataFrame:
    """Documents per class containing each 1-2-gram; the most frequent ``max_features`` terms."""
    words = tk.drop_stop_words(tk.report_tokens(F.col("content")), stop_words)
    grams = F.array_distinct(tk.ngram_range(F.col("words"), 1, 2))
    terms = (
        df.select("label", words.alias("words"))
        .select("label", F.explode_outer(grams).alias("term"))
        .filter(F.col("term").isNotNull())
    )
    counted = terms.groupBy("term").agg(
        F.count_if(F.col("label") == 0).alias("fake_documents"),
        F.count_if(F.col("label") == 1).alias("real_documents"),
    )
    total = F.col("fake_documents") + F.col("real_documents")
    return (
        counted.filter(total >= minimum_df).orderBy(total.desc(), F.col("term")).limit(max_features)
    )


def associated_terms(frequencies: DataFrame, top_n: int = 30) -> DataFrame:
    """Terms whose smoothed class share departs most from one half, weighted by frequency."""
    fake, real = F.col("fake_documents"), F.col("real_documents")
    share = (real + 1) / (fake + real + 2)
    score = F.abs(share - 0.5) * F.log1p(fake + real)
    return (
        frequencies.select(
            F.col("term").alias("feature"),
            fake,
            real,
            F.bround(share, 4).alias("real_share_smoothed"),
            F.round(score, 9).alias("association"),
            F.lit(REVIEW_STATUS).alias("review_status"),
        )
        .orderBy(F.col("association").desc(), F.col("feature"))
        .limit(top_n)
    )
