"""Input checks, scoring, explanation and error analysis.

Coefficients come from the SHA-256 of each term, so that SQL can restate the whole computation.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import functions as F

from corpuslens.config import NEGATIONS, ScoringOptions
from corpuslens.operators import error_analysis as ea
from corpuslens.operators import explain as ex
from corpuslens.operators import score as sc
from corpuslens.operators.models import LinearModel
from corpuslens.operators.split import assign_folds
from corpuslens.operators.features import fit_features
from corpuslens.plans.queries import fixtures as fx
from corpuslens.plans.queries.features import (
    FITTED,
    TRAIN,
    cleaned,
    fitted,
    tfidf_ctes,
    vocabulary_ctes,
)
from corpuslens.plans.queries.registry import query, r6

INTERCEPT = 0.05


def coefficient(space: str, term: str) -> float:
    prefix = hashlib.sha256(f"{space}|{term}".encode()).hexdigest()[:15]
    return (int(prefix, 16) / float(1 << 60) - 0.5) * 4.0


def coefficient_sql(space: str = "space", term: str = "term") -> str:
    hashed = fx.hash60_sql(f"{space} || '|' || {term}")
    return f"(({hashed} / pow(2.0::DOUBLE, 60) - 0.5::DOUBLE) * 4.0::DOUBLE)"


def hashed_linear(features, link: str = "sigmoid") -> LinearModel:
    weights = np.array([coefficient(s, t) for s, t in features.names])
    return LinearModel("hashed", weights, INTERCEPT, link)


def _model(rows, link: str = "sigmoid") -> sc.TextModel:
    features = fitted(rows)
    return sc.TextModel((sc.Member(features, hashed_linear(features, link)),), version="1.0.0")


# ---- input gate ------------------------------------------------------------------------------

_LIMITS = ScoringOptions(maximum_characters=400)
# ASCII word edges in RE2: other letters and digits become '_' first.
_GATE_TEXT = fx.sub("input", r"[\p{L}\p{N}]", "_")
_GATE = fx.quote(r"\b[_'-]+\b")
_REQUESTS = f"""requests AS (
  SELECT conv_id, turn, CASE turn % 3 WHEN 1 THEN repeat('word ', 6) WHEN 2 THEN '  ' ELSE text END AS text
  FROM conversations
  UNION ALL SELECT conv_id, -1 - turn, text FROM conversations
  UNION ALL SELECT conv_id, 1000 + turn, '?! ...' FROM conversations),
inputs AS (SELECT conv_id, turn, {fx.strip_sql("coalesce(text, '')")} AS input FROM requests),
gate AS (
  SELECT *, len(regexp_extract_all({_GATE_TEXT}, {_GATE})) AS words,
    length({fx.sub('input', '[^A-Za-z]', '')}) AS ascii_letters,
    length({fx.sub('input', r'[^\p{L}]', '')}) AS letters FROM inputs),
checked AS (
  SELECT *, CASE WHEN input = '' THEN {fx.quote(sc.BLANK)}
                 WHEN length(input) > {_LIMITS.maximum_characters}
                 THEN {fx.quote(sc.TOO_LONG.format(_LIMITS.maximum_characters))}
                 WHEN words = 0 THEN {fx.quote(sc.NO_WORDS)} END AS reject_reason FROM gate)"""


def _requests(spark, sf_dir):
    """Conversation turns as they are, and repeated, blank and wordless variants of them."""
    talk = fx.table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    kind = F.col("turn") % 3
    variant = F.when(kind == 1, F.repeat(F.lit("word "), 6)).when(kind == 2, "  ").otherwise(F.col("text"))
    return (
        talk.withColumn("text", variant)
        .unionByName(talk.withColumn("turn", -1 - F.col("turn")))
        .unionByName(talk.withColumns({"turn": 1000 + F.col("turn"), "text": F.lit("?! ...")}))
    )


@query(
    "input_gate",
    f"""WITH {_REQUESTS} SELECT conv_id, turn, CAST(words AS INTEGER) AS word_count,
        CAST(length(input) AS INTEGER) AS character_count, reject_reason FROM checked""",
)
def input_gate(spark, sf_dir):
    checked = sc.assess(_requests(spark, sf_dir), "text", _LIMITS)
    return checked.select("conv_id", "turn", "word_count", "character_count", "reject_reason")


_REPEATED = "len(list_distinct(regexp_extract_all(lower(input), '[^ ]+'))) <= 2 AND words >= 5"
_SHORT_A, _SHORT_B = sc.SHORT.split("{}")


@query(
    "input_warnings",
    f"""WITH {_REQUESTS} SELECT conv_id, turn,
        CASE WHEN reject_reason IS NULL THEN array_to_string(list_filter([
          CASE WHEN words < 20 THEN {fx.quote(_SHORT_A)} || words || {fx.quote(_SHORT_B)} END,
          CASE WHEN letters > 0 AND ascii_letters::DOUBLE / letters < 0.55::DOUBLE THEN {fx.quote(sc.FOREIGN)} END,
          CASE WHEN {_REPEATED} THEN {fx.quote(sc.REPETITIVE)} END], lambda w: w IS NOT NULL), ' | ')
        END AS warnings FROM checked""",
)
def input_warnings(spark, sf_dir):
    checked = sc.assess(_requests(spark, sf_dir), "text", _LIMITS)
    return checked.select("conv_id", "turn", F.array_join("warnings", " | ").alias("warnings"))


# ---- scoring ---------------------------------------------------------------------------------

_SCORED = f"""scored AS MATERIALIZED (
  SELECT r.row_id, r.label, count(f.term) AS nnz,
         coalesce(sum(weight * {coefficient_sql('f.space', 'f.term')}), 0) + {INTERCEPT}::DOUBLE AS margin
  FROM split r LEFT JOIN tfidf f ON f.row_id = r.row_id GROUP BY 1, 2),
size AS (SELECT count(*)::DOUBLE AS vocab FROM vocab),
results AS (
  SELECT row_id, label, nnz, nnz / vocab AS coverage, 1 / (1 + exp(-margin)) AS p,
         CAST(margin > 0 AS INTEGER) AS prediction FROM scored, size)"""
_ALL = f"WITH {FITTED}, {tfidf_ctes('split')}, {_SCORED}"
_CONFIDENCE = "CASE WHEN prediction = 1 THEN p ELSE 1 - p END"
_BAND = (
    f"CASE WHEN {_CONFIDENCE} >= 0.85 THEN 'High' WHEN {_CONFIDENCE} >= 0.65 THEN 'Moderate' "
    "ELSE 'Low' END"
)

_TALK = f"""talk AS (SELECT conv_id * 1000 + turn AS row_id, {fx.strip_sql('text')} AS input FROM conversations),
part AS MATERIALIZED (SELECT row_id, input, {fx.normalize_sql('input')} AS clean FROM talk),
{tfidf_ctes('part')},
scored AS (
  SELECT r.row_id, r.input, count(f.term) AS nnz,
         coalesce(sum(weight * {coefficient_sql('f.space', 'f.term')}), 0) + {INTERCEPT}::DOUBLE AS margin
  FROM part r LEFT JOIN tfidf f ON f.row_id = r.row_id GROUP BY 1, 2),
size AS (SELECT count(*)::DOUBLE AS vocab FROM vocab),
results AS (SELECT *, 1 / (1 + exp(-margin)) AS p, CAST(margin > 0 AS INTEGER) AS prediction,
                   nnz / vocab AS coverage FROM scored, size)"""


@query(
    "score_batch",
    f"""WITH {FITTED}, {_TALK}
        SELECT row_id, prediction AS label, CASE prediction WHEN 1 THEN 'Real News' ELSE 'Fake News' END AS class_name,
          round({_CONFIDENCE}, 6) AS confidence, round(p, 6) AS probability_real, {_BAND} AS confidence_band,
          'probability' AS score_kind, CAST(length(input) AS INTEGER) AS characters,
          round(coverage, 6) AS coverage, coverage < 0.05::DOUBLE AS unfamiliar, '1.0.0' AS model_version
        FROM results""",
)
def score_batch(spark, sf_dir):
    """Every conversation turn scored with features learned on the articles."""
    model = _model(cleaned(spark, sf_dir))
    turns = fx.table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("row_id"), "text"
    )
    record = sc.predict(turns, model)
    return record.select(
        "row_id",
        F.col("label_predicted").alias("label"),
        "class_name",
        r6("estimated_model_probability").alias("confidence"),
        r6("probability_real").alias("probability_real"),
        "confidence_band",
        "score_kind",
        F.col("input_characters").alias("characters"),
        r6("explanation.vocabulary_coverage").alias("coverage"),
        F.array_contains("warnings", sc.UNFAMILIAR).alias("unfamiliar"),
        "model_version",
    )


@query("confidence_band", f"{_ALL} SELECT {_BAND} AS band, count(*) AS rows FROM results GROUP BY 1")
def confidence_band(spark, sf_dir):
    rows = cleaned(spark, sf_dir)
    model = _model(rows)
    scored = sc.scored_labels(rows, model)
    confidence = ea.confidence_of(F.col("prediction"), F.col("score"), model.score_kind)
    return scored.groupBy(sc.confidence_band(confidence).alias("band")).agg(F.count("*").alias("rows"))


@query("vocab_coverage", f"{_ALL} SELECT row_id, round(coverage, 6) AS coverage FROM results")
def vocab_coverage(spark, sf_dir):
    rows = cleaned(spark, sf_dir)
    scored = sc.with_scores(rows, _model(rows))
    return scored.select("row_id", r6("scored.coverage").alias("coverage"))


@query(
    "positive_scores",
    f"""{_ALL} SELECT row_id, round(p, 6) AS probability, round(margin, 6) AS decision_score
        FROM results JOIN scored USING (row_id)""",
)
def positive_scores(spark, sf_dir):
    """The same model read as probabilities and as margins."""
    rows = cleaned(spark, sf_dir)
    model = _model(rows)
    member = model.members[0]
    margins = sc.TextModel((sc.Member(member.features, hashed_linear(member.features, "margin")),))
    both = sc.with_all_scores(rows, {"a": model, "b": margins})
    return both.select(
        "row_id", r6("a.score").alias("probability"), r6("b.score").alias("decision_score")
    )


# ---- explanations ----------------------------------------------------------------------------

_TERMS = f"""parts AS (
  SELECT row_id, term, weight * {coefficient_sql()} AS c FROM tfidf
  WHERE space = 'word' AND length(trim(term)) > 1),
sided AS (SELECT row_id, term, abs(c) AS c, CASE WHEN c > 0 THEN 'real' ELSE 'fake' END AS direction
          FROM parts WHERE c <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY row_id, direction ORDER BY c DESC, term) AS rank
           FROM sided)"""


@query(
    "explain_local",
    f"""{_ALL}, {_TERMS} SELECT row_id, direction, CAST(rank AS INTEGER) AS rank, term AS feature,
        round(c, 6) AS contribution FROM placed WHERE rank <= 8""",
)
def explain_local(spark, sf_dir):
    rows = cleaned(spark, sf_dir)
    terms = ex.local_terms(rows, _model(rows), 8, "row_id")
    return terms.withColumn("contribution", r6("contribution"))


_FOLDED = f"""{TRAIN}, folded AS MATERIALIZED (
  SELECT *, ntile(3) OVER (PARTITION BY label ORDER BY {fx.hash60_sql("row_id || '|42'")}, row_id) - 1 AS fold
  FROM train)"""
_PARTS = ", ".join(
    f"""in{k} AS (SELECT * FROM folded WHERE fold <> {k}), {vocabulary_ctes(f'in{k}', f'vocab{k}')},
    {tfidf_ctes('split', f'vocab{k}', f'tfidf{k}')}"""
    for k in range(3)
)
_UNION = " UNION ALL ".join(
    f"""SELECT row_id, term, weight * {coefficient_sql()} AS c FROM tfidf{k}
        WHERE space = 'word' AND length(trim(term)) > 1"""
    for k in range(3)
)


@query(
    "explain_ensemble",
    f"""WITH {_FOLDED}, {_PARTS}, parts AS (SELECT row_id, term, avg(c) AS c FROM ({_UNION}) u GROUP BY 1, 2),
        sided AS (SELECT row_id, term, abs(c) AS c, CASE WHEN c > 0 THEN 'real' ELSE 'fake' END AS direction
          FROM parts WHERE c <> 0),
        placed AS (SELECT *, row_number() OVER (PARTITION BY row_id, direction ORDER BY c DESC, term) AS rank
          FROM sided)
        SELECT row_id, direction, CAST(rank AS INTEGER) AS rank, term AS feature, round(c, 6) AS contribution
        FROM placed WHERE rank <= 8""",
)
def explain_ensemble(spark, sf_dir):
    """Three fold vocabularies; a term's contribution is its mean over folds where it is active."""
    rows = cleaned(spark, sf_dir)
    folds = assign_folds(rows.filter(F.col("split") == "train"), 3)
    members = []
    for k in range(3):
        features = fit_features(folds.filter(F.col("fold") != k))
        members.append(sc.Member(features, hashed_linear(features)))
    terms = ex.local_terms(rows, sc.TextModel(tuple(members)), 8, "row_id")
    return terms.withColumn("contribution", r6("contribution"))


@query(
    "explain_global",
    f"""WITH {FITTED}, c AS (SELECT term, {coefficient_sql()} AS coefficient FROM vocab WHERE space = 'word')
        SELECT 'fake' AS class, term, round(coefficient, 6) AS coefficient FROM
          (SELECT * FROM c ORDER BY coefficient, term LIMIT 20) a
        UNION ALL SELECT 'real', term, round(coefficient, 6) FROM
          (SELECT * FROM c ORDER BY coefficient DESC, term LIMIT 20) b""",
)
def explain_global(spark, sf_dir):
    model = _model(cleaned(spark, sf_dir))
    return ex.global_terms(spark, model).select("class", "term", r6("coefficient").alias("coefficient"))


@query(
    "contribution_table",
    f"""{_ALL}, {_TERMS} SELECT row_id, term AS word_or_phrase, round_even(c, 4) AS contribution_strength,
        direction FROM placed WHERE rank <= 8""",
)
def contribution_table(spark, sf_dir):
    rows = cleaned(spark, sf_dir)
    return ex.contribution_table(ex.local_terms(rows, _model(rows), 8, "row_id"), "row_id")


# ---- errors ----------------------------------------------------------------------------------

_REASON = f"""CASE WHEN word_count < 20 THEN {fx.quote(ea.REASON_SHORT)}
  WHEN {_CONFIDENCE} >= 0.85 THEN {fx.quote(ea.REASON_CONFIDENT)}
  WHEN contains(content, '"') THEN {fx.quote(ea.REASON_QUOTED)} ELSE {fx.quote(ea.REASON_DEFAULT)} END"""


@query(
    "error_table",
    f"""{_ALL}, {_TERMS}, listed AS (
          SELECT row_id, coalesce(string_agg(term, ', ' ORDER BY rank) FILTER (direction = 'fake'), '') AS fake,
                 coalesce(string_agg(term, ', ' ORDER BY rank) FILTER (direction = 'real'), '') AS "real"
          FROM placed WHERE rank <= 5 GROUP BY 1)
        SELECT r.row_id AS row_index, substr(title, 1, 500) AS headline, r.label AS true_label,
          prediction AS predicted_label, round({_CONFIDENCE}, 6) AS confidence, 'probability' AS score_kind,
          coalesce(fake, '') AS toward_fake_features, coalesce("real", '') AS toward_real_features,
          word_count, {_REASON} AS possible_reason
        FROM results r JOIN split s ON s.row_id = r.row_id LEFT JOIN listed l ON l.row_id = r.row_id
        WHERE prediction <> r.label""",
)
def error_table(spark, sf_dir):
    rows = cleaned(spark, sf_dir)
    errors = ea.error_table(rows, _model(rows))
    return errors.withColumns(
        {"confidence": r6("confidence"), "word_count": F.col("word_count").cast("bigint")}
    )


_SCORES = "((row_id * 7919) % 1000) / 1000.0::DOUBLE"


@query(
    "error_reason",
    f"""WITH {fx.ARTICLES}, c AS (SELECT row_id, {fx.content_sql()} AS content, {_SCORES} AS p FROM articles),
        results AS (SELECT *, CAST({fx.words_sql('content')} AS BIGINT) AS word_count,
                           CAST(p > 0.5 AS INTEGER) AS prediction FROM c)
        SELECT row_id, {_REASON} AS possible_reason FROM results""",
)
def error_reason(spark, sf_dir):
    """Review hint of every article under a deterministic score."""
    from corpuslens.operators.contract import add_content

    rows = add_content(fx.articles(spark, sf_dir))
    p = ((F.col("row_id") * 7919) % 1000) / F.lit(1000.0)
    confidence = ea.confidence_of((p > 0.5).cast("int"), p, sc.PROBABILITY)
    reason = ea.possible_reason(F.col("word_count"), confidence, F.col("content"))
    return rows.select("row_id", reason.alias("possible_reason"))


@query(
    "stream_score",
    f"""WITH {FITTED}, {_TALK}
        SELECT CAST(row_id // 1000 AS BIGINT) AS conv_id, CAST(row_id % 1000 AS BIGINT) AS turn, prediction AS label,
          round(p, 6) AS probability_real, {_BAND} AS confidence_band, CAST(NULL AS VARCHAR) AS reject_reason FROM results""",
)
def stream_score(spark, sf_dir):
    """Conversation turns read as a file stream, scored, and appended to a folder."""
    import uuid

    from corpuslens.sources.tables import shared_root
    from corpuslens.streaming.score import score_stream, write_stream

    model = _model(cleaned(spark, sf_dir))
    stream = fx.table_stream(spark, sf_dir, "conversations")
    base = f"{shared_root(spark)}/corpuslens/stream-{uuid.uuid4().hex}"
    query_ = write_stream(score_stream(stream, model), f"{base}/out", f"{base}/state")
    query_.awaitTermination()
    scored = spark.read.parquet(f"{base}/out")
    return scored.select(
        "conv_id",
        "turn",
        F.col("label_predicted").alias("label"),
        r6("probability_real").alias("probability_real"),
        "confidence_band",
        "reject_reason",
    )
