"""Stored models: Parquet tables of members, coefficients and metadata."""

from __future__ import annotations

import json
from dataclasses import asdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from corpuslens.config import CharOptions, FeatureOptions, TextOptions, WordOptions
from corpuslens.errors import ModelNotReadyError
from corpuslens.operators.features import FeatureModel, Space
from corpuslens.operators.models import LinearModel
from corpuslens.operators.score import Calibrator, Member, TextModel

_MEMBERS = (
    "member int, name string, link string, explainable boolean, intercept double, "
    "documents bigint, options string, calibrator string, knots_x array<double>, "
    "knots_y array<double>"
)
_TERMS = (
    "member int, space string, term string, index int, df bigint, idf double, "
    "sublinear boolean, coefficient double"
)


def model_tables(spark: SparkSession, model: TextModel) -> dict[str, DataFrame]:
    """Members and terms as tables; the term table is bounded by the vocabulary caps."""
    members, terms = [], []
    for number, m in enumerate(model.members):
        c = m.calibrator
        members.append(
            (
                number,
                m.linear.name,
                m.linear.link,
                m.linear.explainable,
                float(m.linear.intercept),
                m.features.documents,
                json.dumps(asdict(m.features.options)),
                c.kind if c else None,
                [float(v) for v in c.x] if c else None,
                [float(v) for v in c.y] if c else None,
            )
        )
        names = m.features.names
        terms.append(
            pa.table(
                {
                    "member": pa.array(np.full(len(names), number), pa.int32()),
                    "space": pa.array([space for space, _ in names], pa.string()),
                    "term": pa.array([term for _, term in names], pa.string()),
                    "index": pa.array(np.arange(len(names)), pa.int32()),
                    "df": pa.array([d for s in m.features.spaces for d in s.df], pa.int64()),
                    "idf": pa.array(m.features.idf, pa.float64()),
                    "sublinear": pa.array(
                        [s.sublinear for s in m.features.spaces for _ in s.terms], pa.bool_()
                    ),
                    "coefficient": pa.array(m.linear.coefficients, pa.float64()),
                }
            )
        )
    return {
        "members": spark.createDataFrame(members, _MEMBERS),
        "terms": spark.createDataFrame(pa.concat_tables(terms)),
    }


def metadata_table(spark: SparkSession, model: TextModel, extra: dict) -> DataFrame:
    record = {
        "model_name": model.members[0].linear.name,
        "model_version": model.version,
        "score_kind": model.score_kind,
        "text_options": asdict(model.text),
        **extra,
    }
    return spark.createDataFrame([(json.dumps(record, default=str),)], "record string")


def save_model(spark: SparkSession, model: TextModel, path: str, **extra) -> None:
    for name, table in model_tables(spark, model).items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")
    metadata_table(spark, model, extra).write.mode("overwrite").text(f"{path}/metadata")


def _options(text: str) -> FeatureOptions:
    raw = json.loads(text)
    word = raw["word"]
    for key in ("preserve", "stop_words"):
        word[key] = tuple(word[key]) if word[key] is not None else None
    return FeatureOptions(WordOptions(**word), CharOptions(**raw["char"]))


def load_model(spark: SparkSession, path: str) -> TextModel:
    """Read a stored model; missing or broken tables raise before any scoring job starts."""
    try:
        members = spark.read.schema(_MEMBERS).parquet(f"{path}/members").orderBy("member").collect()
        rows = spark.read.schema(_TERMS).parquet(f"{path}/terms").orderBy("member", "index").collect()
        record = json.loads(spark.read.text(f"{path}/metadata").first()[0])
        loaded = tuple(_member(m, [r for r in rows if r["member"] == m["member"]]) for m in members)
        return TextModel(loaded, TextOptions(**record["text_options"]), record["model_version"])
    except Exception as problem:
        raise ModelNotReadyError(
            "The trained model is not available or its tables are invalid."
        ) from problem


def _member(m, rows) -> Member:
    spaces = []
    for name in dict.fromkeys(r["space"] for r in rows):
        own = [r for r in rows if r["space"] == name]
        spaces.append(
            Space(
                name,
                tuple(r["term"] for r in own),
                tuple(r["df"] for r in own),
                np.array([r["idf"] for r in own]),
                own[0]["sublinear"],
            )
        )
    linear = LinearModel(
        m["name"],
        np.array([r["coefficient"] for r in rows]),
        m["intercept"],
        m["link"],
        m["explainable"],
    )
    calibrator = None
    if m["calibrator"]:
        calibrator = Calibrator(m["calibrator"], np.array(m["knots_x"]), np.array(m["knots_y"]))
    return Member(FeatureModel(_options(m["options"]), m["documents"], tuple(spaces)), linear, calibrator)


