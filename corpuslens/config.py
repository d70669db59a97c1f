"""Plain parameter records; every operator takes the record it needs."""

from __future__ import annotations

from dataclasses import dataclass, field

# Class names, separator token and thresholds that results depend on.
CLASS_NAMES = ("Fake News", "Real News")
SEPARATOR = " bodytext "
NEGATIONS = ("not", "no", "never", "neither", "nor")


@dataclass(frozen=True)
class TextOptions:
    """Switches of the text normaliser."""

    lowercase: bool = True
    replace_urls: bool = True
    replace_numbers: bool = False
    remove_source_markers: bool = True
    # False skips the Arrow pass for tables known to hold no entities or compatibility characters.
    decode: bool = True


@dataclass(frozen=True)
class SplitOptions:
    strategy: str = "duplicate_safe"
    train_size: float = 0.70
    validation_size: float = 0.15
    test_size: float = 0.15
    seed: int = 42
    minimum_valid_dates: float = 0.8


@dataclass(frozen=True)
class WordOptions:
    max_ngram: int = 2
    min_df: int = 2
    max_df: float = 0.98
    max_features: int = 50_000
    sublinear_tf: bool = True
    strip_accents: bool = True
    preserve: tuple[str, ...] = NEGATIONS
    # None selects the packaged English list.
    stop_words: tuple[str, ...] | None = None


@dataclass(frozen=True)
class CharOptions:
    enabled: bool = True
    min_n: int = 3
    max_n: int = 5
    min_df: int = 3
    max_features: int = 30_000
    sublinear_tf: bool = True


@dataclass(frozen=True)
class FeatureOptions:
    word: WordOptions = field(default_factory=WordOptions)
    char: CharOptions = field(default_factory=CharOptions)


@dataclass(frozen=True)
class ModelOptions:
    candidates: tuple[str, ...] = (
        "dummy",
        "naive_bayes",
        "logistic_regression",
        "passive_aggressive",
        "linear_svm",
    )
    logistic_c: float = 2.0
    # Limits of iterative fits; a fit that reaches one warns and is marked as not converged.
    logistic_max_iter: int = 2000
    svm_c: float = 1.0
    svm_max_iter: int = 1000
    passive_aggressive_c: float = 0.5
    passive_aggressive_epochs: int = 1500
    passive_aggressive_shards: int = 8
    naive_bayes_alpha: float = 0.5
    # True counts the intercept of logistic regression and SVM among the penalised weights.
    penalise_intercept: bool = False


@dataclass(frozen=True)
class EvaluationOptions:
    primary_metric: str = "macro_f1"
    folds: int = 5
    calibration_methods: tuple[str, ...] = ("sigmoid", "isotonic")
    calibration_folds: int = 3
    calibration_f1_tolerance: float = 0.005
    isotonic_minimum_rows: int = 1000


@dataclass(frozen=True)
class ScoringOptions:
    maximum_characters: int = 50_000
    minimum_words: int = 20
    minimum_coverage: float = 0.05
    ascii_ratio: float = 0.55
    top_features: int = 8
    class_names: tuple[str, str] = CLASS_NAMES


@dataclass(frozen=True)
class ProjectOptions:
    version: str = "1.0.0"
    required_columns: tuple[str, ...] = ("title", "text")
    separator: str = SEPARATOR
    minimum_training_words: int = 8
    seed: int = 42
    text: TextOptions = field(default_factory=TextOptions)
    split: SplitOptions = field(default_factory=SplitOptions)
    features: FeatureOptions = field(default_factory=FeatureOptions)
    models: ModelOptions = field(default_factory=ModelOptions)
    evaluation: EvaluationOptions = field(default_factory=EvaluationOptions)
    scoring: ScoringOptions = field(default_factory=ScoringOptions)
