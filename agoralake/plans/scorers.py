"""Pluggable text scorers. A scorer gives a label and a probability per text."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from agoralake.functions import scoring
from agoralake.functions.text import first_chars

RESULT = T.StructType([T.StructField("label", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("error", T.StringType())])
BATCH = 64


class TextScorer:
    """Base of all scorers; ``result`` is a struct column (label, score) over a text column."""

    name, version = "unknown", "0.0"

    def result(self, text: Column) -> Column:
        raise NotImplementedError

    def info(self) -> dict[str, str]:
        return {"model_name": self.name, "version": self.version}


class NeutralScorer(TextScorer):
    """Always neutral, 0.5. No Python runs."""

    name, version = "dummy", "0.0-test"

    def result(self, text: Column) -> Column:
        return F.struct(F.lit("neutral").alias("label"), F.lit(0.5).alias("score"))


class LexiconScorer(TextScorer):
    """Label by the majority of listed words in a normalised text; probability is the winning share.

    Built from native expressions only. It stands in where no trained model is at hand.
    """

    name, version = "lexicon", "1.0"

    def __init__(self, positive: Sequence[str], negative: Sequence[str]):
        self.positive, self.negative = list(positive), list(negative)

    def result(self, text: Column) -> Column:
        words = F.split(text, " ")
        up = F.size(F.filter(words, lambda w: w.isin(self.positive)))
        down = F.size(F.filter(words, lambda w: w.isin(self.negative)))
        label = F.when(up > down, "POS").when(down > up, "NEG").otherwise("NEU")
        return F.struct(label.alias("label"),
                        F.coalesce(F.try_divide(F.greatest(up, down), up + down), F.lit(0.5)).alias("score"))


class BatchModel:
    """What a trained model has to offer: (label, probability) per text, in order."""

    name, version = "unknown", "0.0"

    def load(self) -> None:
        """Called once per Python worker before the first batch."""

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        raise NotImplementedError


def judged(model: BatchModel, texts: list[str]) -> list[tuple[str, float, str | None]]:
    """(label, probability, error) per text. A batch the model fails on is halved until the texts at fault are alone; they are
    neutral, 0, and have the error. ``k`` such texts among ``n`` cost about 2 k log2(n) further calls."""
    try:
        found = [(str(label), float(p), None) for label, p in model.predict(texts)]
        if len(found) != len(texts):
            raise ValueError("a model must return one result per text")
        return found
    except Exception as exc:  # noqa: BLE001 - a failing text must not end the job, nor take others with it
        if len(texts) == 1:
            return [("NEU", 0.0, f"{type(exc).__name__}: {exc}"[:500])]
        half = len(texts) // 2
        return judged(model, texts[:half]) + judged(model, texts[half:])


class ModelScorer(TextScorer):
    """Runs a ``BatchModel`` in Arrow batches; the result has a third field, ``error``, for texts the model fails on.

    ``max_chars`` is for a model with an input limit of its own; by default it gets whole texts.
    """

    def __init__(self, model: BatchModel, batch: int = BATCH, max_chars: int | None = None):
        self.model, self.batch, self.max_chars = model, batch, max_chars
        self.name, self.version = model.name, model.version

    def result(self, text: Column) -> Column:
        model, size = self.model, self.batch

        @F.pandas_udf(RESULT)
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            model.load()
            for texts in batches:
                texts = texts.fillna("").tolist()
                rows = [r for start in range(0, len(texts), size) for r in judged(model, texts[start:start + size])]
                yield pd.DataFrame(rows, columns=["label", "score", "error"])

        return score(text if self.max_chars is None else first_chars(text, self.max_chars))


def with_sentiment(rows: DataFrame, scorer: TextScorer, text: str = "texto_usuario_norm") -> DataFrame:
    """Add ``score`` (sign times probability), ``sentimiento`` and ``score_error`` to rows that have a date. A row whose text the
    scorer failed on is neutral, 0, and has an error; who takes means should leave it out."""
    scored = rows.where(F.col("fecha").isNotNull()).withColumn("_r", scorer.result(F.col(text)))
    error = F.col("_r.error") if "error" in scored.schema["_r"].dataType.names else F.lit(None).cast("string")
    scored = scored.withColumns({"score": scoring.signed_score(F.col("_r.label"), F.col("_r.score")), "score_error": error}).drop("_r")
    return scored.withColumn("sentimiento", scoring.sentiment_class(F.col("score")))
