"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each whole text becomes a short vector of statistics (lengths, character classes, repetition), transformed by logarithms so
that the classes are closer to normal. Per class the mean and covariance are sums over all labelled rows, added up in the
tasks and then per entry; covariances are shrunk to the pooled one and to its mean variance. A score is the posterior of
label 1 from the difference of log densities, with Mahalanobis distances from inverse Cholesky factors made once.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from agoralake.session import stored

HELD_OUT = 2        # rows whose crc32(doc_id) mod 4 is this are not learned from
THRESHOLD = 0.7
TO_POOLED = 0.1     # weight of the pooled covariance in a class's
TO_SPHERE = 0.02    # weight of the mean variance
LIMIT = 30.0        # log odds are cut here

ODD = np.frombuffer(b"#$%&*+/<=>@[\\]^_`{|}~", dtype=np.uint8)
NAMES = ("words", "word_length", "word_length_spread", "upper", "digits", "odd_symbols", "exclaims", "space", "line_breaks",
         "distinct_words", "top_word", "repeats", "entropy", "stops", "repeated_lines", "long_words")
D = len(NAMES)


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of one text; an empty text gives those of no words and no characters."""
    n = len(text)
    counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    ws = text.split()
    k = len(ws)
    lengths = np.fromiter(map(len, ws), dtype=np.float64, count=k) if k else np.zeros(1)
    seen = Counter(ws)
    lower = Counter(text.split(b"\n"))
    lines = sum(lower.values())
    upper, small = counts[65:91].sum(), counts[97:123].sum()
    share = counts[counts > 0] / max(n, 1)

    def part(x: float, of: float, usual: float, least: float, weight: float) -> float:
        """Logarithm of a share drawn towards its usual value, as if ``weight`` more had been seen: few words say little."""
        return float(np.log((x + weight * usual) / (of + weight) + least))

    char = lambda x, of, usual, least: part(x, of, usual, least, 100.0)
    word = lambda x, of, usual, least: part(x, of, usual, least, 20.0)
    return [
        float(np.log1p(k)), float(np.log((lengths.sum() + 100) / (k + 20))), float(np.log(lengths.std() + 1.0)),
        char(upper, upper + small, 0.04, 0.02), char(counts[48:58].sum(), n, 0.0, 0.005), char(counts[ODD].sum(), n, 0.0, 0.005),
        char(counts[33] + counts[63], n, 0.0, 0.005), char(counts[32] + counts[9], n, 0.16, 0.02), word(counts[10], k, 0.03, 0.02),
        float(np.log(len(seen) + 20.0) / np.log(k + 20.0)), word(max(seen.values(), default=0), k, 0.05, 0.02),
        word(sum(map(bytes.__eq__, ws, ws[1:])), k, 0.0, 0.02), float(-(share * np.log2(share)).sum()) if n else 0.0,
        word(counts[46] + counts[44], k, 0.15, 0.02), part(lines - len(lower), lines, 0.0, 0.02, 5.0),
        word((lengths > 20).sum(), k, 0.0, 0.02)]


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        rows = [statistics(t.as_py() or b"") for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "x"])


def document_statistics(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "text").mapInArrow(_statistics, "doc_id long, x array<double>")


def is_held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == HELD_OUT, F.lit(False))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, 1 + D + D * D))
    for batch in batches:
        x = np.array(batch.column(0).to_pylist(), dtype=np.float64).reshape(-1, D)
        y = batch.column(1).to_numpy()
        for c in (0, 1):
            own = x[y == c]
            total[c] += np.concatenate(([len(own)], own.sum(axis=0), (own.T @ own).ravel()))
    size = total.shape[1]
    yield pa.RecordBatch.from_arrays([
        pa.array(np.repeat([0, 1], size)), pa.array(np.tile(np.arange(size), 2)), pa.array(total.ravel())], names=["label", "entry", "v"])


def fit(statistics_of: DataFrame, labels: DataFrame, to_pooled: float = TO_POOLED, to_sphere: float = TO_SPHERE) -> dict:
    """The model from (doc_id, x) and (doc_id, quality), rows held out aside; labels other than 0 and 1 are left out.

    Without rows of a class the model gives every text the same score.
    """
    train = statistics_of.join(labels.select("doc_id", "quality").filter("quality in (0, 1)"), "doc_id").filter(~is_held_out())
    rows = train.select("x", F.col("quality").cast("int")).mapInArrow(_sums, "label long, entry long, v double").groupBy(
        "label", "entry").agg(F.sum("v").alias("v")).collect()  # 2 * (1 + D + D * D) rows at any size
    total = np.zeros((2, 1 + D + D * D))
    for r in rows:
        total[r["label"], r["entry"]] = r["v"]
    n = total[:, 0]
    if not n.all():
        return {"odds": float(np.log((n[1] + 1) / (n[0] + 1)))}
    means = total[:, 1:1 + D] / n[:, None]
    scatter = total[:, 1 + D:].reshape(2, D, D) - n[:, None, None] * np.einsum("ci,cj->cij", means, means)
    pooled = scatter.sum(axis=0) / n.sum()
    model = {"mean": means.tolist(), "inverse": [], "log_det": [], "odds": float(np.log(n[1] / n[0]))}
    for c in (0, 1):
        own = (1 - to_pooled) * scatter[c] / n[c] + to_pooled * pooled
        own = (1 - to_sphere) * own + to_sphere * (np.trace(own) / D + 1e-6) * np.eye(D)
        factor = np.linalg.cholesky(own)
        model["inverse"].append(np.linalg.inv(factor).tolist())
        model["log_det"].append(float(2 * np.log(np.diag(factor)).sum()))
    return model


def posterior(model: dict, x: np.ndarray) -> np.ndarray:
    """The probability of label 1 for rows of statistics."""
    odds = np.full(len(x), model["odds"])
    if "mean" in model:
        density = [-0.5 * (((x - np.array(m)) @ np.array(i).T) ** 2).sum(axis=1) - 0.5 * d
                   for m, i, d in zip(model["mean"], model["inverse"], model["log_det"])]
        odds = odds + density[1] - density[0]
    return 1 / (1 + np.exp(-np.clip(odds, -LIMIT, LIMIT)))


def save_model(model: dict) -> str:
    return json.dumps(model)


def load_model(text: str) -> dict:
    return json.loads(text)


def text_score(model: dict):
    """A column function: the score of a text column."""
    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        rows = [statistics((t or "").encode()) for t in texts]
        return pd.Series(posterior(model, np.array(rows, dtype=np.float64).reshape(-1, D)))
    return scored


def _scores(model: dict):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), dtype=np.float64).reshape(-1, D)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(posterior(model, x))], names=["doc_id", "score"])
    return scored


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``documents``.

    Null and empty texts are scored by the statistics of no words; repeated rows get equal scores; a doc_id labelled more
    than once counts as often; without labels all scores are equal; an empty table gives no rows; language, source, labels
    and doc_id are no inputs.
    """
    table = stored(document_statistics(documents), "document-statistics")
    model = fit(table, labels)
    return table.mapInArrow(_scores(model), "doc_id long, score double").select(
        "doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents`` with a score of THRESHOLD or more, all columns kept, whatever their names.

    Texts are read twice, for the fit and for their scores, and never shuffled. Null, empty and repeated texts are scored as by
    ``score_documents``; without labels all scores are equal and below THRESHOLD, so nothing stays; an empty table gives no rows.
    """
    model = fit(stored(document_statistics(documents), "document-statistics"), labels)
    return documents.filter(text_score(model)(F.col("text")) >= THRESHOLD)
