"""Engagement and sentiment arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Weight of each metric in the engagement score.
ENGAGEMENT_WEIGHTS = {"likes": 1.0, "retweets": 2.0, "shares": 2.0, "replies": 3.0, "comments": 3.0, "views": 0.01}
# Weights of the analysis score per network; a network without an entry counts likes.
NETWORK_WEIGHTS = {
    "tiktok": {"plays": 0.1, "likes": 1.0, "comments": 1.5, "shares": 2.0},
    "twitter": {"likes": 1.0, "retweets": 2.0, "replies": 1.5},
}
# Labels read as positive and negative, the class threshold and the bonus for a stated intention.
POSITIVE_LABELS = ["POS", "POSITIVE", "LABEL_2"]
NEGATIVE_LABELS = ["NEG", "NEGATIVE", "LABEL_0"]
CLASS_THRESHOLD = 0.1
INTENTION_BONUS = 0.3


def metric(m: Column, key: str, default: float | None = 0.0) -> Column:
    value = F.try_element_at(m, F.lit(key)).cast("double")
    return value if default is None else F.coalesce(value, F.lit(default))


def engagement_total(m: Column, weights: dict[str, float] = ENGAGEMENT_WEIGHTS) -> Column:
    total = F.lit(0.0)
    for key, weight in weights.items():
        total = total + metric(m, key) * weight
    return total


def engagement_score(m: Column, digits: int | None = 4) -> Column:
    """log(1 + weighted sum), NULL when no known metric is present."""
    known = F.coalesce(*[metric(m, key, None) for key in ENGAGEMENT_WEIGHTS])
    score = F.log1p(engagement_total(m))
    return F.when(known.isNotNull(), score if digits is None else F.round(score, digits))


def network_engagement(source: Column, m: Column) -> Column:
    out = metric(m, "likes")
    for name, weights in NETWORK_WEIGHTS.items():
        out = F.when(source == name, engagement_total(m, weights)).otherwise(out)
    return out


def label_sign(label: Column) -> Column:
    up = F.upper(label)
    return F.when(up.isin(POSITIVE_LABELS), 1.0).when(up.isin(NEGATIVE_LABELS), -1.0).otherwise(0.0)


def signed_score(label: Column, probability: Column) -> Column:
    return F.round(label_sign(label) * probability, 4)


def sentiment_class(score: Column, threshold: float = CLASS_THRESHOLD) -> Column:
    return F.when(score > threshold, "positivo").when(score < -threshold, "negativo").otherwise("neutro")


def composite_score(score: Column, intention: Column, bonus: float = INTENTION_BONUS) -> Column:
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), score + intention * bonus))


def log_weight(engagement: Column) -> Column:
    return 1 + F.log1p(F.greatest(F.coalesce(engagement, F.lit(0.0)), F.lit(0.0)))


def percent_deviation(value: Column, baseline: Column) -> Column:
    return F.try_divide(F.abs(value - baseline), baseline) * 100
