"""Features of a window as one map, for any number of entities.

No entity becomes a column and no name comes to the driver: a window's features are name -> value pairs, made by one
aggregation. ``wide`` gives the columns a caller names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from agoralake.functions.text import network_prefix
from agoralake.operators.feature_table import KEYS


def score_features(scores: DataFrame, kind: int, name: Column | None = None) -> DataFrame:
    """KEYS, name, value: mean score per window, network and entity as ``<network><kind>_<name>``, and the mean over the networks
    at hand as ``SP<kind>_<name>``. Entities are named by ``name``, whole by default, so no two share one.

    Scores hold an entity and network once a window, so there is little to combine before they are dealt out. They are dealt and
    sorted once, by window and name, and both means are windows over that."""
    name = F.col("entidad") if name is None else name
    named = scores.where(F.col("entidad").isNotNull()).select(
        *KEYS, name.alias("_name"), network_prefix(F.col("red")).alias("_net"), "score_final").repartition(*KEYS, "_name")
    of_name, of_net = Window.partitionBy(*KEYS, "_name"), Window.partitionBy(*KEYS, "_name", "_net")
    # Numbered before the mean, whose order is then there already.
    per = named.withColumn("_rn", F.row_number().over(of_net.orderBy("score_final"))).withColumn(
        "value", F.avg("score_final").over(of_net)).where("_rn = 1")
    both = per.withColumn("_mean", F.avg("value").over(of_name)).withColumn("_rn", F.row_number().over(of_name.orderBy("_net")))
    own = F.struct(F.concat("_net", F.lit(f"{kind}_"), "_name").alias("name"), F.col("value"))
    mean = F.struct(F.concat(F.lit(f"SP{kind}_"), "_name").alias("name"), F.col("_mean").alias("value"))
    return both.select(*KEYS, F.inline(F.when(F.col("_rn") == 1, F.array(own, mean)).otherwise(F.array(own))))


def feature_maps(features: DataFrame) -> DataFrame:
    """One row per window with ``features``, a map of its values; a window's map has as many entries as entities are named in it."""
    return features.where("value is not null").groupBy(*KEYS).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", "value")))).alias("features"))


def wide(maps: DataFrame, names: Sequence[str], default: float | None = None) -> DataFrame:
    """The named features as columns."""
    value = lambda n: F.try_element_at("features", F.lit(n))
    return maps.select(*KEYS, *[(value(n) if default is None else F.coalesce(value(n), F.lit(default))).alias(n) for n in names])
