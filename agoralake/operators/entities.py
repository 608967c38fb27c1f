"""Named entities in normalised text: exact aliases, fuzzy tokens, parties and stated voting intention."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from agoralake import lexicon
from agoralake.functions.text import analysis_text, once, renormalized

MIN_TOKEN = 5
CUTOFF = 85.0
# Up to this many aliases are searched one by one; the word runs of a text are looked up in a larger dictionary.
INLINE_ALIASES = 500
# Up to this many fuzzy targets have an expression each; more are joined on pieces, with the same rows.
INLINE_TARGETS = 64


def _padded(c: Column) -> Column:
    return F.concat(F.lit(" "), F.coalesce(c, F.lit("")), F.lit(" "))


def alias_entities(text: Column, aliases: Mapping[str, str] = lexicon.CANDIDATE_ALIASES, padded: bool = False) -> Column:
    """Sorted distinct entities whose alias stands as whole words in a normalised text.

    Normalised text has only word characters and single spaces, so whole-word search is a plain substring search once the
    text is padded with a space on either side.
    """
    if len(aliases) > INLINE_ALIASES:
        return _looked_up(F.trim(text) if padded else text, aliases)
    padded = text if padded else _padded(text)
    by_entity: dict[str, list[str]] = {}
    for alias, entity in aliases.items():
        by_entity.setdefault(entity, []).append(alias)
    found = []
    for entity, names in by_entity.items():
        hit = F.lit(False)
        for name in names:
            hit = hit | F.contains(padded, F.lit(f" {name} "))
        found.append(F.when(hit, F.lit(entity)))
    return F.array_sort(F.array_compact(F.array(*found)))


def _word_runs(words: Column, n: int) -> Column:
    """All runs of n words, joined by a space."""
    if n == 1:
        return words
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - (n - 1))).otherwise(
        F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(words, i + (k - 1)) for k in range(n)]))


def _looked_up(text: Column, aliases: Mapping[str, str]) -> Column:
    """As ``alias_entities`` for large dictionaries: one hash set holds the aliases, and only aliases found are mapped."""
    words = F.split(F.coalesce(text, F.lit("")), " ")
    runs = F.concat(*[_word_runs(words, n) for n in sorted({len(a.split(" ")) for a in aliases})])
    found = F.array_intersect(runs, F.array(*[F.lit(a) for a in aliases]))
    entity = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    return F.array_sort(F.array_distinct(F.transform(found, lambda a: F.try_element_at(entity, a))))


def alias_runs(df: DataFrame, key: str, text: str, aliases: DataFrame) -> DataFrame:
    """(key, alias) of the word runs of each text that may be in ``aliases``, each once per row.

    Only run lengths that occur in the table are made. Of lengths with up to INLINE_ALIASES aliases only those runs are left
    that are one of them, so that a few short names do not send every word of the posts through the join.
    """
    known = aliases.where(F.col("alias").isNotNull()).select("alias", F.size(F.split("alias", " ")).alias("n")).distinct()
    counts = {r["n"]: r["count"] for r in known.groupBy("n").count().collect()}
    few: dict[int, list[str]] = {n: [] for n in counts if counts[n] <= INLINE_ALIASES}
    for r in known.where(F.col("n").isin(*few)).collect() if few else ():
        few[r["n"]].append(r["alias"])
    words = F.col("_w")

    def made(n: int) -> Column:
        runs = _word_runs(words, n)
        return F.filter(runs, lambda run: run.isin(*few[n])) if n in few else runs

    every = F.array_distinct(F.concat(*[made(n) for n in sorted(counts)])) if counts else F.array().cast("array<string>")
    return df.select(key, F.split(F.col(text), " ").alias("_w")).select(key, F.explode(every).alias("alias"))


def alias_entities_by_join(df: DataFrame, key: str, text: str, aliases: DataFrame) -> DataFrame:
    """(key, entity) pairs for a large alias table with columns ``alias, entity``: an equi-join on word n-grams.

    ``aliases`` is read three times and should be stored. Spark broadcasts the table when it is small enough; otherwise both
    sides are shuffled by n-gram, and a very common one is split by the adaptive skew join.
    """
    return alias_runs(df, key, text, aliases).join(aliases, "alias").select(key, "entity").distinct()


# --- fuzzy tokens -----------------------------------------------------------------------------------------------------

def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence; both strings must be non-empty."""
    start = F.array_repeat(F.lit(0), F.length(b) + 1)

    def row(prev: Column, i: Column) -> Column:
        def cell(cur: Column, j: Column) -> Column:
            same = F.substr(a, i, F.lit(1)) == F.substr(b, j, F.lit(1))
            best = F.when(same, F.get(prev, j - 1) + 1).otherwise(F.greatest(F.get(prev, j), F.get(cur, j - 1)))
            return F.concat(cur, F.array(best))
        return F.aggregate(F.sequence(F.lit(1), F.length(b)), F.array(F.lit(0)), cell)

    return F.element_at(F.aggregate(F.sequence(F.lit(1), F.length(a)), start, row), -1)


def lcs_ratio(a: Column, b: Column) -> Column:
    """Similarity 0..100: twice the common subsequence over both lengths."""
    return F.lit(200.0) * lcs_length(a, b) / (F.length(a) + F.length(b))


def _allowed_edits(length: Column | int, target: str, cutoff: float) -> Column | int:
    """Insertions plus deletions a token of this length may be away from the target."""
    spare = (100.0 - cutoff) / 100.0
    total = length + len(target)
    return int(total * spare + 1e-9) if isinstance(length, int) else F.floor(total * spare + 1e-9)


def _longest(target: str, cutoff: float) -> int:
    """Longest token that can still reach the cutoff: twice the target over both lengths."""
    return int(len(target) * (200.0 / cutoff - 1.0) + 1e-9)


def _near(token: Column, target: str, cutoff: float) -> Column:
    """Cheap tests that drop no pair at or above the cutoff: the lengths bound the ratio, and the built-in edit distance
    never exceeds the number of insertions and deletions."""
    longest = _longest(target, cutoff)
    allowed = _allowed_edits(F.length(token), target, cutoff)
    return ((F.length(token) <= longest) & (F.abs(F.length(token) - len(target)) <= allowed)
            & F.levenshtein(token, F.lit(target), _allowed_edits(longest, target, cutoff)).between(0, allowed))


def _best_target(token: Column, targets: Mapping[str, str], cutoff: float) -> Column:
    """Struct (ratio, rank, entity) of the closest target among those that pass the cheap tests; ties: the earlier one."""
    return F.array_max(F.array_compact(F.array(*[
        F.when(_near(token, target, cutoff), F.struct(
            lcs_ratio(token, F.lit(target)).alias("ratio"), F.lit(-rank).alias("rank"), F.lit(entity).alias("entity")))
        for rank, (target, entity) in enumerate(targets.items())])))


def close_targets(tokens: DataFrame, targets: Mapping[str, str] = lexicon.FUZZY_TARGETS,
                  cutoff: float = CUTOFF) -> DataFrame:
    """From a one-column frame of distinct ``token``s, the (token, entity, ratio) at or above ``cutoff``."""
    # The filter stays above the generator; else it would go below the caller's distinct() and compare every occurrence.
    scored = once(tokens, _best=_best_target(F.col("token"), targets, cutoff))
    return scored.where(F.col("_best.ratio") >= cutoff).select(
        "token", F.col("_best.entity").alias("entity"), F.col("_best.ratio").alias("ratio"))


def close_targets_by_join(tokens: DataFrame, targets: Mapping[str, str], cutoff: float = CUTOFF) -> DataFrame:
    """As ``close_targets`` for thousands of targets: an equi-join on pieces instead of an expression per target.

    A token at the cutoff is at most d insertions and deletions from a target of given length. Cut into d + 1 pieces, the
    target has one that no edit touches; it stands in the token at most d places from its own place. So every close pair
    shares a piece, and only pairs that do are compared.
    """
    spark, rows = tokens.sparkSession, []
    for rank, (target, entity) in enumerate(targets.items()):
        most = int(_allowed_edits(_longest(target, cutoff), target, cutoff))
        cuts = [i * len(target) // (most + 1) for i in range(most + 2)]
        rows += [(target, entity, rank, most, a, target[a:b]) for a, b in zip(cuts, cuts[1:]) if a < b]
    pieces = spark.createDataFrame(rows, "target string, entity string, rank int, most int, at int, piece string")

    def runs_of(n: int) -> Column:
        starts = F.when(F.length("token") >= n, F.sequence(F.lit(0), F.length("token") - n)).otherwise(
            F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.struct(i.alias("pos"), F.col("token").substr(i + 1, F.lit(n)).alias("piece")))

    runs = F.concat(*[runs_of(n) for n in sorted({len(r[5]) for r in rows})])
    found = tokens.select("token", F.explode(F.array_distinct(runs)).alias("r")).select("token", "r.pos", "r.piece").join(
        pieces, "piece").where(F.abs(F.col("pos") - F.col("at")) <= F.col("most"))
    spare = F.abs(F.length("token") - F.length("target")) <= F.floor(
        (F.length("token") + F.length("target")) * ((100.0 - cutoff) / 100.0) + 1e-9)
    pairs = found.where(spare).select("token", "target", "entity", "rank").distinct().withColumn(
        "ratio", lcs_ratio(F.col("token"), F.col("target"))).where(F.col("ratio") >= cutoff)
    best = pairs.groupBy("token").agg(F.max(F.struct("ratio", (-F.col("rank")).alias("rank"), "entity")).alias("b"))
    return best.select("token", F.col("b.entity").alias("entity"), F.col("b.ratio").alias("ratio"))


def fuzzy_in_row(text: Column, targets: Mapping[str, str] = lexicon.FUZZY_TARGETS, cutoff: float = CUTOFF,
                 min_length: int = MIN_TOKEN) -> Column:
    """Entities of the fuzzy tokens of one normalised text, without leaving the row: no shuffle, no second scan."""
    longest = max(_longest(t, cutoff) for t in targets)

    def possible(token: Column) -> Column:
        near = F.lit(False)
        for target in targets:
            near = near | _near(token, target, cutoff)
        return F.length(token).between(min_length, longest) & near

    found = F.transform(F.filter(F.array_distinct(F.split(text, " ")), possible),
                        lambda token: _best_target(token, targets, cutoff))
    return F.array_distinct(F.transform(F.filter(found, lambda m: m["ratio"] >= cutoff), lambda m: m["entity"]))


def post_tokens(df: DataFrame, key: str, text: str, min_length: int = MIN_TOKEN) -> DataFrame:
    """Distinct long tokens per post."""
    words = F.filter(F.array_distinct(F.split(F.col(text), " ")), lambda w: F.length(w) >= min_length)
    return df.select(key, F.explode(words).alias("token"))


def fuzzy_entities(df: DataFrame, key: str, text: str, targets: Mapping[str, str] = lexicon.FUZZY_TARGETS,
                   cutoff: float = CUTOFF) -> DataFrame:
    """(key, entity) pairs found by fuzzy tokens, similarity computed once per distinct token of the table.

    Worth its two scans and shuffles when the targets are many; for a handful ``fuzzy_in_row`` is faster.
    """
    tokens = post_tokens(df, key, text)
    close = close_targets if len(targets) <= INLINE_TARGETS else close_targets_by_join
    vocabulary = close(tokens.select("token").distinct(), targets, cutoff)
    return tokens.join(vocabulary, "token").select(key, "entity").distinct()


# --- whole detectors --------------------------------------------------------------------------------------------------

def parties_of(candidates: Column, party_of: Mapping[str, str] = lexicon.CANDIDATE_PARTY) -> Column:
    table = F.create_map(*[F.lit(x) for pair in party_of.items() for x in pair])
    return F.array_compact(F.transform(candidates, lambda c: F.try_element_at(table, c)))


def with_entities(df: DataFrame, text: str, aliases: Mapping[str, str] = lexicon.CANDIDATE_ALIASES,
                  party_aliases: Mapping[str, str] = lexicon.PARTY_ALIASES,
                  party_of: Mapping[str, str] = lexicon.CANDIDATE_PARTY,
                  fuzzy_targets: Mapping[str, str] | None = lexicon.FUZZY_TARGETS, cutoff: float = CUTOFF) -> DataFrame:
    """Add ``candidatos`` and ``partidos``, sorted arrays; empty when nothing is mentioned.

    ``text`` is a normalised column. Everything happens inside the row, for dictionaries of any size. Aliases that are
    themselves a table belong in ``alias_entities_by_join``.
    """
    # Steps, so that each text is normalised and padded once for all the tests on it.
    rows = df.withColumn("_t", renormalized(F.col(text))).withColumn("_p", _padded(F.col("_t")))
    found = alias_entities(F.col("_p"), aliases, padded=True)
    if fuzzy_targets:
        found = F.array_union(found, fuzzy_in_row(F.col("_t"), fuzzy_targets, cutoff))
    rows = once(rows, candidatos=F.array_sort(found))
    parties = F.array_union(alias_entities(F.col("_p"), party_aliases, padded=True),
                            parties_of(F.col("candidatos"), party_of))
    return rows.withColumn("partidos", F.array_sort(parties)).drop("_t", "_p")


def _phrase_pattern(phrases: Sequence[str]) -> str:
    return "(?:^| )(?:" + "|".join(phrases) + ")(?: |$)"


def stated_intention(text: Column, phrases: Sequence[str] = lexicon.INTENTION_PHRASES,
                     reporting: Sequence[str] = lexicon.REPORTING_WORDS, normalise: bool = True) -> Column:
    """1 when a text states a voting intention and does not merely report, else 0."""
    t = analysis_text(text) if normalise else text
    return F.when(t.rlike(_phrase_pattern(reporting)), 0).when(t.rlike(_phrase_pattern(phrases)), 1).otherwise(0)
