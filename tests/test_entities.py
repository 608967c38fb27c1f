import random

import pytest
from pyspark.sql import functions as F

from agoralake import lexicon
from agoralake.functions.text import analysis_text
from agoralake.operators import entities

CANDIDATES = [
    ("Abelardo presidente en primera vuelta", ["Abelardo De la Espriella"]),
    ("El tigre va a ganar", ["Abelardo De la Espriella"]),
    ("Viva el pacto historico", ["Ivan Cepeda"]),
    ("Cepeda es lo mejor para Colombia", ["Ivan Cepeda"]),
    ("Paloma es la candidata del uribismo", ["Paloma Valencia"]),
    ("Ivan trabaja mucho", []),
    ("Claudia Lopez imparables", ["Claudia Lopez"]),
    ("Roy Barreras tiene propuestas", ["Roy Barreras"]),
    ("uribe es el mejor politico", []),
    ("Firmes 2026 con Ivan", ["Ivan Cepeda"]),
    ("El centro democratico va a gobernar", ["Paloma Valencia"]),
]
PARTIES = [
    ("Viva el pacto historico", ["Pacto Historico"]),
    ("Cepeda es lo mejor", ["Pacto Historico"]),
    ("El centro democratico va a gobernar", ["Centro Democratico"]),
    ("Paloma Valencia presidenta", ["Centro Democratico"]),
]


def detected(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = entities.with_entities(df.withColumn("n", analysis_text(F.col("t"))), "n").orderBy("i").collect()
    return [(r["candidatos"], r["partidos"]) for r in rows]


def test_known_candidates(spark):
    assert [c for c, _ in detected(spark, [t for t, _ in CANDIDATES])] == [e for _, e in CANDIDATES]


def test_known_parties(spark):
    assert [p for _, p in detected(spark, [t for t, _ in PARTIES])] == [e for _, e in PARTIES]


def test_misspelled_names(spark):
    got = [c for c, _ in detected(spark, ["sepeda no", "cepedda ya", "fajardoo fajrdo", "", "palom"])]
    # sepeda shares five letters of six on either side: 83.3, below the cutoff
    assert got == [[], ["Ivan Cepeda"], ["Sergio Fajardo"], [], ["Paloma Valencia"]]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] + 1 if x == y else max(row[j], new[-1]))
        row = new
    return row[-1]


def best_target(token):
    best = None
    for target, entity in lexicon.FUZZY_TARGETS.items():
        ratio = 200.0 * lcs(token, target) / (len(token) + len(target))
        if best is None or ratio > best[0]:
            best = (ratio, entity)
    return best[1] if best[0] >= 85 else None


def mutated(rng, word):
    letters = list(word)
    for _ in range(rng.randint(0, 4)):
        i, kind = rng.randrange(len(letters) + 1), rng.random()
        if kind < 0.4:
            letters.insert(i, rng.choice("aeiouclps"))
        elif letters and i < len(letters):
            if kind < 0.7:
                del letters[i]
            else:
                letters[i] = rng.choice("aeiouclps")
    return "".join(letters)


def test_fuzzy_equals_brute_force(spark):
    rng = random.Random(7)
    tokens = sorted({mutated(rng, rng.choice(list(lexicon.FUZZY_TARGETS))) for _ in range(1500)} - {""})
    df = spark.createDataFrame([(t,) for t in tokens], "token string")
    want = {t: best_target(t) for t in tokens if best_target(t)}
    assert len(want) > 100
    got = {r["token"]: r["entity"] for r in entities.close_targets(df, lexicon.FUZZY_TARGETS).collect()}
    assert got == want
    in_row = df.select("token", entities.fuzzy_in_row(F.col("token")).alias("e")).collect()
    assert {r["token"]: r["e"][0] for r in in_row if r["e"]} == {t: e for t, e in want.items() if len(t) >= 5}


def test_join_on_ngrams_equals_search(spark):
    posts = spark.createDataFrame([(1, "viva el pacto historico ya"), (2, "el tigre y tigre"), (3, ""), (4, "pacto")], "k int, t string")
    aliases = spark.createDataFrame(list(lexicon.CANDIDATE_ALIASES.items()), "alias string, entity string")
    joined = {(r["k"], r["entity"]) for r in entities.alias_entities_by_join(posts, "k", "t", aliases).collect()}
    inline = {(r["k"], e) for r in posts.select("k", entities.alias_entities(F.col("t")).alias("e")).collect() for e in r["e"]}
    assert joined == inline == {(1, "Ivan Cepeda"), (2, "Abelardo De la Espriella")}


def test_lengths_with_few_aliases_send_only_those_through_the_join(spark, monkeypatch):
    monkeypatch.setattr(entities, "INLINE_ALIASES", 3)
    posts = spark.createDataFrame([(1, "viva el pacto ya"), (2, "ya ya el tigre"), (2, "ya ya el tigre"), (3, ""), (4, None)], "k int, t string")
    aliases = spark.createDataFrame([("ya", "Y"), ("tigre", "T"), *[(f"a{i} b", "B") for i in range(9)], ("el tigre", "T"), (None, "N")],
                                    "alias string, entity string")
    runs = sorted((r["k"], r["alias"]) for r in entities.alias_runs(posts, "k", "t", aliases).collect())
    two = [(2, x) for x in ("el tigre", "tigre", "ya", "ya el", "ya ya") for _ in range(2)]
    assert runs == [(1, "el pacto"), (1, "pacto ya"), (1, "viva el"), (1, "ya"), *two]
    got = sorted((r["k"], r["entity"]) for r in entities.alias_entities_by_join(posts, "k", "t", aliases).collect())
    assert got == [(1, "Y"), (2, "T"), (2, "Y")]


def test_a_large_dictionary_gives_the_same_columns(spark):
    df = spark.createDataFrame([("viva el pacto historico ya a7",), ("el tigre y tigre a600 b",), ("",), (None,)], "n string")
    more = {f"a{i} b": f"e{i}" for i in range(1000)} | {"a7": "siete"}
    small = {r["n"]: (r["candidatos"], r["partidos"]) for r in entities.with_entities(df, "n", fuzzy_targets=None).collect()}
    large = {r["n"]: (r["candidatos"], r["partidos"]) for r in entities.with_entities(
        df, "n", aliases=lexicon.CANDIDATE_ALIASES | more, fuzzy_targets=None).collect()}
    extra = {"viva el pacto historico ya a7": ["siete"], "el tigre y tigre a600 b": ["e600"]}
    assert large == {k: (sorted([*c, *extra.get(k, [])]), p) for k, (c, p) in small.items()}


def test_intention(one):
    got = one(entities.stated_intention, "Voto por Paloma", "según la encuesta voto por ella", "mi voto es para él", "devoto por",
              "", "mi voto para", "¡que gane!")
    assert got == [1, 0, 1, 0, 0, 1, 1]


def test_close_targets_by_join_equal_those_by_expression(spark):
    import random
    r = random.Random(7)
    word = lambda n: "".join(r.choice("abcde") for _ in range(n))
    targets = {word(r.randint(5, 14)): f"e{i % 9}" for i in range(40)}
    tokens = {word(r.randint(4, 16)) for _ in range(60)}
    for t in targets:
        for _ in range(3):
            c = list(t)
            for _ in range(r.randint(0, 2)):
                k = r.randrange(len(c))
                c[k:k + r.randint(0, 1)] = r.choice([[], ["z"], [c[k], "a"]])
            tokens.add("".join(c))
    df = spark.createDataFrame([(t,) for t in sorted(tokens) if t], "token string")
    rows = lambda out: sorted((x["token"], x["entity"], round(x["ratio"], 9)) for x in out.collect())
    one, two = rows(entities.close_targets(df, targets)), rows(entities.close_targets_by_join(df, targets))
    assert one == two and len(one) > 60


def test_similarity_is_computed_per_distinct_token(spark):
    df = spark.createDataFrame([(i, "cepeda cepedas otra") for i in range(3)], "seq int, t string")
    tokens = entities.post_tokens(df, "seq", "t").select("token").distinct()
    found = entities.close_targets(tokens, lexicon.FUZZY_TARGETS)
    plan = found._jdf.queryExecution().optimizedPlan().toString().split("\n")
    below = plan[next(i for i, line in enumerate(plan) if "Aggregate" in line) + 1:]
    assert not any("levenshtein" in line for line in below)
    assert {r["token"] for r in found.collect()} == {"cepeda", "cepedas"}
