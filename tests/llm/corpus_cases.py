"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, extra columns with clashing names."""

import random

DOCS = "doc_id long, text string, lang string, source string, size long, fp string"


def prose(r: random.Random, n: int) -> str:
    syllables = "an er th on re in ed nd ha at en es of or ti is".split()
    return " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(n))


def awkward(seed: int = 5, n: int = 30) -> list[tuple]:
    r = random.Random(seed)
    texts = [prose(r, r.randint(3, 120)) for _ in range(n)]
    rows = [(i, t, r.choice(["en", "de", None]), r.choice(["a", "b", "é", None]), -1, "x") for i, t in enumerate(texts)]
    base = texts[0] + "\n" + prose(r, 60)
    near = base.split(" ")
    near[10] = "changed"
    extra = [None, "", "   ", "\n\n", base, base, " ".join(near), "É é ÀB ab", "word " * 5000, "x" * 3000, texts[1], "a\nb\na\nb", texts[2] + " " + texts[3]]
    rows += [(100 + i, t, "en", "a", 7, "y") for i, t in enumerate(extra)]
    return rows + [rows[3], rows[3], (None, texts[4], "en", "b", 1, "z"), (5, "other text for a used id", None, None, 1, "z")]


def documents(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, DOCS).repartition(3)
