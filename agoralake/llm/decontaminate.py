"""Benchmark decontamination with a distributed positional inverted index.

The index stores a posting (document, position, term) for every token of the training texts whose term some benchmark
item has; no other token can be part of a match. Terms are counted in it. Each benchmark window starts from the postings
of its rarest term, shifted by the term's offset; the list is intersected with the shifted postings of the second rarest
term, and what is left with those of all other terms. Postings are joined on (document, position, term), so a term, item
or passage that a third of the documents hold is spread over as many keys as it has occurrences.

All steps are DataFrame operations. Texts are read once. Tables of benchmark terms and windows are broadcast only when
their counted size fits a limit, and are joined by shuffle otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from agoralake.llm.common import ascii_lower, broadcast_if_small, packed, unpacked
from agoralake.session import stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
KEY = ["row_key", "doc_key"]


def words(text: Column) -> Column:
    """Lower-cased (A-Z) words of a text; a null text has none."""
    return F.coalesce(F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def benchmark_terms(benchmark: DataFrame) -> DataFrame:
    """(item_id, n_item, k, term, term_id): the words of every item with their places; items without words give no rows."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("ws")).filter(
        "item_id is not null and size(ws) > 0").distinct()
    return items.select("item_id", F.hash("ws").alias("variant"), F.size("ws").alias("n_item"), F.posexplode("ws").alias("k", "term")).withColumn(
        "term_id", F.xxhash64("term"))


def build_index(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """(row_key, doc_key, doc_id, n_words, pos, term_id): postings of ``documents`` for the stored table ``terms`` (term,
    term_id), written to the shared folder.

    Each document also has a row for place 0 (a null place if it has no words), so its word count is always there.
    row_key and doc_key tell rows apart that share a doc_id but not their text; rows that repeat each other whole share
    their postings.
    """
    docs = documents.select(
        F.xxhash64("doc_id", "text").alias("row_key"), F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc_key"), "doc_id",
        words(F.col("text")).alias("ws"))
    tokens = docs.select(*KEY, "doc_id", F.size("ws").alias("n_words"), "ws").select(
        *KEY, "doc_id", "n_words", F.posexplode_outer("ws").alias("pos", "term"))
    kept = tokens.join(broadcast_if_small(terms, 64), "term", "left").filter("term_id is not null or coalesce(pos, 0) = 0")
    return stored(kept.select(*KEY, "doc_id", "n_words", "pos", "term_id"), "positional-index")


def windows(bench: DataFrame, counts: DataFrame, n: int = WINDOW) -> DataFrame:
    """(item_id, variant, start, len, parts): windows whose terms all occur, parts = [(n, term_id, k)] from rarest to most
    frequent term."""
    starts = bench.filter((F.col("k") <= F.col("n_item") - n) | (F.col("k") == 0)).select(
        "item_id", "variant", F.col("k").alias("start"), F.least(F.col("n_item"), F.lit(n)).alias("len"))
    known = bench.join(counts, "term_id", "left")
    inside = starts.join(known, ["item_id", "variant"]).filter("k >= start and k < start + len")
    return inside.groupBy("item_id", "variant", "start", "len").agg(
        F.array_sort(F.collect_list(F.struct("n", "term_id", (F.col("k") - F.col("start")).alias("k")))).alias("parts"),
        F.count("n").alias("found")).filter("found = len").drop("found")


def match_windows(index: DataFrame, wins: DataFrame) -> DataFrame:
    """(item_id, row_key, doc_key, at, len): exact occurrences of the stored windows in the indexed documents."""
    postings = index.filter("term_id is not null")
    seeds = wins.select("item_id", "len", F.col("parts")[0]["term_id"].alias("term_id"), F.col("parts")[0]["k"].alias("k"),
                        F.slice("parts", 2, WINDOW).alias("rest"))
    seeds = broadcast_if_small(stored(seeds, "seeds"), 512)
    found = postings.join(seeds, "term_id").withColumn("at", F.col("pos") - F.col("k")).filter(
        "at >= 0 and at + len <= n_words").select("item_id", *KEY, "at", "len", "rest")
    single = found.filter("size(rest) = 0")
    second = stored(seeds.select(F.col("rest")[0]["term_id"].alias("term_id")).filter("term_id is not null").distinct(), "second-terms")
    narrow = postings.join(broadcast_if_small(second, 16), "term_id", "left_semi").select(
        *KEY, F.col("pos").alias("p"), F.col("term_id").alias("t"))
    pairs = found.filter("size(rest) > 0").withColumn("t", F.col("rest")[0]["term_id"]).withColumn(
        "p", F.col("at") + F.col("rest")[0]["k"]).join(narrow, [*KEY, "p", "t"], "left_semi")
    pairs = stored(pairs.withColumn("rest", F.slice("rest", 2, WINDOW)).select("item_id", *KEY, "at", "len", "rest").union(
        single).distinct(), "window-candidates")
    hit_docs = stored(pairs.filter("size(rest) > 0").select(*KEY).distinct(), "candidate-documents")
    all_terms = postings.join(broadcast_if_small(hit_docs, 32), KEY, "left_semi").select(
        *KEY, F.col("pos").alias("p"), F.col("term_id").alias("t"))
    steps = pairs.filter("size(rest) > 0").select("item_id", *KEY, "at", "len", F.size("rest").alias("need"), F.explode("rest").alias("x")).select(
        "item_id", *KEY, "at", "len", "need", (F.col("at") + F.col("x.k")).alias("p"), F.col("x.term_id").alias("t"))
    full = steps.join(all_terms, [*KEY, "p", "t"], "left_semi").groupBy("item_id", *KEY, "at", "len", "need").agg(
        F.countDistinct("p").alias("got")).filter("got = need")
    return full.select("item_id", *KEY, "at", "len").union(
        pairs.filter("size(rest) = 0").select("item_id", *KEY, "at", "len"))


def near_matches(index: DataFrame, bench: DataFrame, first: str, second: str, slop: int) -> DataFrame:
    """(doc_id, at, other): places where the terms ``first`` and ``second`` stand at most ``slop`` words apart.

    Postings are joined on (document, block of slop + 1 places), each second posting in the blocks beside its own too.
    """
    code = lambda term: F.xxhash64(F.lit(term))
    width = F.lit(slop + 1)
    left = index.filter(F.col("term_id") == code(first)).select(*KEY, "doc_id", F.col("pos").alias("at"), F.expr(f"pos div {slop + 1}").alias("block"))
    right = index.filter(F.col("term_id") == code(second)).select(
        *KEY, F.col("pos").alias("other"), F.explode(F.array(*[F.floor(F.col("pos") / width) + i for i in (-1, 0, 1)])).alias("block"))
    return left.join(right, [*KEY, "block"]).filter((F.abs(F.col("at") - F.col("other")) <= slop) & (F.col("at") != F.col("other"))).select(
        "doc_id", "at", "other").distinct()


def find_matches(documents: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The stored index of ``documents`` and the stored exact matches of the benchmark's windows in it."""
    bench = stored(benchmark_terms(benchmark), "benchmark-terms")
    terms = stored(bench.select("term", "term_id").distinct(), "benchmark-vocabulary")
    index = build_index(documents, terms)
    counts = stored(index.filter("term_id is not null").groupBy("term_id").agg(F.count(F.lit(1)).alias("n")), "term-counts")
    wins = stored(windows(bench, counts), "benchmark-windows")
    return index, stored(match_windows(index, wins), "window-matches")


def document_report(index: DataFrame, matches: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, row_key, doc_key), one row per indexed row."""
    spans = matches.select(*KEY, "at", (F.col("at") + F.col("len")).alias("end")).groupBy(*KEY, "at").agg(F.max("end").alias("end"))
    before = W.partitionBy(*KEY).orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    hit = spans.withColumn("done", F.coalesce(F.max("end").over(before), F.lit(0))).groupBy(*KEY).agg(
        F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("at", "done"))).cast("long").alias("n_hit"))
    items = matches.groupBy(*KEY).agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    found = hit.join(items, KEY)
    docs = index.filter("coalesce(pos, 0) = 0").select(*KEY, "doc_id", F.col("n_words").cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return docs.join(found, KEY, "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.concat_ws(",", "items"), F.lit("")), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), *KEY)


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document with its word count, the words hit by benchmark windows, and the items found.

    A window is WINDOW consecutive words of an item, or all words of a shorter item. Null and empty texts have no words and
    no hits; repeated rows give a row each; empty tables on either side give no hits; other columns are not read.
    """
    return document_report(*find_matches(documents, benchmark))


def clean_documents(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` without a benchmark window, all columns kept, whatever their names.

    Contaminated rows are found by their key; only keys are joined against, and texts are shuffled only if those keys are
    too many to be broadcast.
    """
    _, matches = find_matches(documents, benchmark)
    bad = stored(matches.select(F.col("row_key").alias("_row"), F.col("doc_key").alias("_doc")).distinct(), "contaminated")
    clean = packed(documents).join(broadcast_if_small(bad, 32), (F.xxhash64("row.doc_id", "row.text") == F.col("_row")) & (
        F.coalesce("row.doc_id", F.lit(-(1 << 63))) == F.col("_doc")), "left_anti")
    return unpacked(clean, documents.columns)
