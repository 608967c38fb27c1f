"""Token counts as rollups kept up to date by signed changes.

Each batch of changed documents adds signed entries per document and tokenizer version: minus what the ledger holds of the
document, plus its new counts (nothing for a delete). Their sums per source, language and tokenizer version are the batch's
additive change of the totals. A batch counts once its change of the totals is written whole (Spark's success mark); a
batch that comes again is passed over, and one that broke off is written anew, so retries change nothing.

Counting is done in the tasks that read the texts; only counts are shuffled, combined before the shuffle, so a source that
holds a third of all rows costs no more than any other.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from agoralake.session import stored

TOKENIZERS = "/opt/tokenizers"
VERSIONS = {"byte_bpe_50k@1": "byte_bpe_50k.tiktoken", "words@1": ""}  # tokenizer version: file of ranks, none for words
#: Fixed value: how the byte-level vocabularies split a text before merging.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

DRAFTS = 8  # one document in so many, by a hash of its id, comes as a draft first and is revised

ENTRY = "doc_id long, source string, lang string, tokenizer string, docs long, tokens long"
TOTAL = "source string, lang string, tokenizer string, docs long, tokens long"

_loaded: dict[str, object] = {}


def counter(path: str, file: str):
    """A function from text to its number of tokens; a vocabulary is loaded once per Python worker."""
    if not file:
        return lambda text: len(text.split())
    key = f"{path}/{file}"
    if key not in _loaded:
        import tiktoken
        with open(key, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _loaded[key] = tiktoken.Encoding(file, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
    return lambda text: len(_loaded[key].encode_ordinary(text))


def _counted(path: str, versions: dict[str, str]):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = [counter(path, file) for file in versions.values()]
        for batch in batches:
            rows = [[count(t) for count in counters] for t in (x.as_py() or "" for x in batch.column(3))]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(3)], pa.array(rows, pa.list_(pa.int64()))], names=["doc_id", "source", "lang", "tokens"])
    return counted


def document_counts(documents: DataFrame, versions: dict[str, str] = VERSIONS, path: str = TOKENIZERS) -> DataFrame:
    """ENTRY rows: the tokens of every document by every tokenizer version. Null and empty texts have none."""
    names = F.array(*[F.lit(v) for v in versions])
    counted = documents.select("doc_id", "source", "lang", "text").mapInArrow(
        _counted(path, versions), "doc_id long, source string, lang string, tokens array<long>")
    return counted.select("doc_id", "source", "lang", F.explode(F.arrays_zip(names.alias("tokenizer"), F.col("tokens"))).alias("x")).select(
        "doc_id", "source", "lang", "x.tokenizer", F.lit(1).cast("long").alias("docs"), "x.tokens")


class TokenLedger:
    """Signed entries and additive totals under one folder; both have a folder for each batch."""

    def __init__(self, spark: SparkSession, path: str, versions: dict[str, str] = VERSIONS, tokenizers: str = TOKENIZERS):
        self.spark, self.path, self.versions, self.tokenizers = spark, path.rstrip("/"), versions, tokenizers

    def committed(self) -> list[str]:
        """The batches that count, by their success marks."""
        found = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/totals/*/_SUCCESS")
        files = found.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(found)
        return sorted(f.getPath().getParent().getName() for f in (files or []))

    def _read(self, kind: str, schema: str) -> DataFrame:
        paths = [f"{self.path}/{kind}/{b}" for b in self.committed()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def current(self, doc_ids: DataFrame) -> DataFrame:
        """What the ledger holds of the documents in ``doc_ids`` (doc_id): ENTRY rows with positive docs."""
        return self._read("entries", ENTRY).join(doc_ids.distinct(), "doc_id", "left_semi").groupBy(
            "doc_id", "source", "lang", "tokenizer").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).filter(
            "docs <> 0 or tokens <> 0")

    def commit(self, batch: str, upserts: DataFrame | None = None, deletes: DataFrame | None = None) -> bool:
        """Apply a batch: ``upserts`` (doc_id, source, lang, text) new or revised, ``deletes`` (doc_id). False if it was
        applied before.

        Rows of one batch that share a doc_id count each; together they replace what was held of it. A document in both is
        replaced. Deletes of unknown documents and rows without a doc_id that were never counted change nothing.
        """
        if f"batch={batch}" in self.committed():
            return False
        touched = [x.select("doc_id") for x in (upserts, deletes) if x is not None]
        if not touched:
            return False
        old = self.current(touched[0] if len(touched) == 1 else touched[0].union(touched[1]))
        entries = old.select("doc_id", "source", "lang", "tokenizer", (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens"))
        if upserts is not None:
            entries = entries.unionByName(document_counts(upserts, self.versions, self.tokenizers))
        entries.write.mode("overwrite").parquet(f"{self.path}/entries/batch={batch}")
        written = self.spark.read.schema(ENTRY).parquet(f"{self.path}/entries/batch={batch}")
        written.groupBy("source", "lang", "tokenizer").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).coalesce(1).write.mode(
            "overwrite").parquet(f"{self.path}/totals/batch={batch}")
        return True

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, docs, tokens): sums of the batches' changes, without groups that came back to none."""
        return self._read("totals", TOTAL).groupBy("source", "lang", "tokenizer").agg(
            F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).filter("docs <> 0 or tokens <> 0")


def later_copies(documents: DataFrame) -> DataFrame:
    """(doc_id): documents whose whole text another document with a smaller doc_id has; null texts are no copies."""
    texts = documents.filter("text is not null and doc_id is not null").select("doc_id", F.sha2("text", 256).alias("h"))
    first = texts.groupBy("h").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    # Stored, so that both sides of the join are plain shuffles, of which Spark splits the part of a very common text.
    return texts.join(stored(first, "repeated-texts"), "h").filter("doc_id > first").select("doc_id")


def drafts(documents: DataFrame) -> DataFrame:
    """A first version of documents: the text without its last line, no language and the source ``draft``."""
    return documents.select(
        "doc_id", F.lit("draft").alias("source"), F.lit(None).cast("string").alias("lang"), F.regexp_replace("text", r"\n?[^\n]*\z", "").alias("text"))


def maintained_counts(documents: DataFrame, path: str) -> DataFrame:
    """Totals after loading all documents, some as drafts, loading them again (which changes nothing), revising the drafts
    (text, source and language) and deleting exact copies: those of the documents less later copies.

    An empty table gives no rows; null sources and languages are groups of their own; other columns are not read.
    """
    ledger = TokenLedger(documents.sparkSession, path)
    thin = documents.select("doc_id", "source", "lang", "text")
    revised = F.col("doc_id").isNotNull() & (F.pmod(F.xxhash64("doc_id"), F.lit(DRAFTS)) == 0)
    load = thin.filter(~revised).unionByName(drafts(thin.filter(revised)))
    ledger.commit("load", upserts=load)
    ledger.commit("load", upserts=load)
    ledger.commit("revisions", upserts=thin.filter(revised))
    ledger.commit("copies", deletes=later_copies(thin))
    return ledger.totals()
