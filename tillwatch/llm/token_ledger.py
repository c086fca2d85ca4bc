"""Token totals kept up to date by signed changes.

A ledger is a folder of committed batches. A batch takes the new state of some
documents (or their deletion), looks up what the ledger holds of them and stores
the differences: minus the old count, plus the new one. Totals by source, language
and tokenizer are sums of the small totals of each batch, so reading them never
touches documents. A batch is written aside and renamed into place: it is there
whole or not at all, and committing its name again changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwatch.llm.packing import ID_BYTES, word_tokenizer
from tillwatch.llm.text import text_chunks, written

KEYS = ["source", "lang", "tokenizer"]
ENTRY = "doc_id long, source string, lang string, tokenizer string, n_docs long, n_tokens long"
OPS = ("insert", "revise", "delete")


def count_tokens(docs: DataFrame, tokenizer_path: str, tokenizer: str) -> DataFrame:
    """doc_id, source, lang, tokenizer, n_tokens for every row of `docs`; a null text has no tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_tokenizer(tokenizer_path)
        for batch, texts in text_chunks(batches):
            counts = [len(ids) // ID_BYTES for ids in encode.ids(texts)]
            columns = [*(batch.column(c) for c in ("doc_id", "source", "lang")), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "source", "lang", "n_tokens"])

    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c).cast("string").alias(c) for c in ("source", "lang", "text")]
    )
    counted = chosen.mapInArrow(run, "doc_id long, source string, lang string, n_tokens long")
    return counted.select("doc_id", "source", "lang", F.lit(tokenizer).alias("tokenizer"), "n_tokens")


@dataclass(frozen=True)
class TokenLedger:
    """Committed batches below `root`, a folder that all executors share."""

    spark: SparkSession
    root: str

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root.rstrip("/"), *parts]))

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _read(self, part: str) -> DataFrame:
        schema = ENTRY if part == "entries" else ENTRY.partition(", ")[2]
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root.rstrip('/')}/batches/*/{part}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply `changes` (op, doc_id, source, lang, tokenizer, n_tokens) once; False if already done.

        `insert` and `revise` set a document's count under a tokenizer, whatever
        was there; `delete` takes it away and is nothing for an unknown one. Of
        several changes to one document in a batch a deletion comes first, then the
        largest count. Nulls are values like any others, a null count is 0; other
        columns are ignored; an empty batch commits as empty.
        """
        done = self._path("batches", batch)
        if self._files().exists(done):
            return False
        key = ["doc_id", "tokenizer"]
        wish = F.struct((F.col("op") == "delete").alias("gone"), F.coalesce("n_tokens", F.lit(0)).alias("n"), "source", "lang")
        latest = changes.filter(F.col("op").isin(*OPS)).groupBy(*key).agg(F.max(wish).alias("new"))
        latest = written(latest, "ledger-changes")
        held = self._read("entries").groupBy("doc_id", "source", "lang", "tokenizer")
        held = held.agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).filter("n_docs <> 0")
        wanted = latest.select(*[F.col(c).alias(f"wanted_{c}") for c in key])
        same = F.col("doc_id").eqNullSafe(F.col("wanted_doc_id")) & F.col("tokenizer").eqNullSafe(F.col("wanted_tokenizer"))
        old = held.join(wanted, same, "left_semi")
        minus = old.select("doc_id", *KEYS, (-F.col("n_docs")).alias("n_docs"), (-F.col("n_tokens")).alias("n_tokens"))
        plus = latest.filter("not new.gone").select(
            "doc_id", "new.source", "new.lang", "tokenizer", F.lit(1).cast("long").alias("n_docs"), F.col("new.n").cast("long").alias("n_tokens")
        )
        aside = self._path("staging", f"{batch}-{uuid.uuid4().hex}")
        minus.unionByName(plus).write.parquet(f"{aside}/entries")
        entries = self.spark.read.schema(ENTRY).parquet(f"{aside}/entries")
        sums = entries.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        sums.coalesce(1).write.parquet(f"{aside}/totals")
        self._files().mkdirs(self._path("batches"))
        # A folder that is already there makes the rename fail or nest: of two writers one wins.
        if self._files().exists(done) or not self._files().rename(aside, done):
            return False
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens of all batches together; empty groups are left out."""
        sums = self._read("totals").groupBy(*KEYS)
        sums = sums.agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.filter("n_docs <> 0 or n_tokens <> 0")
