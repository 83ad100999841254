"""Delta-maintained token counts (operator 8).

The totals per source, language and tokenizer version are sums of signed
entries, so they are maintained by adding a batch's entries and never
recounted. A ledger in the shared folder keeps, per batch, the entries of its
documents and their sums per group:

* an insert adds a document's count,
* a delete subtracts what the ledger holds for the document,
* a revision does both, under the new source, language or tokenizer version.

A batch has an id and is committed once, batches in the order of their ids.
Each attempt writes into folders of its own, below ``run=<unique>``, and ends
with a small marker folder that names them; readers only see marked runs (of
two attempts that both finished, which hold the same, the first by name).
Nothing is overwritten, so an attempt that dies leaves the ledger as it was, and
committing a finished batch again changes nothing. One writer at a time; a new
batch below a finished one is refused.

After every ``fold_every`` batches the entries so far are folded into the current
state, one row for each document and group that it counts in, and the totals
into one table. A commit reads the last state and the entries since, so its
cost doesn't grow with the number of batches before it.

Null sources and languages are groups of their own. In a batch the rows with a
document's highest ``seq`` count: all of them, where a table repeats an id, or
none if a delete is among them. Deleting an unknown document does nothing;
inserting a known one revises it. A row with a null id is a document of its own
that can't be named again: it counts once inserted or revised, and a delete
without an id does nothing. A null ``seq`` is the lowest, null tokens are 0.
Empty batches are committed too.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import slices, stage, text_bytes, text_slices
from tidewater.llm.token_blocks import word_encoder

GROUP = ["source", "lang", "tokenizer"]
_ENTRY = "doc_id long, source string, lang string, tokenizer string, docs long, tokens long"
_TOTAL = "source string, lang string, tokenizer string, docs long, tokens long"


class TokenLedger:
    """Signed entries and their sums below ``root``."""

    def __init__(self, spark: SparkSession, root: str, fold_every: int = 8):
        self.spark, self.root, self.fold_every = spark, root, fold_every

    def _runs(self, kind: str) -> dict[int, str]:
        """The finished run of each batch that has one."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{kind}/batch=*/run=*/_SUCCESS")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [f.getPath().getParent() for f in fs.globStatus(path) or []]
        runs: dict[int, str] = {}
        for run in sorted(found, key=lambda p: p.getName(), reverse=True):
            runs[int(run.getParent().getName().split("=")[1])] = run.getName()
        return dict(sorted(runs.items()))

    def _read(self, schema: str, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else \
            self.spark.createDataFrame([], schema)

    def _since_fold(self, table: str, folded: str, schema: str) -> DataFrame:
        """The last fold of ``table`` and what was committed after it."""
        folds = list(self._runs("folds").items())[-1:]
        last = folds[0][0] if folds else None
        paths = [f"{self.root}/{folded}/batch={b}/{run}" for b, run in folds]
        paths += [f"{self.root}/{table}/batch={b}/{run}" for b, run in self._runs("batches").items()
                  if last is None or b > last]
        return self._read(schema, paths)

    def _mark(self, kind: str, batch: int, run: str) -> None:
        (self.spark.range(1).select(F.lit(batch).alias("batch_id"))
         .write.parquet(f"{self.root}/{kind}/batch={batch}/{run}"))

    def entries(self) -> DataFrame:
        """All signed entries of the committed batches."""
        return self._read(_ENTRY, [f"{self.root}/entries/batch={b}/{run}"
                                   for b, run in self._runs("batches").items()])

    def state(self) -> DataFrame:
        """What the ledger counts now for each document with an id, by group."""
        return (self._since_fold("entries", "state", _ENTRY).where("doc_id IS NOT NULL")
                .groupBy("doc_id", *GROUP)
                .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
                .where("docs != 0 OR tokens != 0"))

    def commit(self, batch: int, changes: DataFrame) -> None:
        """``changes``: op ('insert', 'delete' or 'revise'), seq, doc_id, source,
        lang, tokenizer, tokens."""
        done = self._runs("batches")
        if batch in done:
            return
        if done and batch < max(done):
            raise ValueError(f"batch {batch} comes after batch {max(done)} was committed")
        # staged: the counts behind it are needed three times and are dear.
        # However many rows share an id (or have none), one row a group leaves a task
        summed = stage(
            changes.where("doc_id IS NOT NULL OR op != 'delete'")
            .groupBy("doc_id", "seq", (F.col("op") == "delete").alias("gone"), *GROUP)
            .agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")),
            "changes")
        nameless = (summed.where("doc_id IS NULL").groupBy("doc_id", *GROUP)
                    .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")))
        last = (summed.where("doc_id IS NOT NULL").groupBy("doc_id")
                .agg(F.max(F.struct("seq", "gone")).alias("c"))
                .select(F.col("doc_id").alias("id"), F.col("c.seq").alias("last_seq"),
                        F.col("c.gone").alias("last_gone")))
        rows = summed.where("NOT gone")
        new = rows.join(last.where("NOT last_gone"), (rows["doc_id"] == F.col("id"))
                        & rows["seq"].eqNullSafe(F.col("last_seq")), "left_semi")
        held = self.state()
        old = (held.join(last, held["doc_id"] == last["id"], "left_semi")
               .withColumns({"docs": -F.col("docs"), "tokens": -F.col("tokens")}))
        names = [c.split()[0] for c in _ENTRY.split(", ")]
        run = f"run={uuid.uuid4().hex}"
        path = f"{self.root}/entries/batch={batch}/{run}"
        new.select(*names).unionByName(old.select(*names)).unionByName(nameless.select(*names)) \
            .write.parquet(path)
        (self._read(_ENTRY, [path]).groupBy(*GROUP)
         .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
         .write.parquet(f"{self.root}/totals/batch={batch}/{run}"))
        # the commit itself: a reader sees the batch from here on
        self._mark("batches", batch, run)
        folds = self._runs("folds")
        if sum(not folds or b > max(folds) for b in [*done, batch]) >= self.fold_every:
            self.fold()

    def fold(self) -> None:
        """Fold what is committed into the current state and one table of totals."""
        done, folds = self._runs("batches"), self._runs("folds")
        if not done or max(done) in folds:
            return
        batch, run = max(done), f"run={uuid.uuid4().hex}"
        self.state().write.parquet(f"{self.root}/state/batch={batch}/{run}")
        self._sums().write.parquet(f"{self.root}/state_totals/batch={batch}/{run}")
        self._mark("folds", batch, run)

    def _sums(self) -> DataFrame:
        return (self._since_fold("totals", "state_totals", _TOTAL).groupBy(*GROUP)
                .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
                .where("docs != 0 OR tokens != 0"))

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) of all committed batches;
        groups that became empty are left out."""
        return self._sums().withColumnsRenamed({"docs": "n_docs", "tokens": "n_tokens"})


def _word_counter(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        for whole in batches:
            for batch in text_slices(whole, 3):
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:3], pa.array(encoder.count(batch.column(3)), pa.int64())],
                    names=["doc_id", "source", "lang", "tokens"])
    return run


def _rank_counter(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import base64

        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        coder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks,
                                  special_tokens={})
        for whole in batches:
            for batch in slices(whole, 64):
                counts = [len(coder.encode_ordinary(t.decode("utf-8", "replace")))
                          for t in batch.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:3], pa.array(np.array(counts, np.int64))],
                    names=["doc_id", "source", "lang", "tokens"])
    return run


def count_tokens(docs: DataFrame, path: str, pattern: str | None = None) -> DataFrame:
    """(doc_id, source, lang, tokens): tokens of each whole text, null as empty.
    ``path`` is a tokenizer file whose pieces don't cross white space or, with
    the ``pattern`` that splits texts for it, a rank file."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("source").cast("string").alias("source"),
                       F.col("lang").cast("string").alias("lang"), text_bytes().alias("text"))
    run = _rank_counter(path, pattern) if pattern else _word_counter(path)
    return rows.mapInArrow(run, "doc_id long, source string, lang string, tokens long")


def changes(counts: DataFrame, op: str, tokenizer: str, seq: int = 0) -> DataFrame:
    """A batch for ``TokenLedger.commit`` of counted documents."""
    return counts.select(F.lit(op).alias("op"), F.lit(seq).cast("long").alias("seq"), "doc_id",
                         "source", "lang", F.lit(tokenizer).alias("tokenizer"), "tokens")
