"""Token counts: rollups kept up to date by signed deltas, in batches that commit once.

A document may be there several times: its count holds with a multiplicity. A change inserts n copies of a
document counted by one tokenizer version, deletes n of them, or revises the count of those that are there.
Applying a batch turns its changes into signed entries: +n for copies that come, -n for copies that go, both with the
count they have. The batch's entries, added up by source, language and tokenizer, are its delta; the totals are
the sum of the deltas of all committed batches.

Entries are laid out by range of the document's hash (`part`, `PARTS` folders per batch): a batch reads the ranges that
it touches, and of batches written before only the entries of its documents pass on to the shuffle. `compact` writes the live
counts as one batch in place of all former ones, so that the number of folders stays bounded.

A batch is written under its own name, entries first, and exists once its name is in the commit table. A batch
that failed half-way is written anew; a committed one is left alone, however often it is sent.
"""

import base64
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The word tokenizers by version. A vocabulary file of a byte-pair tokenizer is another (`bpe_counts`).
WORD_TOKENIZERS = {"words-1": r"[^\x20\x09-\x0D]+", "words-2": r"[^\x09-\x0D\x20-\x2F\x3A-\x40]+"}

KEY = ("doc_id", "tokenizer", "doc_key")
GROUP = ("source", "lang", "tokenizer")
PARTS = 64
ENTRY = "part int, doc_id long, tokenizer string, doc_key long, source string, lang string, each long, n_docs long"


def document_key() -> Column:
    """Tells documents of one id, or of none, apart: a hash of source, language and text, NULLs included."""
    return F.xxhash64(*[x for c in ("source", "lang", "text") for x in (F.col(c).isNull(), F.col(c))])


def _with_copies(changes: DataFrame) -> DataFrame:
    """One change for equal rows, with their number."""
    return changes.groupBy("op", *KEY, "source", "lang", "n_tokens").agg(F.count(F.lit(1)).alias("copies"))


def word_counts(documents: DataFrame, tokenizer: str, op: str = "insert", key: Column | None = None) -> DataFrame:
    """Changes for every row of `documents`; NULL texts have no tokens. Equal rows are one change with its `copies`.

    `key` is the `document_key` of the rows as they were inserted, where they are revised (default: of the rows as they are).
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    return _with_copies(documents.select(
        F.lit(op).alias("op"), F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.lit(tokenizer).alias("tokenizer"),
        (document_key() if key is None else key).alias("doc_key"),
        F.regexp_count(body, F.lit(WORD_TOKENIZERS[tokenizer])).cast("long").alias("n_tokens"),
    ))


def bpe_counts(documents: DataFrame, path: str, pattern: str, tokenizer: str, op: str = "insert", key: Column | None = None) -> DataFrame:
    """Changes as those of `word_counts`, counted by a byte-pair vocabulary, a file of base64 tokens and ranks that the driver reads and broadcasts."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    source = documents.sparkSession.sparkContext.broadcast(ranks)

    def run(batches):
        import tiktoken

        encoding = tiktoken.Encoding(tokenizer, pat_str=pattern, mergeable_ranks=source.value, special_tokens={})
        for batch in batches:
            counts = [len(encoding.encode_ordinary(text or "")) for text in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                pa.array([op] * len(counts), pa.string()), batch.column(0), batch.column(1), batch.column(2),
                pa.array([tokenizer] * len(counts), pa.string()), batch.column(4), pa.array(counts, pa.int64()),
            ], names=["op", "doc_id", "source", "lang", "tokenizer", "doc_key", "n_tokens"])

    own = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string"), F.col("lang").cast("string"), "text",
        (document_key() if key is None else key).alias("doc_key"),
    )
    return _with_copies(own.mapInArrow(run, "op string, doc_id long, source string, lang string, tokenizer string, doc_key long, n_tokens long"))


class Ledger:
    """The batches under one folder: `staged/<batch>`, `entries/<batch>/part=<range>`, `deltas/<batch>` and the table `commits`.

    `parts`, the number of ranges, is the same for the life of the folder.
    """

    def __init__(self, spark: SparkSession, root: str, parts: int = PARTS):
        self.spark, self.root, self.parts = spark, root, parts

    def _part(self) -> Column:
        return F.pmod(F.xxhash64("doc_id", "doc_key"), F.lit(self.parts)).cast("int")

    def _lay_out(self, entries: DataFrame, name: str):
        entries.hint("rebalance", "part").write.mode("overwrite").partitionBy("part").parquet(f"{self.root}/entries/{name}")

    def _commits(self) -> list[tuple[str, bool]]:
        """(name, compacted) of the committed batches in order; a name that rival writers committed twice counts once."""
        try:
            rows = self.spark.read.schema("batch string, compacted boolean").parquet(f"{self.root}/commits").distinct().collect()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted((r["batch"], bool(r["compacted"])) for r in rows)

    def committed(self) -> list[str]:
        """Names of the committed batches, those that `compact` put together included."""
        return [name for name, compacted in self._commits() if not compacted]

    def _folders(self) -> list[str]:
        """What is to be read: the last compaction, and the batches that it does not hold."""
        commits = self._commits()
        last = max((name for name, compacted in commits if compacted), default=None)
        if last is None:
            return [name for name, _ in commits]
        held = self.spark.read.schema("batch string").parquet(f"{self.root}/held/{last}").collect()
        return [last] + sorted({name for name, compacted in commits if not compacted} - {r["batch"] for r in held})

    def _read(self, kind: str, schema: str) -> DataFrame:
        folders = self._folders()
        if not folders:
            return self.spark.createDataFrame([], schema)
        found = [self.spark.read.schema(schema).parquet(f"{self.root}/{kind}/{name}") for name in folders]
        return reduce(DataFrame.unionByName, found)

    def entries(self) -> DataFrame:
        return self._read("entries", ENTRY)

    def live(self) -> DataFrame:
        """(doc_id, tokenizer, doc_key, source, lang, each, n_docs) of the counts that hold now: `n_docs` copies of `each` tokens."""
        return _summed(self.entries()).where("n_docs > 0")

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Commits a batch of changes (op, doc_id, source, lang, tokenizer, n_tokens); False if it was committed before.

        op is insert, revise or delete, for `copies` equal documents (an optional column, default 1). A document is an id,
        and with the optional column `doc_key` an id and that key. Inserts add their copies to those that are there.
        Deletes take copies away, first those of the same source, language and count, then the others by (source, lang, count); what
        is not there cannot go. A revision gives all copies that are there the new source, language and count; where there
        is none it inserts its own. Of several changes of one document and tokenizer in a batch, the greatest by (op,
        source, lang, n_tokens, copies) holds, so a repeated change counts once. NULL is an id, a key, a source and a
        language like any other; NULL counts are 0. Extra columns are not read. An empty batch commits.
        """
        if batch in self.committed():
            return False
        for name, default in (("doc_key", None), ("copies", 1)):
            if name not in changes.columns:
                changes = changes.withColumn(name, F.lit(default).cast("long"))
        fields = F.struct("op", "source", "lang", F.coalesce("n_tokens", F.lit(0)).cast("long").alias("each"), "copies")
        latest = changes.groupBy(*KEY).agg(F.max(fields).alias("c")).select(*KEY, F.col("c"), self._part().alias("part"))
        # Texts are counted once; all that follows reads the changes as they were written.
        staged = f"{self.root}/staged/{batch}"
        latest.write.mode("overwrite").parquet(staged)
        self._lay_out(self._moves(self.spark.read.schema(latest.schema).parquet(staged)), batch)
        self._commit(batch)
        return True

    def _moves(self, latest: DataFrame) -> DataFrame:
        """The signed entries of a batch's changes."""
        new = latest.select(*KEY, "c.*", "part")
        fresh = new.where("op = 'insert'").select("part", *KEY, "source", "lang", "each", F.col("copies").alias("n_docs"))
        touching = new.where("op <> 'insert'")
        if not self._folders() or touching.isEmpty():
            unknown = touching.where("op = 'revise'").select("part", *KEY, "source", "lang", "each", F.col("copies").alias("n_docs"))
            return fresh.unionByName(unknown)
        parts = [r["part"] for r in touching.select("part").distinct().collect()]
        change = touching.select("part", *[F.col(k).alias(f"k_{k}") for k in KEY], F.struct("op", "source", "lang", "each", "copies").alias("c"))
        own = F.lit(True)
        for k in KEY:
            own &= F.col(k).eqNullSafe(F.col(f"k_{k}"))
        known = self.live_of(parts).join(change.drop("part"), own, "right")
        was = F.struct("source", "lang", "each")
        same = was.eqNullSafe(F.struct("c.source", "c.lang", "c.each"))
        order = Window.partitionBy(*[f"k_{k}" for k in KEY]).orderBy(same.desc(), was)
        before = F.coalesce(F.sum("n_docs").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        here = F.coalesce("n_docs", F.lit(0))
        gone = F.when(F.col("c.op") == "revise", here).otherwise(F.greatest(F.lit(0), F.least(here, F.col("c.copies") - before)))
        come = F.when(F.col("c.op") == "revise", F.coalesce("n_docs", "c.copies")).otherwise(0)
        both = known.withColumns({"gone": gone, "come": come}).select(*[f"k_{k}" for k in KEY], F.explode(F.array(
            F.struct("source", "lang", "each", (-F.col("gone")).alias("n_docs")),
            F.struct("c.source", "c.lang", "c.each", F.col("come").alias("n_docs")),
        )).alias("e")).where("e.n_docs <> 0")
        moved = both.select(*[F.col(f"k_{k}").alias(k) for k in KEY], "e.*")
        return fresh.unionByName(moved.withColumn("part", self._part()))

    def live_of(self, parts: list[int]) -> DataFrame:
        """The counts that hold now in some ranges of the documents' hash; no other range is read."""
        return _summed(self.entries().where(F.col("part").isin(parts))).where("n_docs > 0")

    def _commit(self, name: str, compacted: bool = False):
        entries = self.spark.read.schema(ENTRY).parquet(f"{self.root}/entries/{name}")
        delta = entries.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum(F.col("n_docs") * F.col("each")).alias("n_tokens"))
        delta.write.mode("overwrite").parquet(f"{self.root}/deltas/{name}")
        row = self.spark.createDataFrame([(name, compacted)], "batch string, compacted boolean")
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/commits")

    def compact(self):
        """Writes the live counts as one folder that stands for all committed batches. Their names stay committed."""
        held = self.committed()
        if not held:
            return
        name = f"compact-{sum(compacted for _, compacted in self._commits()):06d}"
        self._lay_out(self.live().withColumn("part", self._part()), name)
        self.spark.createDataFrame([(x,) for x in held], "batch string").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/held/{name}")
        self._commit(name, True)

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) of all committed batches; groups without documents are left out."""
        deltas = self._read("deltas", "source string, lang string, tokenizer string, n_docs long, n_tokens long")
        summed = deltas.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return summed.where("n_docs <> 0 OR n_tokens <> 0")


def _summed(entries: DataFrame) -> DataFrame:
    return entries.groupBy(*KEY, "source", "lang", "each").agg(F.sum("n_docs").alias("n_docs"))
