"""Token counts kept by deltas: batches of signed counts add up to the totals.

A batch inserts, revises or deletes documents. Only the texts it brings are tokenised; the
counts it takes back come from the ledger of earlier batches. Each batch writes its signed
ledger rows, then its totals by source, language and tokenizer version, both in folders of
its own below `root`, which must be shared. A batch counts once its totals are there whole,
so a batch that is repeated after a failure writes the same rows again, and one that has
been committed is not read at all.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import by_bytes, stored, text_or_empty
from .tokens import encoder

#: Tokenizer versions and their vocabulary files.
VERSIONS = {"byte_bpe_50k": "byte_bpe_50k.json", "byte_bpe_multi_50k": "byte_bpe_multi_50k.tiktoken"}
GROUP = ["source", "lang", "version"]
LEDGER = "doc_id {id}, source string, lang string, version string, tokens long, sign int"


def token_counts(changes: DataFrame, versions: Mapping[str, str]) -> DataFrame:
    """`changes` (doc_id, source, lang, op, seq, text) without text, one row for each version with `tokens`."""
    rows = changes.select("doc_id", "source", "lang", "op", "seq", text_or_empty("text").alias("text"))
    kept = rows.schema.fieldNames()[:-1]
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text") + ", version string, tokens long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = {name: encoder(file) for name, file in versions.items()}
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for name, encode in coders.items():
                tokens = [len(ids) for some in by_bytes(texts, 4 << 20) for ids in encode(some)]
                columns = [batch.column(c) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([name] * len(texts)), pa.array(tokens, pa.int64())], [*kept, "version", "tokens"])

    return rows.mapInArrow(count, kind)


def committed(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the batches whose totals are there whole, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/totals")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    found = [s.getPath() for s in files.listStatus(path)]
    done = [p for p in found if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(p.getName().split("=")[1]) for p in done)


def parts(spark: SparkSession, root: str, kind: str, batches: list[int]) -> DataFrame | None:
    return spark.read.parquet(*[f"{root}/{kind}/batch={b}" for b in batches]) if batches else None


def commit(changes: DataFrame, root: str, batch: int, versions: Mapping[str, str] = VERSIONS) -> bool:
    """Add a batch of changes; False where it had been committed before.

    `changes` has op (insert, revise or delete), doc_id, source, lang, text and, if one
    document changes twice in a batch, seq: only its last change counts. An insert of a live
    document replaces it; a revision or deletion of one that is not live does nothing; an
    unknown op is an error. A revision may also move a document to another source or
    language. Rows without a doc_id can only be inserted and add up. Null sources and
    languages are groups of their own. Batches must come in the order of their numbers.
    """
    spark = changes.sparkSession
    earlier = committed(spark, root)
    if batch in earlier:
        return False
    if earlier and earlier[-1] > batch:
        raise ValueError(f"batch {earlier[-1]} is committed; {batch} comes too late")
    if "seq" not in changes.columns:
        changes = changes.withColumn("seq", F.lit(0))
    known = F.col("op").isin("insert", "revise", "delete")
    changes = changes.withColumn("op", F.when(known, F.col("op")).otherwise(F.raise_error(F.concat(F.lit("unknown op "), F.coalesce("op", F.lit("null"))))))
    each = F.explode(F.array(*map(F.lit, versions))).alias("version")
    deletes = changes.filter("op = 'delete'").select("doc_id", "source", "lang", "op", "seq", each)
    counted = token_counts(changes.filter("op <> 'delete'"), versions).unionByName(deletes.withColumn("tokens", F.lit(None).cast("long")))
    # read by several branches below; the texts are tokenised once
    counted.write.mode("overwrite").parquet(f"{root}/counted/batch={batch}")
    counted = spark.read.schema(counted.schema).parquet(f"{root}/counted/batch={batch}")
    last = Window.partitionBy("doc_id", "version").orderBy(F.col("seq").desc(), F.col("op"), F.col("tokens").desc(), "source", "lang")
    with_id = counted.filter("doc_id is not null").withColumn("turn", F.row_number().over(last)).filter("turn = 1").drop("turn")
    without_id = counted.filter("doc_id is null and op = 'insert'")
    fields = ["doc_id", "source", "lang", "version", "tokens", "sign"]
    ledger = parts(spark, root, "ledger", earlier)
    plus = F.lit(1).alias("sign")
    if ledger is None:
        signed = [with_id.filter("op = 'insert'").select(*fields[:-1], plus)]
    else:
        live = ledger.filter("doc_id is not null").groupBy(*fields[:-1]).agg(F.sum("sign").alias("n")).filter("n > 0").drop("n")
        names = {c: f"old_{c}" for c in ("source", "lang", "tokens")}
        met = with_id.join(live.withColumnsRenamed(names), ["doc_id", "version"], "left")
        was = F.col("old_tokens").isNotNull()
        back = F.struct(F.col("old_source").alias("source"), F.col("old_lang").alias("lang"), F.col("old_tokens").alias("tokens"), F.lit(-1).alias("sign"))
        new = F.struct("source", "lang", "tokens", plus)
        rows = F.filter(F.array(F.when(was, back), F.when((F.col("op") == "insert") | (F.col("op") == "revise") & was, new)), lambda r: r.isNotNull())
        signed = [met.select("doc_id", "version", F.explode(rows).alias("r")).select("doc_id", "r.source", "r.lang", "version", "r.tokens", "r.sign")]
    rows = reduce(DataFrame.unionByName, [*signed, without_id.select(*fields[:-1], plus)])
    rows.write.mode("overwrite").parquet(f"{root}/ledger/batch={batch}")
    delta = parts(spark, root, "ledger", [batch]).groupBy(*GROUP).agg(
        F.sum("sign").cast("long").alias("docs"), F.sum(F.col("sign") * F.col("tokens")).cast("long").alias("tokens")
    )
    delta.write.mode("overwrite").parquet(f"{root}/totals/batch={batch}")
    return True


def totals(spark: SparkSession, root: str) -> DataFrame:
    """source, lang, version, docs and tokens over all committed batches; groups without documents are left out."""
    sums = parts(spark, root, "totals", committed(spark, root))
    if sums is None:
        return spark.createDataFrame([], "source string, lang string, version string, docs long, tokens long")
    return sums.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).filter("docs <> 0 or tokens <> 0")


def copies(docs: DataFrame) -> DataFrame:
    """Deletions of all documents but the first by id among those with equal texts."""
    keyed = docs.select("doc_id", "source", "lang", F.md5(text_or_empty("text").cast("binary")).alias("key"))
    first = keyed.groupBy("key").agg(F.min("doc_id").alias("first"))
    # stored, so that Spark can split the rows of a large group of copies
    return keyed.join(stored(first, "firsts"), "key").filter("doc_id <> first").select(
        F.lit("delete").alias("op"), "doc_id", "source", "lang", F.lit(None).cast("string").alias("text")
    )


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """Revisions of the documents in which a line repeats: later ones are left out."""
    lines = F.split(text_or_empty("text"), "\n")
    once = F.array_distinct(lines)
    return docs.filter(F.size(once) < F.size(lines)).select(
        F.lit("revise").alias("op"), "doc_id", "source", "lang", F.array_join(once, "\n").alias("text")
    )


def corpus_totals(docs: DataFrame, root: str) -> DataFrame:
    """Totals after three batches: all documents, deletions of exact copies, revisions of repeated lines.

    The second batch is sent twice, as after a lost acknowledgement.
    """
    commit(docs.select(F.lit("insert").alias("op"), "doc_id", "source", "lang", "text"), root, 1)
    for _ in range(2):
        commit(copies(docs), root, 2)
    commit(without_repeated_lines(docs), root, 3)
    return totals(docs.sparkSession, root)
