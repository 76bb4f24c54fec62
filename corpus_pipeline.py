"""The corpus pipeline: language, near duplicates, decontamination, mixture, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which `run`
writes and reads again before the next one. All but the last return the columns
of documents. Nulls, empty and repeated rows are as the operators define them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugework.llm import decontaminate, language, mixture, neardup, tokens
from gaugework.llm.common import fresh_names, importable, work_dir
from gaugework.llm.queries import learnable, tokenizer_path
from gaugework.session import scratch

#: Posterior below which a document has no clear language.
LEAST_SCORE = 0.5


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without a letter, or of no clear language, go."""
    importable(spark)
    model = language.train(docs.where(learnable()), tokenizer_path("piece_bpe_32k.model"))
    lang, score = fresh_names(docs, "lang", "score")
    found = language.predict(docs, model, lang_out=lang, score_out=score)
    return found.where((F.col(lang) != language.UND) & (F.col(score) >= LEAST_SCORE)).select(*_columns(docs))


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of exact and near copies."""
    importable(spark)
    kept = neardup.near_duplicates(docs).where("kept").select("doc_id", "node").distinct()
    # Ids and digests under names that docs does not have; rows that repeat id and text meet in the partition where the join has put them.
    names = fresh_names(docs, "id", "none", "node")
    key = lambda node: [e.alias(n) for e, n in zip((F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), F.col("doc_id").isNull(), node), names)]
    keyed = docs.select("*", *key(F.unhex(F.md5(F.col("text").cast("binary")))))
    chosen = keyed.join(kept.select(*key(F.col("node"))), names, "left_semi")
    texts = chosen.where(F.col(names[2]).isNotNull()).dropDuplicates(names)
    return texts.select(*_columns(docs)).unionByName(docs.where("text IS NULL").dropDuplicates(["doc_id"]))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any occurrence of a benchmark window."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    i, k = fresh_names(docs, "id", "key")
    hit = decontaminate.decontaminate(docs, items).where("contaminated").select(F.col("doc_id").alias(i), F.col("text_key").alias(k)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(i)) & (F.xxhash64(F.col("text").cast("string")) == F.col(k))
    return docs.join(hit, same, "left_anti")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture to target weights, a row for each epoch that takes a document."""
    # Columns named like an output of the operator step aside.
    clash = [c for c in docs.columns if c.lower() in ("n_tokens", "epoch")]
    aside = dict(zip(clash, fresh_names(docs, *clash)))
    out = mixture.mix(docs.withColumnsRenamed(aside), mixture.corpus_path(), mixture.corpus_weights(), mixture.corpus_budget())
    return out.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the token store, read back: place, length and checksum of their ids."""
    importable(spark)
    folder = work_dir(spark, "pipeline-tokens")
    tokens.write_store(docs, folder, tokenizer_path("byte_bpe_50k.json"))
    return tokens.read_store(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


STAGES = [
    ("language", identify),
    ("near_duplicates", deduplicate),
    ("decontamination", decontaminated),
    ("mixture", mixed),
    ("tokens", tokenized),
]

#: Signatures, trained models and tokenizers have no SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; what a stage writes besides its result is deleted after it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_dir(spark, name)
        with scratch(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
