"""From raw documents to token files: language ID, near-dedup, decontamination, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's result to the shared folder and
hands it to the next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitloom.llm import common, decontaminate, langid, mixing, simhash, tokenfiles

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told (no text, or no letter in it) go; lang of the others becomes the language told from
    their text, whatever it was. An empty table, or one without labels, leaves nothing to learn from, and nothing stays."""
    told = langid.identify(docs.select(*COLUMNS), langid.fit(docs)).where(F.col("lang_pred") != langid.UNDETERMINED)
    return told.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays: that of least doc_id (null last), then of least text hash. Rows of one
    doc_id, or of none, are told apart by a row key that is written before anything is joined."""
    rows = common.stash(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")), "corpus-rows")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.xxhash64("text").alias("hash"), "row")
    found = simhash.near_dedup(rows.select(order.alias("doc_id"), "text"))
    kept = found.where(F.col("doc_id.row") == F.col("component_id.row")).select("doc_id.row")
    return rows.join(kept, "row", "left_semi").select(*COLUMNS)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a passage of the benchmark go, whatever other rows share their doc_id. The search carries each row's columns.
    Rows of null text stay; an empty benchmark takes none."""
    items = common.table(spark, sf_dir, "benchmark")
    rows = docs.select(F.struct(*COLUMNS).alias("doc_id"), "text")
    return decontaminate.decontaminate(rows, items).where(~F.col("contaminated")).select("doc_id.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; null is a source of its own, null text has no words."""
    return mixing.emit(mixing.plan_mix(docs.select(*COLUMNS)))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: doc_id, start, n_tokens, ids_crc32 of each document in them. Null doc_ids come first, null
    text has the end id alone, and no documents make no file."""
    files = tokenfiles.write_tokens(docs, common.new_folder(spark, "corpus"), tokenfiles.tokenizer_path())
    return tokenfiles.read_tokens(files).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_copies),
    ("mixing", mix_sources),
    ("token files", write_tokens),
]
#: Language ID, fingerprints and token ids are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stash(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return docs
