"""A corpus pipeline of five stages over ``documents``: language ID, near-dedup, secret scan, mixing, tokenization.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes what each returns and reads it back for
the next.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import language_id, mixing, near_copies, secret_scan, sentencepieces
from ledgerline.llm.common import cut, own_name

#: Documents whose best language has a smaller posterior go.
LEAST_SCORE = 0.5
#: Bytes of units that a worker remembers in the last stage; its memory has served the other stages before.
MEMO_BYTES = 48 << 20


def _row_hash(docs: DataFrame):
    """A hash of all columns: rows that share it are the same row."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in docs.columns])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: null, no letter, or no language clearly best.  Trained on all labelled rows.

    Null labels train nothing; without any label every text with a letter stays.  Equal code lengths give a score of at
    most a half, which two languages make the least that stays.  Long texts are read whole, repeated rows are judged
    alike, an empty table stays empty, and all columns pass through.
    """
    texts = language_id.sample_texts(docs.select("text", "lang"))
    if not texts:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    prefix = own_name(docs, "id_")
    told = language_id.identify(docs, language_id.train(texts), prefix)
    return told.where((F.col(f"{prefix}lang_pred") != "und") & (F.col(f"{prefix}score") >= LEAST_SCORE)).select(*docs.columns)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies (five-word shingles, Jaccard similarity 0.8 or more): that of the
    smallest id, null last, then of the smallest hash of the row; of rows repeated as a whole one.

    Texts without a word, null ones too, are one class.  Texts of any length count whole, an empty table stays empty, and
    all columns pass through.
    """
    id_, row, own_row, m = (own_name(docs, c) for c in ("d_", "r_", "h_", "m_"))
    keyed = near_copies.with_keys(docs.select(F.col("doc_id").alias("id"), _row_hash(docs).alias("r"), "text"), "k")
    rows = cut(keyed.select("id", "r", F.xxhash64("text").alias("h"), "k.node", "k.n", "k.fp", "k.keys"), "keys")
    rooted = rows.select("id", "r", "node").join(near_copies.roots(rows, docs), "node", "left").withColumn("root", F.coalesce("root", "node"))
    kept = rooted.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("n"), "id", "r")).alias("k")).select(F.col("k.id").alias(id_), F.col("k.r").alias(row))
    # How often the row that stays is repeated as a whole.
    often = rows.groupBy("id", "r").agg(F.count("*").alias(m))
    kept = cut(kept.join(often, F.col(id_).eqNullSafe(F.col("id")) & (F.col(row) == F.col("r"))).select(id_, row, m), "kept")
    hit = docs.withColumn(own_row, _row_hash(docs)).join(kept, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(own_row) == F.col(row)))
    once, many = hit.where(F.col(m) == 1), hit.where(F.col(m) > 1).dropDuplicates([id_, row])
    return once.union(many).select(*docs.columns)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in a text by a mark; no document goes.

    Null and empty texts stay as they are; spans that overlap become one mark; texts of any length are searched whole,
    repeated rows are treated alike, an empty table stays empty, and all other columns pass through.
    """
    return secret_scan.masked(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the mix does: none, once, or in several epochs.

    Null sources are one source, null and blank texts are never taken.  Equal keys fall back on the identifier and the
    hash of the row; rows repeated as a whole share what the mix takes of them.  An empty table stays empty, and all
    columns pass through.
    """
    names = {c: own_name(docs, c + "_") for c in ("h", "size", "d", "t", "n", "m", "c")}
    h, size, d, t, n, m, c = names.values()
    own = docs.withColumns({h: _row_hash(docs), size: mixing.word_count()})
    taken = mixing.mix(own.select("source", "doc_id", F.col(h).alias("h"), F.col(size).alias("size")))
    # Repeated rows are one group: its rows in the table, its copies in the mix.
    total = cut(taken.groupBy(F.col("doc_id").alias(d), F.col("h").alias(t)).agg(F.sum("copies").alias(n), F.count("*").alias(m)).where(F.col(n) > 0), "taken")
    hit = own.join(total, own["doc_id"].eqNullSafe(F.col(d)) & (F.col(h) == F.col(t)))
    once, many = hit.where(F.col(m) == 1), hit.where(F.col(m) > 1).dropDuplicates([d, t])
    return once.union(many).withColumn(c, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n)))).select(*docs.columns)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids_crc32, round_trip of every document taken, one row a copy.

    A null or empty text has no ids; texts of any length are encoded whole.  Other columns play no part.
    """
    out = sentencepieces.with_pieces(docs.select("doc_id", "source", "text"), public_tokenizers.path("piece_bpe_32k.model"), "p", memo_bytes=MEMO_BYTES)
    return out.select("doc_id", "source", F.col("p.n").alias("n_tokens"), F.col("p.crc").alias("ids_crc32"), F.col("p.back").alias("round_trip"))


STAGES = [
    ("language_id", language_stage),
    ("simhash_dedup", dedup_stage),
    ("secret_scan", secrets_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", tokens_stage),
]

#: Hashes, learned models and tokenizers are beyond SQL; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
