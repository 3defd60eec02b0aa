"""The dealt operators as queries over one folder of tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesmill.llm import langid, lm, toxicity
from salesmill.llm.alignment import aligned_documents
from salesmill.llm.decontaminate import find_contamination
from salesmill.llm.html import extract
from salesmill.llm.jaccard import similar_documents
from salesmill.llm.packing import matrix_digest, pack_evenly, pack_matrix
from salesmill.llm.pii import find_personal_data
from salesmill.llm.sharding import slots
from salesmill.llm.shipping import ship
from salesmill.llm.syncmers import fingerprints
from salesmill.llm.trie import prefix_trie, turn_paths, with_lent_beginnings
from salesmill.session import written

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, base: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{base}/{name}.parquet")


def crc_mod(column: str, modulus: int):
    """crc32 of a number written as text, modulo `modulus`."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus))


def op1_html_text(spark, base):
    return extract(_table(spark, base, "pages"))


def op2_syncmers(spark, base):
    return fingerprints(_table(spark, base, "documents"))


def op3_toxicity(spark, base):
    docs = _table(spark, base, "documents")
    labels = _table(spark, base, "labels").select("doc_id", F.col("toxic").alias("grade"))  # two grades: one threshold
    return toxicity.predict(docs, toxicity.fit(docs, labels)).select("doc_id", "severity", "toxic")


def op4_language_id(spark, base):
    docs = _table(spark, base, "documents")
    held_out = crc_mod("doc_id", 4) == 2
    model = langid.fit(docs.select("doc_id", "text", "lang").where(~held_out))
    return langid.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_personal_data(spark, base):
    return find_personal_data(_table(spark, base, "documents"))


def op6_decontaminate(spark, base):
    found = find_contamination(_table(spark, base, "documents"), _table(spark, base, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op7_jaccard_join(spark, base):
    return similar_documents(_table(spark, base, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_lm_score(spark, base):
    docs = _table(spark, base, "documents")
    held_out = crc_mod("doc_id", 7) == 2
    model, counts = lm.fit(docs.where(~held_out))
    return lm.score(docs, model, counts).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op9_pack_matrix(spark, base):
    return matrix_digest(pack_matrix(_table(spark, base, "documents")))


def op10_pack_evenly(spark, base):
    return pack_evenly(_table(spark, base, "documents"))


def op11_rendezvous_shards(spark, base):
    return slots(_table(spark, base, "documents"))


def op12_token_alignment(spark, base):
    return aligned_documents(_table(spark, base, "documents"))


def op13_prefix_trie(spark, base):
    paths = written(turn_paths(_table(spark, base, "conversations")), "turn-paths")
    return prefix_trie(with_lent_beginnings(paths))


def build_queries() -> dict[str, Query]:
    import corpus_pipeline

    own = {name: query for name, query in globals().items() if name.startswith("op")}
    return own | {"pipeline": corpus_pipeline.run}


def oracle_queries() -> dict[str, str]:
    from salesmill.llm.oracle import ORACLE

    return dict(ORACLE)
