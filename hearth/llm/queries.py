"""The operators applied to the driver's tables with their production parameters.

Each query is ``(spark, sf_dir) -> DataFrame`` over the whole intended table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm import bpe, decontam, exactindex, iblt, langid, licenses, linededup, minhash, mixing, negatives, spelling, toxicity, warc
from hearth.llm.common import cut, load
from hearth.session import checkpoint_root


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies on the driver; tasks get its contents by broadcast."""
    import public_tokenizers
    return public_tokenizers.path(name)


def document_paths(docs: DataFrame) -> DataFrame:
    """``documents`` as files of a tree: source / language / hundred of ids; every tenth is a licence file,
    and those of the hundreds lie higher up."""
    d, hundred = F.col("doc_id"), F.floor(F.col("doc_id") / 100).cast("string")
    name = F.when(d % 10 == 0, F.concat(F.lit("LICENSE."), d.cast("string"))).otherwise(F.concat(d.cast("string"), F.lit(".txt")))
    top = F.concat(F.lit("/"), F.col("source"))
    path = (F.when(d % 1000 == 0, F.concat_ws("/", top, name)).when(d % 100 == 0, F.concat_ws("/", top, F.col("lang"), name))
            .otherwise(F.concat_ws("/", top, F.col("lang"), hundred, name)))
    return docs.select(path.alias("path"), "text")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc_id = F.regexp_extract("path", r"([0-9]+)(\.txt)?$", 1).cast("long")
    return (licenses.scan(document_paths(load(spark, sf_dir, "documents")))
            .select(doc_id.alias("doc_id"), F.col("own").alias("own_license"), "score", "license", F.col("source").alias("inherited_from")))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.mix(load(spark, sf_dir, "documents"))
            .select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (langid.identify(load(spark, sf_dir, "pages"), langid.fit(load(spark, sf_dir, "documents")))
            .select(F.col("id").alias("page_id"), "lang", "probability", "text_lang", "declared", "host"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    held = F.coalesce(F.crc32(F.col("id").cast("string")) % 5 == 0, F.lit(False))
    return (toxicity.score(docs, toxicity.fit(docs, labels))
            .select(F.col("id").alias("doc_id"), held.alias("held_out"), "score", "predicted", F.size("spans").alias("n_spans")))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).alias("n_lines"))
    return linededup.dedup_lines(docs).select("doc_id", "n_lines", F.col("__gone").alias("n_removed"),
                                              F.sha2("text", 256).alias("kept_sha256"))


def op6_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (warc.round_trip(load(spark, sf_dir, "pages"))
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op7_iblt_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (iblt.compare_edits(load(spark, sf_dir, "documents"))
            .select(F.col("id").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                    "fingerprint", "edited_fingerprint", "near_edited", "near_next"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that leak a benchmark item, with the item and how much of it is covered."""
    return (decontam.leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
            .select(F.col("id").alias("doc_id"), "item_id", "item_words", "covered", "coverage"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.token_counts(load(spark, sf_dir, "documents"), bpe.read_model(open(tokenizer_path("piece_bpe_32k.model"), "rb").read()))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (minhash.near_duplicates(load(spark, sf_dir, "documents"))
            .select("doc_id", "n_shingles", "component_id", "kept"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(load(spark, sf_dir, "documents"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, handed to a new index in two deliveries: the second one's texts meet those of the first."""
    index = exactindex.open_index(spark, f"{checkpoint_root(spark)}/llm/index-{uuid.uuid4().hex}")
    rows = cut(exactindex.digests(load(spark, sf_dir, "documents")))
    early = F.xxhash64("id") < 0
    exactindex.add(index, rows.filter(early), "first")
    exactindex.add(index, rows.filter(~early), "second")
    return exactindex.decide(index, rows).select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                                                 F.lower(F.hex("digest")).alias("text_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(negatives.usable(load(spark, sf_dir, "embeddings"), label=label), F.col("id") % 100 == 0)


QUERIES = {f.__name__: f for f in (op1_license_scan, op2_mix_sources, op3_language_id, op4_toxicity, op5_line_dedup, op6_warc_round_trip, op7_iblt_fingerprints,
                                 op8_decontaminate, op9_token_counts, op10_minhash_near_dedup, op11_spelling_variants, op12_exact_dedup,
                                 op13_hard_negatives)}
