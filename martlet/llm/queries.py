"""The registered queries of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm import chat, pu_quality
from martlet.llm.bpe import encode_documents
from martlet.llm.centroids import cluster_vectors, whole
from martlet.llm.common import table
from martlet.llm.hard_negatives import mine
from martlet.llm.language import fit, identify
from martlet.llm.mixing import mix
from martlet.llm.pii import KINDS, base_spans, find, listing
from martlet.llm.quality_rules import judge
from martlet.llm.shingle_join import near_duplicates
from martlet.llm.sharding import shard_documents
from martlet.llm.vector_dedup import link_vectors
from martlet.llm.warc import audit, damaged, leaves, tree, write_records

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def held_out(kept: int, of: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == kept


def op1_positive_unlabelled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from four fifths of the labels."""
    docs = table(spark, sf_dir, "documents")
    model = pu_quality.fit(
        docs.filter(~held_out(0, 5)), table(spark, sf_dir, "labels").filter(~held_out(0, 5))
    )
    out = F.coalesce(held_out(0, 5), F.lit(False))
    return pu_quality.score(docs, model).select(
        "doc_id", out.alias("held_out"), "score", "predicted"
    )


def op2_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of eight shards of near equal bytes."""
    return shard_documents(table(spark, sf_dir, "documents"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts of the base kinds and all spans."""
    found = find(table(spark, sf_dir, "documents")).withColumn("base", base_spans(F.col("spans")))

    def count(place: int):
        return F.size(F.filter("base", lambda s: s["kind"] == place)).cast("long")

    counts = [count(i).alias(f"n_{k.name}") for i, k in enumerate(KINDS) if k.base]
    return found.select(
        "doc.doc_id", *counts,
        F.sha2(listing(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listing(F.col("spans")).alias("spans"),
        F.transform("spans", lambda s: F.round(s["score"], 2)).alias("scores"),
    )


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by a public vocabulary, and decoded again."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = public_tokenizers.path(VOCABULARY)
    return encode_documents(docs, vocabulary, public_tokenizers.PATTERN).select(
        "doc.doc_id", "n_tokens", "ids_sha256", "decoded_sha256"
    )


def op5_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as WARC records, and the records in which a damaged replica differs."""
    records = write_records(table(spark, sf_dir, "pages"))
    return audit(tree(leaves(records)), tree(leaves(damaged(records))))


def op6_fair_queue_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    return mix(table(spark, sf_dir, "documents"), ["doc_id"]).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op7_projection_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return link_vectors(table(spark, sf_dir, "embeddings"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op9_byte_recurrent_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from two thirds of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    out = F.coalesce(held_out(1, 3), F.lit(False))
    net = fit(docs.filter(~held_out(1, 3)))
    return identify(docs, net).select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op10_likelihood_ratio_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts and verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    judged = judge(docs, table(spark, sf_dir, "labels"))
    return judged.select("doc.doc_id", *judged.columns[1:])


def op11_event_sourced_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation folded from its log and formatted, and what can be read back."""
    columns = ["conv_id", "turn", "role", "text"]
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    logged = table(spark, sf_dir, "conversations").select(*columns).unionByName(probe)
    back = chat.read_back(chat.format_conversations(logged))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join("learned", "")
    return back.select(
        F.col("conversation").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op12_coordinate_pruned_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    finite = F.forall("embedding", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(
        vectors.filter(finite).select(
            F.col("vec_id").alias("id"), moved.alias("label"), whole("embedding", 256).alias("vector")
        ),
        anchors=F.col("id") % 100 == 0,
    )


def op13_heap_ordered_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after ten rounds."""
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_positive_unlabelled_quality, op2_sampled_splitters, op3_personal_data, op4_byte_bpe, op5_merkle_audit, op6_fair_queue_mix,
    op7_projection_passes, op8_jaccard_join, op9_byte_recurrent_network,
    op10_likelihood_ratio_rules, op11_event_sourced_chat, op12_coordinate_pruned_negatives,
    op13_heap_ordered_bounds,
)}
