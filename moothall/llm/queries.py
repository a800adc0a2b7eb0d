"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moothall.llm import decontaminate, infill, licenses, secrets
from moothall.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every text by the public rank file, decode the ids, and return digests of both."""
    import public_tokenizers as tokenizers

    from moothall.llm import bpe

    vocabulary, pattern = tokenizers.path("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").withColumn("made", bpe.round_trip(F.col("text"), vocabulary, pattern))
    return docs.select(
        "doc_id",
        (F.octet_length("made.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("made.ids", 256).alias("ids_sha256"),
        F.sha2("made.decoded", 256).alias("decoded_sha256"),
    )


def op6_jpeg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store every text as baseline JPEG, read the stored bytes back, and return digests and features."""
    from moothall.llm import jpeg

    docs = table(spark, sf_dir, "documents").withColumn("media", jpeg.text_as_images(F.col("text")))
    docs = docs.withColumn("read", jpeg.image_features(F.col("media")))
    payload = F.col("read.payload")
    return docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_sha256"),
        F.crc32(F.substring(payload, -32, 32)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.col("read.feature").alias("feature"),
    )


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Render every conversation and return digests of its turns and of its loss mask, read back from the output.

    Conversation -1 is added: a user and an assistant turn whose texts are made of control strings."""
    from moothall.llm import chat

    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    return chat.conversation_digests(chat.format_turns(rows.unionByName(probe), lookback=chat.LOOKBACK))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text, by a model of the texts and languages of the rows that aren't held out."""
    from moothall.llm import langid

    docs = langid.identified(table(spark, sf_dir, "documents"))
    return docs.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    from moothall.llm import minhash

    return minhash.near_duplicate_classes(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality and toxicity of every document; its source is its host, and a language of a source is a path."""
    from moothall.llm import quality

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.scored(docs, labels, F.col("source"), F.col("lang"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in every document."""
    return licenses.license_report(table(spark, sf_dir, "documents"))


def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that documents share, word for word or nearly."""
    from moothall.llm import passages

    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document lie in benchmark windows, and whose they are."""
    return decontaminate.leak_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets in every document."""
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The personal data in every document."""
    from moothall.llm import pii

    return pii.personal_report(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents that is frequent enough, and the more frequent word that it may be a misspelling of."""
    from moothall.llm import variants

    return variants.variant_report(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its middle moved to the end, and restored from that."""
    return infill.fim_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_chat_format": op1_chat_format,
    "op2_language_id": op2_language_id,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_quality": op4_quality,
    "op5_license_scan": op5_license_scan,
    "op6_jpeg_media": op6_jpeg_media,
    "op7_repeated_passages": op7_repeated_passages,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_decontaminate": op9_decontaminate,
    "op10_secret_scan": op10_secret_scan,
    "op11_personal_data": op11_personal_data,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_fill_in_middle": op13_fill_in_middle,
}
ORACLE_SQL: dict[str, str] = {
    "op5_license_scan": licenses.ORACLE,
    "op9_decontaminate": decontaminate.ORACLE,
    "op10_secret_scan": secrets.ORACLE,
    "op13_fill_in_middle": infill.ORACLE,
}
