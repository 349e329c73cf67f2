"""One query per operator over its whole table, and the pipeline."""

from __future__ import annotations

import os
import zlib

import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from llm import chat, decontam, language, mixing, near_dedup, pii, quality, repeats, runs, spelling, token_counts, token_files, toxicity
from llm.oracle import CHAT

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Of a table, a worker and its executor hold a few batches at a time, of 64 MB unless it is set.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "1m"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def workers_find_us(spark):
    """Python workers on this machine import the package from where the driver has it;
    a cluster gets it as any other package, by ``--py-files``. They are sent rows in
    batches of ``BATCH_BYTES``, or as the session says; a longer text is alone in its batch."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join(p for p in (*paths, ROOT) if p)
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)


def table(spark, sf_dir, name):
    workers_find_us(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    taught = labels.where(toxicity.fold("doc_id", 4) != 2)
    scored = toxicity.toxicity(table(spark, sf_dir, "documents"), taught)
    return scored.select("doc_id", (toxicity.fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def op2_decontamination(spark, sf_dir):
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, docs.where(toxicity.fold("doc_id", 3) != 1))
    return found.select("doc_id", (toxicity.fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op4_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_minhash_near_dedup(spark, sf_dir):
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op6_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), TOKENIZER)


def op7_quality_rules(spark, sf_dir):
    found = quality.quality(table(spark, sf_dir, "documents"))
    return found.drop("distance")


def op8_token_files(spark, sf_dir):
    return token_files.token_output(table(spark, sf_dir, "documents"), TOKENIZER)


def op9_preference_format(spark, sf_dir):
    pairs = chat.reply_pairs(chat.conversations(table(spark, sf_dir, "conversations")))
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    found = chat.preferences(pairs)
    return found.withColumns({c: spans(F.col(c)) for c in ("chosen_mask", "rejected_mask")}).withColumn("n_common", F.col("n_common").cast("long"))


def op10_pii(spark, sf_dir):
    return pii.pii_digest(pii.find_pii(table(spark, sf_dir, "documents")))


def with_planted_runs(batches):
    """Texts of which a tenth repeats a part of itself to the end, by the document's id."""
    for batch in batches:
        texts = []
        for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            code = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
            if code % 10 == 0:
                parts = (text or "").encode().split()
                n, g = len(parts), code // 10
                if n:
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    parts = parts[:a] + [parts[a + i % p] for i in range(n - a)]
                text = b" ".join(parts).decode()
            texts.append(text)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, type=pa.string())], names=["doc_id", "text"])


def op11_periodic_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    found = runs.periodic_runs(docs.mapInArrow(with_planted_runs, "doc_id long, text string"))
    return runs.runs_digest(found)


def op12_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), drop_every=97)


def op13_suffix_dedup(spark, sf_dir):
    return repeats.repeats_digest(repeats.remove_repeats(table(spark, sf_dir, "documents")))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_decontamination,
        op3_language,
        op4_mixing,
        op5_minhash_near_dedup,
        op6_token_counts,
        op7_quality_rules,
        op8_token_files,
        op9_preference_format,
        op10_pii,
        op11_periodic_runs,
        op12_spelling_variants,
        op13_suffix_dedup,
        pipeline,
    )
}
ORACLE: dict[str, str] = {"op9_preference_format": CHAT}
