"""From raw documents to packed token sequences, stage by stage.

Each stage works on all that its predecessor kept and returns the columns of documents;
the last returns the pieces of packed sequences. Stages take ``(spark, docs, sf_dir)``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.llm import crf, kneser_ney, minhash, packing, suffix_dedup
from recspark.llm.queries import table, vocabulary_path
from recspark.llm.stages import cut, let_go, plain, small_side
from recspark.session import checkpoint_dir


def _new(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have, whatever the case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _without(docs: DataFrame, gone: DataFrame, on: str) -> DataFrame:
    """Rows whose key ``on`` is not among the distinct, non-null keys of ``gone``; a null key stays."""
    gone = cut(gone.where(plain(on).isNotNull()).distinct())
    return docs.join(small_side(gone, gone.count(), 16), on, "left_anti").select(*map(plain, docs.columns))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts that are null, have no letter, or are in no learned language.

    The latter are those of whose words too few are in training texts (``crf.identify``). The
    model learns from the documents' own ``lang``, but for the held-out quarter. If no
    row has a language nothing can be learnt and no row but those without letters goes.
    Repeated rows and null ids are judged like any other.
    """
    model = crf.fit(docs.where(~crf.held_out(F.col("doc_id"))))
    judged = crf.identify(docs.select(*(plain(c).alias(f"c{i}") for i, c in enumerate(docs.columns)), plain("text").alias(_new(docs, "text_in"))),
                          model, [f"c{i}" for i in range(len(docs.columns))], text_col=_new(docs, "text_in"))
    if model.labels:
        judged = judged.where((F.col("lang_pred") != "und") & ~F.col("strange"))
    else:
        judged = judged.where(F.coalesce(plain(f"c{docs.columns.index('text')}").rlike(r"\p{L}"), F.lit(False)))
    return judged.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts whose perplexity is outside their language's range of trusted texts, and blank ones."""
    key = _new(docs, "row_key")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text", "lang"))
    judged = kneser_ney.classify(keyed, table(spark, sf_dir, "labels"), keep=[key])
    return _without(keyed, judged.where("not kept").select(plain(key)), key).select(*map(plain, docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: the one of the smallest id.

    Rows that share an id are one document, of which the row of the least text hash
    stays. Rows of null id are kept.
    """
    found = minhash.near_duplicates(docs, percent=80)
    kept = _without(docs, found.where("not kept").select("doc_id"), "doc_id")
    twice = cut(docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 and doc_id is not null").select("doc_id"))
    side = small_side(twice, twice.count(), 16)
    once = kept.join(side, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(F.struct(*map(plain, docs.columns)), F.xxhash64("text", "lang", "source")).alias("row"))
    return kept.join(side, "doc_id", "left_anti").select(*map(plain, docs.columns)).union(once.select("row.*"))


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that a document of smaller id holds out of the texts, in whole characters.

    No row goes; a null text stays null, ``n_chars`` becomes the length of what is left.
    """
    absent = _new(docs, "text_absent")
    rest = [c for c in docs.columns if c != "text"]
    out = suffix_dedup.remove_repeats(docs.withColumn(absent, plain("text").isNull()).select(*(plain(c).alias(f"c{i}") for i, c in enumerate([*rest, absent])), plain("doc_id").alias("doc_id"), plain("text").alias("text")),
                                      [f"c{i}" for i in range(len(rest) + 1)], characters=True)
    text = F.when(~F.col(f"c{len(rest)}"), F.col("kept").cast("string"))
    value = {c: F.col(f"c{i}") for i, c in enumerate(rest)} | {"text": text}
    if "n_chars" in value:
        value["n_chars"] = F.coalesce(F.length(text), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    return out.select(*(value[c].alias(c) for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of all texts that are left, each window in the sources' proportions."""
    return packing.pack(docs, vocabulary_path())


STAGES = [("language_id", language_id), ("quality", quality), ("near_dedup", near_dedup), ("suffix_dedup", suffix_stage), ("packing", pack)]

#: SQL can express neither the trained models nor the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``; each one's result is written and read again.

    A stage's input is deleted once its output is written; the last output stays.
    """
    docs = table(spark, sf_dir, "documents")
    folder, before = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}", None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            old = spark._jvm.org.apache.hadoop.fs.Path(before)
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
        before = path
        let_go(spark)
    return docs
