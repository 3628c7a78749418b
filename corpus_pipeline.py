"""A training-corpus pipeline of the corpus operators, one stage after another.

Every stage takes the whole of what the stage before it kept. All but the last
return the columns of their input; the last returns packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import checkpointed, read_table
from strata.llm.language_id import identify, learn
from strata.llm.minhash import near_duplicates
from strata.llm.mixing import mix_sources
from strata.llm.packing import harmonic_pack
from strata.llm.queries import MIXTURE
from strata.llm.suffix_dedup import remove_repeats

#: A document stays if one language holds at least this share of it.
LEAST_SHARE = 0.5


def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The table under names of its own, so that no column can clash with an operator's."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters and those in which no language holds half.

    Null and empty texts go (they have no language); null languages, sources and
    ids stay; repeated rows are judged alike and stay. The text of any length is
    judged whole. An empty table stays empty.
    """
    plain, names = _plain(docs)
    model = learn(plain, names["doc_id"], names["text"], names["lang"])
    judged = identify(plain, model, list(names.values()), names["text"])
    stay = (F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE)
    return judged.filter(stay).select(*names.values()).toDF(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of every group of near copies; rows without an id stay.

    Rows of one id are one document with several texts: all its texts stay or go
    together, and of rows that repeat id and text one stays, the first by the
    values of the other columns. Null and empty texts are in no group and stay.
    """
    plain, names = _plain(docs)
    key, text = names["doc_id"], names["text"]
    kept = near_duplicates(plain, id_col=key, text_col=text).filter("kept").select(F.col("doc_id").alias(key)).distinct()
    own = plain.join(kept, key, "left_semi")
    others = [c for c in plain.columns if c not in (key, text)]
    if not others:
        return own.distinct().union(plain.filter(F.col(key).isNull())).toDF(*docs.columns)
    once = own.groupBy(key, text).agg(F.min(F.struct(*others)).alias("__first")).select(
        *[F.col(c) if c in (key, text) else F.col(f"__first.{c}").alias(c) for c in plain.columns]
    )
    return once.union(plain.filter(F.col(key).isNull())).toDF(*docs.columns)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 50 bytes that an earlier document has; drop what is empty thereafter.

    Null texts stay null, empty ones empty; rows without an id are passed by.
    Texts under one id do not count as earlier than each other. ``n_chars`` follows
    the text where it was cut.
    """
    plain, names = _plain(docs)
    plain = plain.withColumn("void", F.col(names["text"]).isNull())
    keep = [c for c in plain.columns if c not in (names["doc_id"], names["text"])]
    cut = remove_repeats(plain, keep=keep, with_text=True, id_col=names["doc_id"], text_col=names["text"])
    cut = cut.filter((F.col("n_removed") == 0) | (F.length("kept_text") > 0))
    text = F.when(F.col("void"), F.lit(None)).otherwise(F.col("kept_text"))
    value = {"doc_id": F.col("doc_id"), "text": text}
    if "n_chars" in names:
        value["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col(names["n_chars"])).cast(docs.schema["n_chars"].dataType)
    return cut.select(*[value.get(c, F.col(names[c])).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, in the order of the target mixture; nulls and repeated rows included, none dropped.

    A table written and read again may lose that order, so ``pack`` works the
    same places out again, from the same weights and rows.
    """
    plain, names = _plain(docs)
    mixed = mix_sources(plain, MIXTURE, id_col=names["doc_id"], source_col=names["source"], text_col=names["text"])
    return mixed.orderBy("mix_slot", "mix_start").select(*names.values()).toDF(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 4096 tokens in the order of the target mixture, a row for each piece.

    Null and empty texts are their end token alone; rows of one id are packed each.
    Other columns come along under their own names.
    """
    plain, names = _plain(docs)
    return harmonic_pack(
        plain, public_tokenizers.path("word_bpe_49k.json"), end_id=2, capacity=4096, weights=MIXTURE, added_as_text=False,
        id_col=names["doc_id"], text_col=names["text"], source_col=names["source"],
    )


STAGES = [("language_id", language), ("near_dedup", near_dedup), ("remove_repeats", repeats), ("mix_sources", mix), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = checkpointed(docs)
    return docs


#: The stages use hashes and models that SQL cannot repeat; the tests compare with brute force.
ORACLE_SQL = None
