"""Texts of several MB, columns with clashing names and rows of one id through the operators on documents."""

import random
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm.language_id import language_id
from strata.llm.minhash import near_duplicates
from strata.llm.mixing import mix_sources
from strata.llm.packing import harmonic_pack
from strata.llm.phrases import mine_phrases
from strata.llm.sharding import shard_rows
from strata.llm.suffix_dedup import remove_repeats

SYLLABLES = {"aa": ["ba", "bo", "bi", "ta", "ru"], "bb": ["zu", "xi", "ka", "mu", "ve"]}


def prose(seed, lang, words):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(2, 6))) for _ in range(words))


@pytest.fixture(scope="module")
def long_text():
    return prose(1, "aa", 300_000)  # 2.8 MB


@pytest.fixture()
def table(docs, long_text):
    rows = [(i, prose(i + 10, lang, 60), lang, "src0") for i, lang in enumerate(["aa", "bb"] * 6)]
    return docs([*rows, (50, long_text, "aa", "src1"), (51, long_text + " tail", "aa", "z"), (52, None, None, None)])


def test_sizes_and_checksums_of_whole_texts(table, long_text):
    shards = {r.doc_id: r for r in shard_rows(table, shards=2).collect()}
    assert (shards[50].size, shards[50].text_crc32) == (len(long_text) + 1, zlib.crc32(long_text.encode()))
    mixed = {r.doc_id: r for r in mix_sources(table, {"src0": 1, "*": 2}).collect()}
    assert mixed[50].mix_size == len(long_text) + 1 and len(mixed) == 15


def test_near_copies_and_repeats_of_whole_texts(table, long_text):
    same = {r.doc_id: r.component_id for r in near_duplicates(table).collect()}
    assert same[51] == same[50] == 50 and sorted(k for k, v in same.items() if k != v) == [51]
    cut = {r.doc_id: r for r in remove_repeats(table).collect()}
    assert cut[50].n_removed == 0 and cut[51].n_removed == len(long_text) and cut[51].n_bytes == len(long_text) + 5


def test_languages_tokens_and_phrases_of_whole_texts(table, long_text):
    judged = {r.doc_id: r.lang_pred for r in language_id(table).collect()}
    assert judged[50] == judged[51] == "aa" and judged[52] == "und"
    packed = harmonic_pack(table, public_tokenizers.path("word_bpe_49k.json"), end_id=2, capacity=4096)
    sizes = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all"), F.count(F.lit(1)).alias("pieces"))
    by_id = {r.doc_id: r for r in sizes.collect()}
    assert by_id[50].n == by_id[50]["all"] > 300_000 and by_id[50].pieces > 70 and by_id[52].n == 1
    words = mine_phrases(table.filter("doc_id >= 50"), chunk_bytes=100_000).filter("lang = 'aa'").first()
    assert words.n == 2 * 300_000 + 1


def test_only_clashing_columns_are_replaced(docs):
    table = docs([(1, "one text", "aa", "src0"), (2, "two", "aa", "z")]).withColumns(
        {"mix_note": F.lit("mine"), "__own": F.lit(3), "Mix_Slot": F.lit(-1), "mix_id": F.lit("kept"), "mix_unit": F.lit(9)}
    )
    out = mix_sources(table, {"src0": 1}).collect()
    assert all((r.mix_note, r["__own"], r.mix_id, r.mix_unit) == ("mine", 3, "kept", 9) and r.mix_slot >= 0 for r in out)
    packed = harmonic_pack(table, public_tokenizers.path("word_bpe_49k.json"), end_id=2, capacity=64, weights={"src0": 1})
    assert {r.doc_id for r in packed.collect()} == {1, 2}


def test_rows_of_one_id_are_dealt_apart(docs):
    rows = [(7, f"text {i}", "aa", "src0") for i in range(400)] + [(None, f"other {i}", "aa", "src0") for i in range(200)]
    table = docs(rows)
    places = shard_rows(table, shards=3).select("shard", "slot").collect()
    assert len({tuple(p) for p in places}) == 600 and max(p.slot for p in places) == 199
    starts = sorted((r.mix_start, r.mix_size) for r in mix_sources(table, {"src0": 1}).collect())
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


def test_near_dedup_keeps_all_texts_of_an_id(spark, docs):
    texts = [prose(k, "aa", 40) for k in range(3)]
    table = docs([(1, texts[0], "aa", "src0"), (1, texts[1], "aa", "src1"), (1, texts[0], "aa", "src9"), (2, texts[2], "bb", "z"),
                  (3, texts[2] + " more", "bb", "z"), (None, texts[2], "bb", "z"), (4, None, None, None), (5, "", None, None)])
    out = corpus_pipeline.near_dedup(spark, table, "")
    assert out.columns == table.columns
    got = sorted(((r.doc_id, r.text, r.source) for r in out.collect()), key=str)
    assert got == sorted([(1, texts[0], "src0"), (1, texts[1], "src1"), (2, texts[2], "z"), (None, texts[2], "z"), (4, None, None), (5, "", None)], key=str)
