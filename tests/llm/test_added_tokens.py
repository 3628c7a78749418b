"""Strings of added tokens in texts are encoded as the tokenizer file has them."""

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from strata.llm import packing, queries

VOCAB = public_tokenizers.path("word_bpe_49k.json")


def test_added_tokens_keep_their_ids(spark, docs):
    texts = [
        "page <|endoftext|> next", "a<|startoftext|>b", "<|ENDOFTEXT|> is not one", "page < |endoftext|> plain words", "é <|endoftext|> ü",
        "<|endoftext|>", "page next", "日本 <|endoftext|>", "<|endof text|> <|endoftext|><|endoftext|>",
    ]
    tok = Tokenizer.from_file(VOCAB)
    want = {i: [*tok.encode(t, add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    assert 49407 in want[0] and 49407 not in want[2]
    rows = packing.harmonic_pack(docs([(i, t, "en", "a") for i, t in enumerate(texts)]), VOCAB, with_ids=True, added_as_text=False).collect()
    got = {i: np.concatenate([np.frombuffer(r.ids, "<u4") for r in sorted(rows, key=lambda r: r.start) if r.doc_id == i]).tolist() for i in want}
    assert got == want and all(r.doc_tokens == len(want[r.doc_id]) for r in rows)


def test_query_and_pipeline_pack_by_the_file(spark, docs, tmp_path):
    table = docs([(0, "page <|endoftext|> next", "en", "a")])
    table.write.parquet(str(tmp_path / "documents.parquet"))
    n = len(Tokenizer.from_file(VOCAB).encode("page <|endoftext|> next", add_special_tokens=False).ids) + 1
    assert [r.doc_tokens for r in queries.op3_pack(spark, str(tmp_path)).collect()] == [n]
    assert [r.doc_tokens for r in corpus_pipeline.pack(spark, table, "").collect()] == [n]
