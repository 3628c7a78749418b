"""Registered corpus queries: oracles at sf0.01, and the pipeline against its parts."""

import random

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from check_oracles import compare
from strata.llm import queries

SF = "/root/testdata/sf0.01"


def test_one_query_per_operator():
    names = [n.split("_")[0] for n in queries.queries()]
    assert sorted(names, key=lambda n: int(n[2:])) == [f"op{i}" for i in range(1, 14)]
    assert {"pipeline", *queries.queries()} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_oracle(spark, name):
    result = compare(spark, SF, [name])[name]
    assert result.startswith("ok"), result


def test_pipeline_keeps_clean_documents_and_drops_the_rest(spark, docs):
    rng = random.Random(11)
    syl = {"aa": ["ba", "bo", "bi", "ta", "ru"], "bb": ["zu", "xi", "ka", "mu", "ve"]}

    def text(lang, n):
        return " ".join("".join(rng.choices(syl[lang], k=rng.randint(2, 5))) for _ in range(n))

    rows = [(i, text(lang, 80), lang, rng.choice(["src0", "src1", "z"])) for i in range(120) for lang in [rng.choice(["aa", "bb"])]]
    passage = text("aa", 60)
    rows += [(500, passage + " " + text("aa", 50), "aa", "src0"), (501, text("aa", 50) + " " + passage, "aa", "src1")]
    rows += [(600, rows[0][1], rows[0][2], "z"), (601, rows[0][1] + " more", rows[0][2], "z"), (602, None, None, None), (603, "123 !!", "aa", "z")]
    table = docs(rows).drop("component_id")
    out, seen = table, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == table.columns
        seen[name] = out.collect()
    ids = lambda name: sorted(r.doc_id for r in seen[name])
    assert ids("language_id") == [i for i, t, *_ in sorted(rows) if t and i != 603]
    assert ids("near_dedup") == [i for i in ids("language_id") if i not in (600, 601)]
    assert ids("remove_repeats") == ids("mix_sources") == ids("near_dedup")
    cut = {r.doc_id: r for r in seen["remove_repeats"]}
    assert passage not in cut[501].text and passage in cut[500].text and cut[501].n_chars == len(cut[501].text)
    assert {r.doc_id for r in seen["pack"]} == set(ids("mix_sources"))


def test_pipeline_on_an_empty_table(spark, docs):
    out = docs([(1, "t", "aa", "z")]).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, SF)
    assert out.count() == 0
