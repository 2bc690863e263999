"""The pipeline's stages one by one, and as a whole."""

from collections import Counter

import pytest

import corpus_pipeline
from rollcall.llm import exact, langid, queries, rules, simhash
from tests.llm.data import SCHEMA, documents, given, nothing

STAGES = dict(corpus_pipeline.STAGES)


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", list(STAGES))
def test_stage_bears_odd_cases(spark, tmp_path, name):
    docs = documents(spark)
    out = STAGES[name](spark, docs, str(tmp_path))
    if name != "best-fit packing":
        assert out.columns == docs.columns
        assert not bag(out) - bag(docs)
    else:
        assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()}
    assert STAGES[name](spark, nothing(spark), str(tmp_path)).collect() == []


def test_stages_decide_like_their_operators(spark, tmp_path):
    docs = documents(spark)

    def kept(name):
        return Counter(r.doc_id for r in STAGES[name](spark, docs, str(tmp_path)).collect())

    assert kept("quality rules") == Counter(r.id for r in rules.ledger(docs).where(~rules.rejected("2")).collect())
    assert kept("language ID") == Counter(r.id for r in langid.identify(docs).where("NOT rejected").collect())
    assert kept("exact dedup") == Counter(r.id for r in exact.exact_duplicates(docs).where("kept").collect())
    assert kept("SimHash near-dedup") == Counter(
        r.id for r in simhash.near_duplicates(docs).where("kept").collect()
    )


def test_language_stage_with_models_in_tables(spark, tmp_path, monkeypatch):
    """Rows stay as they do where tasks hold all triples."""
    docs = documents(spark)
    wanted = bag(STAGES["language ID"](spark, docs, str(tmp_path)))
    monkeypatch.setattr(langid, "MODEL_GRAMS", 20)
    assert wanted and bag(STAGES["language ID"](spark, docs, str(tmp_path))) == wanted


@pytest.mark.parametrize("chosen", ["false", "n = 1", "true"])
def test_language_stage_whichever_triples_tasks_hold(spark, monkeypatch, chosen):
    """What `frequent` leaves out is found in tables: it decides nothing, be it that it
    chooses no triple, only the rarest or all of them."""
    docs = documents(spark)

    def told():
        rows = langid.identify(docs, carry=True).select("doc", "lang_pred", "rejected", "entropy", "score").collect()
        return sorted(((repr(r.doc), r.lang_pred, r.rejected), (r.entropy, r.score)) for r in rows)

    wanted = told()
    monkeypatch.setattr(langid, "MODEL_GRAMS", 20)
    monkeypatch.setattr(langid, "frequent", lambda counts, most: counts.where(chosen).select("lang", "gram", "n"))
    got = told()
    assert len({row[1] for row, _ in wanted}) > 2 and [row for row, _ in got] == [row for row, _ in wanted]
    assert [x for _, x in got] == [pytest.approx(x, rel=0, abs=1e-9) for _, x in wanted]


def test_run_is_its_stages(spark, tmp_path):
    folder = given(spark, tmp_path)
    rows = documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, spark.createDataFrame(rows.collect(), rows.schema), folder)
    got = corpus_pipeline.run(spark, folder)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert bag(got.select(columns)) == bag(rows.select(columns))
    assert corpus_pipeline.ORACLE_SQL is None and SCHEMA and queries.QUERIES
