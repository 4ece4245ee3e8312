import numpy as np
import pytest
import public_tokenizers
import tiktoken

import corpus_pipeline
from tallywind.llm import bpe, pii, simhash, toxicity
from tallywind.llm.common import table
from tallywind.llm.queries import ORACLES, QUERIES, ranks_path
from tests.llm.test_pii import base_spans


def test_each_stage_takes_effect(spark, tables):
    docs = table(spark, tables, "documents").cache()
    names = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near-duplicates", "personal data", "mixing", "encoding"]
    kept = docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, kept = kept, stage(spark, kept, tables).cache()
        seen[name] = (before, kept)
        if name != "encoding":
            assert kept.columns == names
    before, after = seen["toxicity"]
    scores = toxicity.score_toxicity(before, table(spark, tables, "labels")).toPandas()
    assert {r["doc_id"] for r in after.collect()} == set(scores[scores.predicted == 0].doc_id)
    before, after = seen["near-duplicates"]
    found = simhash.near_duplicates(before).toPandas()
    assert {r["doc_id"] for r in after.collect()} == set(found.component_id)
    before, after = seen["personal data"]
    assert before.count() == after.count()
    assert not any(s for r in after.collect() for s in base_spans(r["text"] or ""))
    assert all(r["n_chars"] == len(r["text"] or "") for r in after.collect())
    before, after = seen["mixing"]
    words = lambda df: sum(len((r["text"] or "").split()) for r in df.collect())
    assert 1.2 < words(after) / words(before) < 1.8
    before, after = seen["encoding"]
    assert after.count() == before.count()
    codec = bpe.Codec(bpe.read_ranks(ranks_path()))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    for r in after.limit(80).collect():
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode_ordinary(texts[r["doc_id"]])


def test_run_and_registration(spark, tables):
    import __spark_entry__

    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())
    found = corpus_pipeline.run(spark, tables)
    assert found.count() > 0 and "ids" in found.columns


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, tables, name):
    duckdb = pytest.importorskip("duckdb")
    from tests.helpers import comparable

    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"create view {t} as select * from '{tables}/{t}.parquet'")
    assert comparable(QUERIES[name](spark, tables).toPandas()) == comparable(con.execute(ORACLES[name]).df())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_of_the_queries(spark, tables, name):
    fixed = {
        "op1_mixing": "doc_id bigint size bigint source_size bigint target double taken bigint",
        "op2_html_text": "page_id bigint url string text string n_chars bigint",
        "op3_simhash": "doc_id bigint fingerprint string component_id bigint",
        "op4_pii": "doc_id bigint n_email bigint n_ip bigint n_card bigint n_phone bigint base_sha256 string spans string",
        "op5_url_filter": "page_id bigint host string path string rule string verdict string",
        "op6_merkle": "doc_id bigint n_chars bigint edited_sha256 string fingerprint string edited_fingerprint string near_edited double near_next double",
        "op7_bpe": "doc_id bigint n_tokens bigint ids_sha256 string decoded_sha256 string",
        "op8_quality": "doc_id bigint held_out boolean score double predicted int",
        "op9_toxicity": "doc_id bigint held_out boolean score double predicted int",
        "op10_repetition": "doc_id bigint n_words bigint word_chars bigint n_symbols bigint n_dup_lines bigint n_repeat_words bigint base_failed boolean kept boolean",
        "op11_whitening": "vec_id bigint component int n bigint deviation bigint whitened double explained double identity_error double",
        "op12_neighbours": "query_id bigint rank int vec_id bigint score double",
        "op13_conversations": "conv_id bigint gaps bigint blank bigint duplicate bigint truncated bigint illegal bigint cost bigint audit string repaired_sha256 string",
    }
    found = QUERIES[name](spark, tables)
    assert " ".join(f"{n} {t}" for n, t in found.dtypes) == fixed[name]
    assert pii.KINDS == ("email", "ip", "card", "phone")
