import public_tokenizers

import corpus_pipeline as C
from ledgerline.llm import bpe, decontaminate, lang_id, pseudonyms, simhash
from ledgerline.llm.common import table
from tests.llm.data import SF, awkward, frame, with_clash


def test_run_is_the_stages_by_hand(spark):
    """The pipeline against its operators' single-row functions and queries."""
    docs = table(spark, SF, "documents")
    kept = {r.doc_id for r in lang_id.query(docs).collect() if r.lang_pred != "und"}
    docs = docs.where(docs.doc_id.isin(*kept))
    kept = {r.component_id for r in simhash.query(docs).collect()}
    docs = docs.where(docs.doc_id.isin(*kept))
    kept -= {r.doc_id for r in decontaminate.query(docs, table(spark, SF, "benchmark")).collect()}
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        coder = bpe.ByteBpe(f.read())
    want = {(r.doc_id, *coder.digest(pseudonyms.pseudonyms(r.text)[0])) for r in docs.where(docs.doc_id.isin(*kept)).collect()}
    got = [tuple(r) for r in C.run(spark, SF).collect()]
    assert len(got) == len(want) and set(got) == want


def test_stages_keep_columns_and_take_awkward_rows(spark):
    docs = with_clash(frame(spark, awkward()), "_fp", "_language", "_text_key", "_pseudonyms")
    for _, stage in C.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert 4 <= len(C.STAGES) <= 5
