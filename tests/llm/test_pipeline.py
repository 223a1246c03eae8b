"""The corpus pipeline: each stage's decision, its columns, and the run as a whole."""

from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as cp
from heightgrid.llm.near_dup import near_duplicates
from heightgrid.llm.repetition import repetition
from heightgrid.llm.secrets import base_spans
from heightgrid.session import checkpoint

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id for r in repetition(docs).collect() if r.kept}
    first = checkpoint(cp.quality_rules(spark, docs, SF))
    assert {r.doc_id for r in first.collect()} == kept
    single = {r.doc_id for r in near_duplicates(first, 80).collect() if r.kept}
    second = checkpoint(cp.near_dedup(spark, first, SF))
    assert sorted(r.doc_id for r in second.collect()) == sorted(single)
    third = checkpoint(cp.secret_scan(spark, second, SF))
    before, after = ({r.doc_id: r for r in d.collect()} for d in (second, third))
    assert before.keys() == after.keys() and not any(base_spans(r.text) for r in after.values())
    assert all(after[d].text == r.text for d, r in before.items() if not base_spans(r.text)) and all(len(r.text) == r.n_chars for r in after.values())
    fourth = checkpoint(cp.mixing(spark, third, SF))
    assert set(Counter(r.doc_id for r in fourth.collect()).values()) <= {1, 2}
    assert all(d.columns == list(cp.COLUMNS) for d in (first, second, third, fourth))
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in fourth.collect()}
    last = cp.token_ids(spark, fourth, SF).collect()
    assert all(r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids for r in last)
    assert sorted(map(tuple, ((r.doc_id, r.n_tokens) for r in cp.run(spark, SF).collect()))) == sorted((r.doc_id, r.n_tokens) for r in last)


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        out = checkpoint(stage(spark, docs, SF))
        assert out.count() == 0
        docs = docs if stage is cp.token_ids else out
