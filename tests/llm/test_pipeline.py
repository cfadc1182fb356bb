import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from riskloom.llm import bradley_terry, decontam, mixing, queries
from tests.conftest import SF001
from tests.llm.test_decontam import closest
from tests.llm.test_simhash import closure, plain
from tests.llm.test_wavelet import want_rows

COLUMNS = {
    "op1_line_dedup": ["doc_id", "n_lines", "n_removed", "text", "n_runs", "longest_run", "first_doc", "first_line"],
    "op2_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op3_wavelet_tokens": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op4_simhash": ["doc_id", "fingerprint", "component_id"],
    "op5_quality": ["doc_id", "held_out", "score", "predicted"],
    "op6_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op7_topk": ["query_id", "rank", "vec_id", "score"],
    "op8_url_filter": ["page_id", "host", "path", "rule", "verdict"],
    "op9_licenses": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op10_decontamination": ["doc_id", "item_id", "distance", "end_word", "item_words"],
    "op11_ranked_search": ["item_id", "rank", "doc_id", "score"],
    "op12_whitening": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    "op13_toxicity": ["doc_id", "held_out", "score", "predicted"],
}


def test_registered():
    names = __spark_entry__.queries()
    assert set(COLUMNS) | {"pipeline"} <= set(names)
    assert set(__spark_entry__.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", COLUMNS)
def test_columns(spark, name):
    assert queries.QUERIES[name](spark, SF001).columns == COLUMNS[name]


def test_stages(spark):
    """Every stage against a brute-force version over what the one before kept."""
    docs = queries.table(spark, SF001, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["quality classifier"](spark, docs, SF001)
    assert kept.columns == columns
    labels = {r.doc_id: r.quality for r in queries.table(spark, SF001, "labels").collect()}
    ids = {r.doc_id for r in kept.collect()}
    learned = {r.doc_id for r in queries.training_labels(queries.table(spark, SF001, "labels")).collect()}
    assert all((i in ids) == (labels[i] == 1) for i in learned)
    held = [(i in ids) == (labels[i] == 1) for i in set(labels) - learned]
    assert sum(held) >= 0.85 * len(held)  # 19 documents, 8 bad ones to learn from

    one = stages["simhash near-dedup"](spark, kept, SF001)
    assert one.columns == columns
    order = sorted(ids)
    first = closure(order, [plain(rows[i].text) for i in order])
    assert sorted(r.doc_id for r in one.collect()) == sorted(set(first))

    clean = stages["benchmark decontamination"](spark, one, SF001)
    assert clean.columns == columns
    items = [decontam.words(r.text) for r in queries.table(spark, SF001, "benchmark").collect()]
    leaky = {i for i in set(first) for p in items
             if closest(p, decontam.words(rows[i].text))[0] <= int(decontam.RATE * len(p))}
    left = sorted(r.doc_id for r in clean.collect())
    assert left == sorted(set(first) - leaky)

    mixed = stages["source mixing"](spark, clean, SF001)
    assert mixed.columns == columns
    copies = {r.doc_id: r.copies for r in mixing.mix(clean).collect()}
    got = sorted(r.doc_id for r in mixed.collect())
    assert got == sorted(i for i in left for _ in range(copies[i]))

    tokens = stages["token ids"](spark, mixed, SF001)
    assert sorted((tuple(r) for r in tokens.collect()), key=lambda r: r[1]) == want_rows([(i, rows[i].text, "") for i in got])


def test_odd_documents(spark, make_docs, odd_rows, monkeypatch):
    docs = make_docs(odd_rows, extra=True)
    for rows in (docs, make_docs([])):
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, rows, SF001)
            assert i == 4 or out.columns == rows.columns
            rows = out
        rows.collect()


def test_held_out_labels_are_not_learned(spark):
    labels = queries.training_labels(queries.table(spark, SF001, "labels"))
    assert labels.filter(bradley_terry.held_out(F.col("doc_id"))).isEmpty()


def test_run(spark):
    out = corpus_pipeline.run(spark, SF001)
    assert out.columns == COLUMNS["op3_wavelet_tokens"] and out.count() > 0
