import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from clickmart.llm import quality_classifier as qc
from tests.llm.conftest import SF
from tests.llm.test_packing import check_sequences
from tests.llm.test_simhash import plain_fingerprint
from tests.llm.test_substring_dedup import brute as cut


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    # 1: the network's verdict, document by document
    net = qc.train(*qc.training_rows(docs, labels, "doc_id", "text", 5, 0, qc.MOST_ROWS, qc.MOST_BYTES))
    tables = net.tables()
    left = {i: t for i, t in rows.items() if qc.score_text(net, tables, t or "") >= qc.THRESHOLD}
    # 9: of equal texts the largest id
    last = {}
    for i in sorted(left):
        last[left[i]] = i
    left = {i: left[i] for i in last.values()}
    # 6: of each group of near copies the smallest id
    ids = sorted(left)
    fps = {i: plain_fingerprint(left[i]) for i in ids}
    group = {i: i for i in ids}
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if (fps[i] ^ fps[j]).bit_count() <= 3 and group[i] != group[j]:
                a, b = sorted((group[i], group[j]))
                group = {x: (a if g == b else g) for x, g in group.items()}
    left = {i: left[i] for i in ids if group[i] == i}
    # 3: repeated passages
    left = {i: t for i, _, t in cut(sorted(left.items()))}

    out = corpus_pipeline.run(spark, SF).collect()
    check_sequences(out)
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {}
    for r in sorted(out, key=lambda r: r["start"]):
        got[r["doc_id"]] = got.get(r["doc_id"], b"") + bytes(r["ids"])
    assert set(got) == set(left)
    for i, text in left.items():
        assert got[i] == np.array(t.encode(text or "", add_special_tokens=False).ids + [1], "<u4").tobytes()


def test_stages_keep_columns_and_bear_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == odd_docs.columns, name
            docs = spark.createDataFrame(docs.collect(), odd_docs.schema)
        assert "sequence_id" in corpus_pipeline.STAGES[-1][1](spark, docs, SF).columns


def test_names_of_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "exact_dedup", "simhash_near_dedup", "substring_dedup", "packing"]
