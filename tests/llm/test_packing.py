import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from clickmart.llm import packing
from clickmart.llm.queries import registry
from tests.llm.conftest import SF01, documents_frame, odd_rows


def check_sequences(rows):
    """Pieces lie without gaps in sequences of at most 2048; returns tokens and padded size."""
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    used = padded = 0
    for parts in by.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at and n > 0
            at += n
        assert at <= 2048
        used += at
        padded += at if at & (at - 1) == 0 else 2048
    return used, padded


def test_odd_rows_match_the_tokenizers_library(spark, odd_docs, no_docs):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = packing.pack(packing.tokenize(odd_docs)).collect()
    check_sequences(out)
    docs = {}
    for r in sorted(out, key=lambda r: r["start"]):
        docs.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    for i, text, *_ in odd_rows():
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        copies = sum(1 for j, x, *_ in odd_rows() if (j, x or "") == (i, text or ""))
        got = docs[i, len(ids)]
        raw = {(r["start"], bytes(r["ids"])) for r in got}
        assert b"".join(x for _, x in sorted(raw)) == np.array(ids, "<u4").tobytes()
        assert len(got) == copies * len(raw)
    assert packing.pack(packing.tokenize(no_docs)).count() == 0


def test_query_covers_each_id_once_with_little_padding(spark):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = registry()["op10_packing"](spark, SF01).collect()
    used, padded = check_sequences(out)
    assert used / padded > 0.93  # small groups; 0.99 with full ones
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append(r)
    assert set(by) == set(docs)
    for i, text in list(docs.items())[:150]:
        ids = t.encode(text, add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(by[i], key=lambda r: r["start"]):
            part = ids[r["start"]:r["start"] + r["length"]]
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)


def test_differencing_is_a_partition_with_near_equal_sums():
    r = random.Random(2)
    for k in (1, 2, 3, 7):
        sizes = [r.randint(1, 512) for _ in range(120)]
        parts = packing.differencing(sizes, k)
        assert sorted(i for p in parts for i in p) == list(range(120))
        sums = [sum(sizes[i] for i in p) for p in parts]
        assert max(sums) - min(sums) <= 40
    assert packing.differencing([], 3) == []


def test_window_count_rises_when_capacity_is_exceeded():
    sizes = [1100] * 5
    parts = packing.windows(sizes, 2048)
    assert len(parts) == 5  # 5500 tokens would fit 3 windows by their sum
    assert all(sum(sizes[i] for i in p) <= 2048 for p in parts)


def test_cuts():
    for n in (1, 511, 512, 513, 2047, 2048, 2049, 5000):
        parts = packing.cuts(n)
        assert [s for s, _ in parts] == [sum(k for _, k in parts[:i]) for i in range(len(parts))]
        assert sum(k for _, k in parts) == n
        assert all(k == 2048 or k <= 512 for _, k in parts)


def test_rows_without_an_id_are_dealt_over_all_tasks(spark):
    from pyspark.sql import functions as F

    rows = [(None, f"text number {i} of many", "en", "s") for i in range(4000)]
    pieces = packing.tokenize(documents_frame(spark, rows))
    dealt = packing.pack(pieces).withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(dealt) == n and max(r["count"] for r in dealt) < 2 * 4000 / n
