import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from clickmart.llm import exact_dedup
from clickmart.llm.queries import registry
from tests.llm.conftest import SF, documents_frame, odd_rows


def brute(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out += [(i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def found(df):
    rows = df.select("doc_id", "keep_id", "group_size", F.lower(F.hex("digest"))).collect()
    return sorted(map(tuple, rows), key=str)


def test_odd_rows_and_one_kept_per_text(spark, odd_docs):
    out = exact_dedup.exact_dedup(odd_docs)
    assert found(out) == brute(odd_rows())
    assert out.where("kept").count() == len({t or "" for _, t, *_ in odd_rows()})
    assert out.where("kept and not doc_id <=> keep_id").isEmpty()


def test_many_batches_and_weak_digest_compare_bytes(spark, tmp_path):
    rows = [(i, f"text {i % 7}", "en", "a") for i in range(60)]
    docs = documents_frame(spark, rows).repartition(6)
    docs.write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    strong = exact_dedup.exact_dedup(docs, max_files_per_trigger=1)
    assert found(strong) == brute(rows)
    # one digest for all: every text but the holder's is a collision
    weak = exact_dedup.exact_dedup(docs, digest=lambda t: F.unhex(F.lit("00")) , max_files_per_trigger=2)
    want = sorted(((a, b, c) for a, b, c, _ in brute(rows)), key=str)
    assert sorted((tuple(r) for r in weak.select("doc_id", "keep_id", "group_size").collect()), key=str) == want
    assert weak.where("kept").count() == 7


def test_empty_table_and_columns_kept(spark, odd_docs, no_docs):
    assert exact_dedup.exact_dedup(no_docs).count() == 0
    left = exact_dedup.keep_one(odd_docs)
    assert left.columns == odd_docs.columns
    assert left.count() == len({t or "" for _, t, *_ in odd_rows()})
    assert exact_dedup.keep_one(no_docs).columns == no_docs.columns


def test_query_has_one_row_per_document(spark):
    out = registry()["op9_exact_dedup"](spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    assert len(out) == len(docs)
    assert (out.kept == (out.doc_id == out.keep_id)).all()
