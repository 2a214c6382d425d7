import random

import numpy as np
from pyspark.sql import functions as F

from clickmart.llm import substring_dedup as sub
from clickmart.llm.common import spread_join
from clickmart.llm.queries import registry
from tests.llm.conftest import SF, documents_frame, odd_rows


def plain_ends(raw, reach=sub.REACH, longest=sub.LONGEST):
    """Byte by byte with the rolling form of the hash."""
    h, hashes = 0, []
    for b in raw:
        h = ((h << 1) + int(sub.GEAR[b])) & 0xFFFF
        hashes.append(h)
    cuts = [
        i + 1 for i, h in enumerate(hashes)
        if all(h < x for x in hashes[max(0, i - reach):i]) and all(h <= x for x in hashes[i + 1:i + 1 + reach])
        and h < 0xFFFF
    ]
    out, last = [], 0
    for c in sorted({*cuts, len(raw)} - {0}):
        out += [*range(last + longest, c, longest), c]
        last = c
    return out


def brute(rows, least=sub.LEAST):
    """(id, spans, text left); rows in the order in which earlier counts. A chunk that stands in an
    earlier place is compared with that place byte by byte, both ways."""
    first, raws, out = {}, {}, []
    for order, (i, text) in enumerate(rows):
        raw = raws[order] = (text or "").encode()
        gone, seen, start = [False] * len(raw), set(), 0
        for end in plain_ends(raw):
            piece, at = raw[start:end], start
            start = end
            if len(piece) < sub.REACH:
                continue
            who, there = first.setdefault(piece, (order, at))
            other = raws[who]
            if (who, there) == (order, at) or (who, at - there, at) in seen:
                continue
            a, b = at, at
            while b < len(raw) and there + b - at < len(other) and raw[b] == other[there + b - at]:
                b += 1
            while a > 0 and there + a - at > 0 and raw[a - 1] == other[there + a - at - 1]:
                a -= 1
            seen |= {(who, at - there, x) for x in range(at, b)}
            if b - a < least:
                continue
            while a < len(raw) and raw[a] & 0xC0 == 0x80:
                a += 1
            while b < len(raw) and raw[b] & 0xC0 == 0x80:
                b -= 1
            gone[a:b] = [True] * (b - a)
        edges = [k for k in range(len(raw) + 1) if (k > 0 and gone[k - 1]) != (k < len(raw) and gone[k])]
        spans = list(zip(edges[::2], edges[1::2], strict=True))
        left = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
        out.append((i, spans, left.decode() if spans else text))
    return out


def test_rolling_hash_in_bulk_is_the_rolling_hash():
    r = random.Random(1)
    for text in ["", "a", "ab" * 700, "é" * 900, "日本語テキスト" * 90,
                 *("".join(r.choice("abcdé 日\n") for _ in range(r.randint(1, 3000))) for _ in range(30))]:
        raw = text.encode()
        for reach in (3, 8, 24):
            assert sub.chunk_ends(raw, reach).tolist() == plain_ends(raw, reach)


def test_insertion_moves_only_near_cuts():
    r = random.Random(3)
    raw = bytes(r.randrange(32, 127) for _ in range(6000))
    other = raw[:3000] + b"inserted text" + raw[3000:]
    a, b = set(sub.chunk_ends(raw).tolist()), set(sub.chunk_ends(other).tolist())
    assert {e for e in a if e < 2970} <= b
    assert {e + 13 for e in a if e > 3045} <= b
    assert 35 < 6000 / len(a) < 65


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas().sort_values("doc_id")
    want = brute([(int(i), t) for i, t in zip(docs.doc_id, docs.text, strict=True)])
    out = registry()["op3_substring_dedup"](spark, SF).collect()
    got = sorted((r["doc_id"], list(zip(r["span_starts"], r["span_ends"], strict=True)), r["text"]) for r in out)
    assert got == want
    assert any(s for _, s, _ in want)


def test_planted_passages_go_and_clean_documents_stay(spark):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(60) for _ in range(20)]
    rows = [(i, f"{prose(80)}\n{passages[i % 20]}\n{prose(90)}", "en", "s") for i in range(60)]
    clean = [(100 + i, prose(200), "en", "s") for i in range(20)]
    out = {x["doc_id"]: x["text"] for x in sub.substring_dedup(documents_frame(spark, rows + clean)).collect()}
    for k, p in enumerate(passages):
        assert out[k] == rows[k][1]  # the first occurrence stays
        for i in (k + 20, k + 40):
            assert p not in out[i]
            own = rows[i][1].split("\n")
            assert own[0][:-9] in out[i] and own[2][9:] in out[i]  # but for letters that agree by chance
    assert all(out[i] == t for i, t, *_ in clean)


def test_odd_rows_full_bitmap_and_stage(spark, odd_docs, no_docs):
    out = sub.substring_dedup(odd_docs)
    assert out.count() == len(odd_rows())
    assert [c for c in out.columns if c != "removed_spans"] == [c for c in odd_docs.columns if c != "removed_spans"]
    small = sub.substring_dedup(odd_docs, bits=(15, 15))  # more false candidates, same result
    key = lambda df: sorted((str(r["doc_id"]), str(r["text"])) for r in df.collect())
    assert key(out) == key(small)
    staged = sub.cut_repeats(odd_docs)
    assert staged.columns == odd_docs.columns
    rows = staged.collect()
    assert all(r["text"] is None or r["n_chars"] == len(r["text"]) for r in rows)
    assert sum(r["text"] is None for r in rows) == 2
    assert sub.cut_repeats(no_docs).count() == 0
    six = next(r for r in rows if r["doc_id"] == 6)
    assert len(six["text"]) < 200  # but for the tail all of it repeats document 5


def test_bitmap_holds_all_keys_and_grows_with_them(spark):
    for n, size in ((0, 1 << 15), (100, 1 << 15), (5000, 1 << 17)):
        keys = spark.range(n).select((F.col("id") * 7919 - 12345).alias("k"))
        flags = sub.bitmap_of(keys, "k")
        assert 8 * len(flags) == size
        assert sub.among(flags, np.array([7919 * i - 12345 for i in range(n)], dtype=np.int64)).all()
        assert np.unpackbits(flags).sum() <= n


def test_short_matches_that_touch_stay(spark):
    """Document 3 shares 74 and 75 bytes with documents 1 and 2, one right after the other: no 96
    bytes of it stand in one earlier place."""
    r = random.Random(4)
    noise = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    found = 0
    for _ in range(20):
        a, b = noise(74), noise(75)
        rows = [(1, noise(200) + a + "1" + noise(200)), (2, noise(200) + "2" + b + noise(200)),
                (3, noise(100) + a + b + noise(100))]
        shared = [set(sub.chunks(t.encode())[2].tolist()) for _, t in rows]
        found += bool(shared[0] & shared[2]) and bool(shared[1] & shared[2])
        assert [s for _, s, _ in brute(rows)] == [[], [], []]
        if found == 1:
            frame = documents_frame(spark, [(i, t, "en", "s") for i, t in rows])
            assert sub.substring_dedup(frame).where("removed_spans is not null").count() == 0
            found += 1
    assert found


def test_equal_digests_of_other_bytes_cut_nothing(spark, monkeypatch):
    r = random.Random(6)
    texts = ["".join(r.choice("abcdefgh ") for _ in range(600)) for _ in range(12)]
    rows = [(i, t, "en", "s") for i, t in enumerate([*texts, texts[3] + texts[5]])]
    plain = {x["doc_id"]: x["text"] for x in sub.substring_dedup(documents_frame(spark, rows)).collect()}
    found = sub.matches(np.frombuffer(texts[0].encode(), np.uint8), np.frombuffer(texts[1].encode(), np.uint8), 0,
                        [(0, 0), (100, 50), (300, 400)], sub.LEAST)
    assert found == [] and plain[12] == "" and [plain[i] for i in range(12)] == texts


def test_a_key_held_by_most_rows_is_dealt_over_tasks(spark):
    many = spark.range(6000).select(F.when(F.col("id") < 4000, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    one = spark.range(6000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    out = spread_join(many, one, ["k"])
    assert out.columns == ["k", "v", "w"] and out.count() == 6000 and out.where("w != 2 * k").count() == 0
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = spread_join(many, one, ["k"]).withColumn("p", F.spark_partition_id())
        largest = out.groupBy("p").count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert largest < 2500


def repeated_windows(texts, words=50):
    """How many windows of words stand in two texts or more."""
    where, twice = {}, set()
    for i, text in enumerate(texts):
        ws = (text or "").split()
        for k in range(len(ws) - words + 1):
            key = hash(tuple(ws[k:k + words]))
            if where.setdefault(key, i) != i:
                twice.add(key)
    return len(twice)


def test_text_that_repeats_itself_keeps_the_first(spark):
    r = random.Random(5)
    passage = "".join(r.choice("abcdefghijklmnopé") for _ in range(150))
    rows = [(1, f"one {passage}|two {passage}#three", "en", "s"), (2, "x" * 3000, "en", "s")]
    out = {x["doc_id"]: x["text"] for x in sub.substring_dedup(documents_frame(spark, rows)).collect()}
    assert out[1].count(passage) == 1 and out[1].startswith(f"one {passage}|two") and out[1].endswith("#three")
    assert out == {i: t for i, _, t in brute([r[:2] for r in rows])} and len(out[2]) < 3000 and set(out[2]) == {"x"}


def test_no_window_of_fifty_words_stays_twice(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()
    out = registry()["op3_substring_dedup"](spark, "/root/testdata/sf0.01").select("text").collect()
    assert repeated_windows([r["text"] for r in docs]) > 20_000
    assert repeated_windows([r["text"] for r in out]) == 0
