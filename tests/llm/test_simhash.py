import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from clickmart.llm import simhash
from clickmart.llm.components import components
from clickmart.llm.queries import registry
from tests.llm.conftest import SF, documents_frame, odd_rows


def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or ""))
    words, now = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            if now:
                words.append(now)
            now = ""
        else:
            now += c
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(rows):
    """(id, fingerprint, component id) by comparing all pairs."""
    fps = [plain_fingerprint(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (doc, *_) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((d, f"{fps[i]:016x}", least.get(find(i))) for i, (d, *_) in enumerate(rows)), key=str)


def found(df):
    return sorted(map(tuple, df.select("doc_id", simhash.hex16(), "component_id").collect()), key=str)


def test_odd_rows(spark, odd_docs):
    out = simhash.simhash_dedup(odd_docs)
    short = [r for r in odd_rows()]
    assert found(out) == brute(short)
    assert out.where("kept").count() == len({c for _, _, c in brute(short)})


def test_query_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()
    want = brute([(int(i), t) for i, t in zip(docs.doc_id, docs.text, strict=True)])
    out = registry()["op6_simhash"](spark, SF).collect()
    assert sorted(map(tuple, out), key=str) == want


@pytest.mark.parametrize("tile", [4, 1024])
def test_hot_bucket_in_tiles_loses_no_link(spark, tile):
    r = random.Random(5)
    fps = [r.getrandbits(64) for _ in range(20)]
    for _ in range(300):
        x = r.choice(fps)
        for _ in range(r.randint(1, 4)):
            x ^= 1 << r.randrange(12)  # all changes in one piece: four pieces agree in big buckets
        fps.append(x)
    fps = sorted(set(fps))
    df = spark.createDataFrame([(simhash._signed(x),) for x in fps], "fp long")
    roots = dict(map(tuple, components(simhash.link_edges(df, tile=tile)).collect()))
    group = {}
    for i, a in enumerate(fps):
        group.setdefault(a, a)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 3:
                ga, gb = group[a], group[b]
                if ga != gb:
                    group = {k: (gb if v == ga else v) for k, v in group.items()}
    mine = {a: roots.get(simhash._signed(a), simhash._signed(a)) for a in fps}
    assert Counter(Counter(mine.values()).values()) == Counter(Counter(group.values()).values())
    for a in fps:
        assert len({mine[b] for b in fps if group[b] == group[a]}) == 1


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_bit_sliced_kernel(radius):
    r = np.random.default_rng(radius)
    fps = r.integers(0, 1 << 12, 400).astype(np.uint64) * np.uint64(0x0101010101)
    starts = np.array([0, 1, 3, 200])
    label = simhash.near_links(fps, starts, radius, rows_at_once=64)
    want = np.arange(400)
    for a, b in zip(starts, [*starts[1:], 400], strict=True):
        for i in range(a, b):
            for j in range(a, i):
                if int(fps[i] ^ fps[j]).bit_count() <= radius and want[i] != want[j]:
                    hi, lo = max(want[i], want[j]), min(want[i], want[j])
                    want[want == hi] = lo
    assert (label == want).all()


def test_components_of_long_chain_and_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (3, 2), (3, 2)]
    out = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert out == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 50)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_stage_keeps_columns_and_one_of_each_group(spark, odd_docs, no_docs):
    left = simhash.keep_one(odd_docs)
    assert left.columns == odd_docs.columns
    assert left.count() == len({c for _, _, c in brute(odd_rows())})
    assert simhash.keep_one(no_docs).count() == 0


def test_only_null_ids(spark):
    docs = documents_frame(spark, [(None, "a b c", None, None), (None, "a b c", None, None)])
    out = simhash.simhash_dedup(docs).collect()
    assert [r["component_id"] for r in out] == [None, None]
    assert sum(r["kept"] for r in out) == 1
