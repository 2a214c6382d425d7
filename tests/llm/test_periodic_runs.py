import hashlib
import random
import re
import zlib

import pytest

from clickmart.llm import periodic_runs as op
from clickmart.llm.queries import registry
from tests.llm.conftest import SF, documents_frame, odd_rows


def plain_runs(words, least=6):
    """All runs by trying every period at every place."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least, 4 * q) and not any(
                all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q)
            ):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    return " ".join(w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs))


def words_of(text):
    return re.findall("[^\x20\x09-\x0D]+", text or "")


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def random_words(rnd):
    k, n = rnd.choice([1, 2, 2, 3, 5, 50]), rnd.choice([0, 1, 5, 6, 7, 20, 60, 200])
    words = [rnd.randrange(k) for _ in range(n)]
    for _ in range(rnd.randrange(4) if n else 0):
        a, p = rnd.randrange(n), rnd.randrange(1, 40)
        root = [rnd.randrange(k) for _ in range(p)]
        if p > 4 and rnd.random() < 0.4:  # a highly periodic root with one odd word
            root = (root[:rnd.randrange(1, 4)] * p)[:p - 1] + [99]
        words[a:a + rnd.randrange(p, p * 7)] = (root * 8)[:rnd.randrange(p, p * 7)]
    return [b"%d" % w for w in words]


def test_runs_against_all_periods():
    rnd, seen = random.Random(11), 0
    for _ in range(150):
        texts = [random_words(rnd) for _ in range(rnd.choice([1, 3, 10]))]
        for words, runs in zip(texts, op.runs_of(texts), strict=True):
            assert runs == plain_runs(words)
            seen += len(runs)
            assert op.collapsed(words, runs).decode() == plain_collapsed([w.decode() for w in words], runs)
    assert seen > 500


@pytest.mark.parametrize("n, q", [(5, 1), (6, 1), (7, 2), (8, 2), (400, 100), (399, 100), (30_000, 7000), (50_000, 3)])
def test_one_run(n, q):
    words = [b"x%d" % (i % q) for i in range(n)]
    rest = [b"y%d" % i for i in range(50)]
    want = [(50, n, q)] if n >= max(6, 4 * q) else []
    assert op.runs_of([rest + words + rest, words[:3]])[0] == want


def test_texts_dont_run_into_each_other():
    assert op.runs_of([[b"a"] * 4, [b"a"] * 4, [b"a"] * 6]) == [[], [], [(0, 6, 1)]]


def test_fibonacci_words_have_no_fourth_power():
    a, b = "a", "ab"
    while len(b) < 20_000:
        a, b = b, b + a
    assert op.runs_of([[c.encode() for c in b]]) == [[]]


def test_odd_rows(spark, odd_docs, no_docs):
    got = sorted((tuple(r) for r in op.periodic_runs(odd_docs).collect()), key=str)
    want = []
    for i, text, *_ in odd_rows():
        words = words_of(text)
        runs = [] if len(words) > 1000 else plain_runs(words)
        if len(words) > 1000:  # period 977 by construction, the tail is another word
            runs = [(0, 60_000, 977)]
        want.append((i, runs, plain_collapsed(words, runs)))
    assert [(i, [tuple(r) for r in runs], c) for i, runs, c in got] == sorted(want, key=str)
    assert op.periodic_runs(no_docs).count() == 0


def test_groups_don_t_change_results(spark, monkeypatch):
    rows = [(i, " ".join(f"w{k % (i + 1)}" for k in range(9 * i)), "en", "s") for i in range(60)]
    docs = documents_frame(spark, rows)
    whole = sorted(map(str, op.periodic_runs(docs).collect()))
    monkeypatch.setattr(op, "GROUP", 1)
    assert [r["runs"] for r in op.periodic_runs(docs).collect()]
    assert sorted(map(str, op.periodic_runs(docs).collect())) == whole


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {}
    for d in docs:
        words = planted(d["doc_id"], words_of(d["text"]))
        runs = [(int(s), int(n), int(q)) for s, n, q in plain_runs(words)] if len(words) < 3000 else None
        want[d["doc_id"]] = words, runs
    out = registry()["op11_periodic_runs"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(want)
    checked = 0
    for r in out:
        words, runs = want[r["doc_id"]]
        if runs is None:  # long texts: the run of the planted period, by construction
            continue
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=None)
        assert r["n_runs"] == len(runs)
        assert (r["start"], r["length"], r["period"]) == (best or (None, None, None))
        assert r["exponent_milli"] == (None if best is None else 1000 * best[1] // best[2])
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert r["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest()
        checked += len(runs)
    assert checked > 5
