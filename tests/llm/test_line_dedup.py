import re

from clickmart.llm import line_dedup
from clickmart.llm.queries import registry
from tests.llm.conftest import SF, documents_frame, odd_rows

WORD = re.compile(r"[^\x20\x09-\x0D]")


def test_shared_run_goes_from_later_documents(spark):
    run = "first shared line\nsecond shared line\nthird shared line"
    rows = [(i, f"own {i} a\n{run}\nown {i} b", "en", "s") for i in range(5)] + [(9, run + "\n" + run, "en", "s")]
    out = {r["doc_id"]: r for r in line_dedup.line_dedup(documents_frame(spark, rows)).collect()}
    assert out[0]["text"] == rows[0][1]
    for i in range(1, 5):
        assert out[i]["text"] == f"own {i} a\nown {i} b"
    assert (out[9]["text"], out[9]["n_lines"], out[9]["n_removed_lines"]) == ("", 6, 6)


def test_single_repeated_lines_and_blank_lines_stay(spark):
    rows = [(1, "alpha\n\n\nbeta", "en", "s"), (2, "gamma\n\n\nbeta", "en", "s"), (3, "\n\n\n", "en", "s"), (4, "\n\n\n", "en", "s")]
    out = {r["doc_id"]: r["text"] for r in line_dedup.line_dedup(documents_frame(spark, rows)).collect()}
    assert out == {i: t for i, t, *_ in rows}


def test_odd_rows(spark, odd_docs, no_docs):
    out = line_dedup.line_dedup(odd_docs)
    assert out.count() == len(odd_rows())
    assert [c for c in out.columns if c not in ("n_lines", "n_removed_lines")] == odd_docs.columns
    assert line_dedup.line_dedup(no_docs).count() == 0
    eleven = out.where("doc_id = 11").first()
    assert eleven["text"].split("\n")[:3] == ["a", "b", "c"] and eleven["n_removed_lines"] == 4


def seen_earlier(rows, window=2):
    """(id, lines removed, text left) by the plain rule: lines of any ``window`` lines in a row
    that stand in an earlier place. rows: (id, text) in the order in which earlier counts."""
    seen, out = set(), []
    for i, t in rows:
        lines, gone = (t or "").split("\n"), set()
        at = [k for k, s in enumerate(lines) if WORD.search(s)]
        for k in range(len(at) - window + 1):
            key = tuple(lines[x] for x in at[k:k + window])
            gone.update(at[k:k + window] if key in seen else ())
            seen.add(key)
        out.append((i, len(gone), "\n".join(s for k, s in enumerate(lines) if k not in gone) if gone else t))
    return out


def test_frequent_lines_hide_no_repeated_run(spark):
    """Each line first occurs among other neighbours, so one line's first place never shows the run."""
    names = [f"line {c}" for c in "abcdefgh"]
    rows = [(i, f"{n}\nonly {i}") for i, n in enumerate(names)]
    pairs = [(a, b) for a in names for b in names if a != b]
    rows += [(100 + i, f"head {i}\n{a}\n{b}\ntail {i}") for i, (a, b) in enumerate(pairs + pairs)]
    out = line_dedup.line_dedup(documents_frame(spark, [(i, t, "en", "s") for i, t in rows])).collect()
    want = seen_earlier(rows)
    assert sorted((r["doc_id"], r["n_removed_lines"], r["text"]) for r in out) == want
    assert sum(n for _, n, _ in want) == 2 * len(pairs)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas().sort_values("doc_id")
    want = seen_earlier([(int(i), t) for i, t in zip(docs.doc_id, docs.text, strict=True)])
    out = registry()["op2_line_dedup"](spark, SF).collect()
    assert sorted((r["doc_id"], r["n_removed_lines"], r["text"]) for r in out) == want
    assert sum(n for _, n, _ in want) == 188


def test_fingerprints_are_minima_and_runs_are_extended(spark):
    shared = "\n".join(f"shared line {i}" for i in range(9))
    rows = [(1, f"a\n{shared}\nb", "en", "s"), (2, f"c\nd\n{shared}\ne", "en", "s"), (3, "shared line 4\nx y", "en", "s")]
    docs = documents_frame(spark, rows)
    runs = line_dedup.repeated_runs(docs).collect()
    assert [(r["diagonal"], r["lines"]) for r in runs] == [(1, list(range(2, 11)))]
    seqs = line_dedup._sequences(line_dedup.with_locator(docs), "doc_id", "text")
    for window in (2, 3, 4):
        for r in seqs.select("hashes", line_dedup._fingerprints(window).alias("w")).collect():
            h = r["hashes"]
            assert len(r["w"]) == max(0, len(h) - window + 1)
            for w in r["w"]:
                around = h[w["start"]:w["start"] + window]
                assert w["key"]["around"] == around and w["key"]["fingerprint"] == min(around) == h[w["pos"]]
                assert min(around) not in h[w["pos"] + 1:w["start"] + window]


def test_query_removes_every_window_seen_earlier(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text").toPandas().sort_values("doc_id")
    want = seen_earlier([(int(i), t) for i, t in zip(docs.doc_id, docs.text, strict=True)])
    out = registry()["op2_line_dedup"](spark, "/root/testdata/sf0.1").collect()
    assert sorted((r["doc_id"], r["n_removed_lines"], r["text"]) for r in out) == want
