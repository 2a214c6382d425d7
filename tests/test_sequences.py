"""Mergeable sequence values and the navigation paths counted by them."""

from collections import Counter

from clickmart.operators import metrics, sequences
from clickmart.schema import PATH_SEPARATOR as SEP


def value(spark, texts, cuts, head=sequences.HEAD):
    """The value of a list of (text, times), joined in pieces that end at ``cuts``."""
    arrays = []
    for lo, hi in zip([0, *cuts], [*cuts, len(texts)], strict=True):
        parts = [sequences.run("cast(null as string)" if t is None else f"'{t}'", f"{n}L", SEP, head)
                 for t, n in texts[lo:hi]]
        arrays.append(sequences.joined(f"array({', '.join(parts)})", SEP, head) if parts else sequences.empty())
    return spark.range(1).selectExpr(sequences.joined(f"array({', '.join(arrays)})", SEP, head) + " as v").first().v


def test_cuts_do_not_show_in_the_value(spark):
    texts = [("home", 1), ("cart", 3), (None, 2), ("", 1), ("a→b", 2), ("home", 1)]
    whole = value(spark, texts, [])
    path = SEP.join([t for t, n in texts if t is not None for _ in range(n)])
    assert (whole["head"], whole["chars"]) == (path, len(path))
    for cuts in ([1], [2, 3], [0, 4], [1, 2, 3, 4, 5]):
        assert value(spark, texts, cuts) == whole, cuts
    # the same text from other tokens, and runs spelled out one by one
    plain = [(t, 1) for t in path.split(SEP)]
    same = value(spark, plain, [4])
    assert all(same[f"h{i}"] == whole[f"h{i}"] for i in range(len(sequences.BASES)))


def test_runs_of_any_length_and_order(spark):
    a = value(spark, [("x", 1)] * 37, [])
    b = value(spark, [("x", 5), ("x", 32)], [1])
    assert a.asDict() | {"n": 0} == b.asDict() | {"n": 0}
    c, d = value(spark, [("x", 2), ("y", 1)], []), value(spark, [("y", 1), ("x", 2)], [])
    assert all(c[f"h{i}"] != d[f"h{i}"] for i in range(len(sequences.BASES)))
    big = value(spark, [("x", 10**9)], [])  # never written out
    assert big["chars"] == 2 * 10**9 - 1 and len(big["head"]) == sequences.HEAD


def test_head_is_cut_and_length_is_kept(spark):
    v = value(spark, [("home", 1), ("cart", 2), ("checkout", 1)], [1, 2], head=7)
    path = "home→cart→cart→checkout"
    assert (v["head"], v["chars"]) == (path[:7], len(path))


def hot_rows(spark):
    """A hot session, rows without a session, many sessions with equal paths, NULL times and types."""
    return spark.range(0, 60_000, 1, 8).selectExpr(
        "'page_view' as event_type",
        "case when id < 20000 then 'hot' when id < 25000 then null else concat('s', id div 7) end as session_id",
        "case when id % 1000 = 7 then null else timestampadd(SECOND, cast(case when id < 25000 then hash(id) % 90000 "
        "else id % 7 * 2000 end as int), timestamp'2025-06-01 10:00:00') end as timestamp",
        "element_at(array('home', 'category', 'product', 'cart', 'checkout', null), cast(case when id < 25000 "
        "then pmod(hash(id, 3), 6) else (id div 7 % 3 + id % 7) % 6 end + 1 as int)) as page_type",
    )


def test_paths_equal_a_plain_count_with_heads_of_any_size(spark):
    """Against paths written out for each session; short heads send most winners to the spelling."""
    rows = hot_rows(spark)
    plain = Counter()
    by_session = {}
    for r in rows.collect():
        by_session.setdefault(r.session_id, []).append(
            ((r.timestamp is not None, str(r.timestamp)), (r.page_type is not None, r.page_type or ""), r.page_type))
    for views in by_session.values():
        plain[SEP.join(t for _, _, t in sorted(views) if t is not None)] += 1
    assert len(plain) < 200
    for head in (sequences.HEAD, 9, 30):
        got = {r.path: r.session_count for r in metrics.navigation_paths(rows, k=len(plain), head=head).collect()}
        assert got == dict(plain), head


def test_no_task_joins_a_whole_session_unless_it_wins(spark):
    """Of the counted part, no group is keyed by the session alone before hours are joined."""
    text = metrics.navigation_paths(hot_rows(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "date_trunc(SECOND" in text and "date_trunc(HOUR" in text
