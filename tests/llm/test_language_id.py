import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from clickmart.llm import language_id as lid
from clickmart.llm.queries import registry
from tests.llm.conftest import SF01, documents_frame, odd_rows

TEXTS = [("en", "the cat and the dog and the bird"), ("de", "der hund und die katze und der vogel")] * 3


def plain_prob(texts, lang, gram):
    """Interpolated Kneser-Ney by its definition."""
    counts = [Counter(g for la, t in texts if la == lang for w in lid.letter_runs(t) for g in lid.grams(w))]
    for _ in range(3):
        lower = defaultdict(int)
        for g in counts[-1]:
            lower[g[1:]] += 1
        counts.append(Counter(lower))
    counts = counts[::-1]
    letters = len(counts[0]) + lid.UNKNOWN_LETTERS
    p = 1 / letters
    for order in range(1, 5):
        c = counts[order - 1]
        n1, n2 = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        d = n1 / max(n1 + 2 * n2, 1) if n1 else 0.5
        g = gram[-order:]
        after = {k: v for k, v in c.items() if k[:-1] == g[:-1]}
        if after:
            total = sum(after.values())
            p = max(c.get(g, 0) - d, 0) / total + d * len(after) / total * p
    return p


def test_model_is_interpolated_kneser_ney(spark):
    df = spark.createDataFrame(TEXTS, "lang string, text string")
    model = lid.learn(df, bits=40)  # wide hashes: no shared slots
    assert model.langs == ["de", "en"]
    grams = ["\x02\x02\x02t", "\x02the", "the\x03", "and\x03", "zzzz", "\x02und", "xthe"]
    got = model.log_prob(grams)
    for i, g in enumerate(grams):
        for j, lang in enumerate(model.langs):
            assert got[i, j] == pytest.approx(math.log(plain_prob(TEXTS, lang, g)), abs=1e-9)


def test_probabilities_sum_to_at_most_one(spark):
    model = lid.learn(spark.createDataFrame(TEXTS, "lang string, text string"), bits=40)
    letters = sorted({c for _, t in TEXTS for c in t if c != " "}) + ["\x03"]
    for head in ("\x02\x02\x02", "\x02\x02t", "the", "qqq"):
        p = np.exp(model.log_prob([head + c for c in letters])).sum(axis=0)
        assert (p < 1.0 + 1e-9).all() and (p > 0.2).all()


def test_held_out_accuracy_and_folds(spark):
    out = registry()["op4_language_id"](spark, SF01).toPandas()
    docs = spark.read.parquet(f"{SF01}/documents.parquet").toPandas()
    m = out.merge(docs, on="doc_id")
    assert len(m) == len(docs)
    assert (m.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in m.doc_id]).all()
    held = m[m.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.98
    assert held.accepted.mean() > 0.9
    assert out.score.between(0, 1).all()


def test_held_out_labels_are_not_read(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").limit(300)
    from pyspark.sql import functions as F

    other = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, "xx").otherwise(F.col("lang")))
    key = lambda df: sorted(map(tuple, lid.identify(df).select("doc_id", "lang_pred").collect()))
    assert key(docs) == key(other)


def test_odd_rows(spark, odd_docs, no_docs):
    out = lid.identify(odd_docs).collect()
    assert len(out) == len(odd_rows())
    for r in out:
        text = {i: t for i, t, *_ in odd_rows() if i is not None}.get(r["doc_id"], None)
        if r["doc_id"] is not None and not lid.letter_runs(text or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        assert r["lang_pred"] in ("und", "en", "de", "fr")
    assert lid.identify(no_docs).count() == 0
    nothing = documents_frame(spark, [(1, "some text", None, None)])
    assert lid.identify(nothing).first()["lang_pred"] == "und"


def test_foreign_text_is_rejected(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(10_000_000 + i, "xqzv wkqj zzxq vvkw qxjz " * 20, None) for i in range(3)], docs.schema)
    out = lid.identify(docs.union(odd)).where("doc_id >= 10000000").collect()
    assert not any(r["accepted"] for r in out)


def test_scorer_tables_may_be_emptied(spark):
    model = lid.learn(spark.createDataFrame(TEXTS, "lang string, text string"))
    a, b = lid.Scorer(model), lid.Scorer(model, most=2)
    texts = ["the cat and the dog", "12 !!", "der hund", "the bird and the cat", ""]
    for mine, other in zip(a.entropies(texts), [b.entropies([t])[0] for t in texts], strict=True):
        assert (mine is None and other is None) or np.allclose(mine, other)
    assert a.entropies(["12 !!"]) == [None]


def many_grams(n=400_000):
    """One language with more distinct 4-grams than 2**18, as (lang, text) rows."""
    r = np.random.default_rng(5)
    letters = np.array([chr(0x4E00 + i) for i in range(3000)])
    runs = r.choice(letters, (n // 40, 40))
    return [("zh", " ".join("".join(x) for x in runs[i::20])) for i in range(20)]


def test_model_grows_with_the_distinct_grams(spark):
    rows = many_grams()
    model = lid.learn(spark.createDataFrame(rows, "lang string, text string"))
    seen = {g for _, t in rows for w in lid.letter_runs(t) for g in lid.grams(w)}
    assert len(seen) > 1 << 18
    for order in range(1, 5):
        tails = {g[-order:] for g in seen}
        assert len(model.grams[order - 1][0]) == len(tails)
        assert len(model.contexts[order - 1][0]) == len({g[:-1] for g in tails})
    # a gram that no text holds isn't taken for a seen one
    letters = [chr(0x4E00 + i) for i in range(3000)]
    other = [a + b + c + d for a, b, c, d in zip(letters, letters[7:], letters[99:], letters[500:], strict=False)]
    other = [g for g in other if g not in seen]
    keys = model.grams[3][0]
    assert len(other) > 2000 and not np.isin(model.slots(other), keys).any()


def test_numbers_that_are_no_digits_are_no_letters():
    assert lid.letter_runs("² ½ ① Ⅷ 12 _") == [] and lid.letter_runs("a²b Ⅷ Été") == ["a", "b", "été"]
