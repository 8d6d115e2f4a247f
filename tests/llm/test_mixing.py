from pyspark.sql import functions as F

from estatescope.llm.mixing import capped_mean, mean_for, mix


def test_inverse_of_the_capped_mean():
    for cap in (1, 2, 8):
        for rate in (0.05, 0.5, 0.93):
            assert abs(capped_mean(mean_for(rate * cap, cap), cap) - rate * cap) < 1e-9


def test_shares_and_caps(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 2000, "big").when(F.col("id") < 2500, "mid").when(F.col("id") < 2600, "small").otherwise("other").alias("source"),
        F.expr("repeat('palabra nueva ', cast(1 + id % 7 as int))").alias("text"),
    )
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.2, 8), ("none", 0.0, 3)], "source string, target_share double, max_repeats int")
    m = mix(docs, targets, total_tokens=10_000)
    shares = {r.source: r for r in m.shares.collect()}
    assert all(abs(shares[s].share - t) < 0.01 for s, t in (("big", 0.5), ("mid", 0.3), ("small", 0.2)))
    used = m.copies.groupBy("source", "doc_id").agg(F.count("*").alias("n"), F.countDistinct("copy").alias("c"))
    most = {r.source: r.m for r in used.groupBy("source").agg(F.max("n").alias("m")).collect()}
    assert most["big"] == 1 and most["mid"] <= 2 and most["small"] <= 8 and "other" not in most
    assert used.where("n <> c").count() == 0
    again = mix(docs, targets, total_tokens=10_000)
    assert again.copies.collect() == m.copies.collect()


def test_source_too_small_and_source_without_texts(spark):
    docs = spark.createDataFrame([(1, "a", "uno dos tres"), (2, "b", "cuatro"), (2, "b", "cuatro"), (3, None, "x"), (4, "a", None)], "doc_id long, source string, text string")
    targets = spark.createDataFrame([("a", 0.4, 1), ("b", 0.4, 2), ("c", 0.2, 5)], "source string, target_share double, max_repeats int")
    m = mix(docs, targets, total_tokens=1_000_000)
    got = {r.source: (r.most_uses, r.tokens) for r in m.shares.collect()}
    assert got["a"][0] == 1 and got["b"][0] == 2 and got["c"] == (0, 0)


def test_budget_beyond_what_a_source_has(spark):
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 500, "big").otherwise("small").alias("source"), F.expr("repeat('palabra nueva ', cast(1 + id % 7 as int))").alias("text"))
    targets = spark.createDataFrame([("big", 0.5, 3), ("small", 0.5, 2)], "source string, target_share double, max_repeats int")
    got = {r.source: r for r in mix(docs, targets, total_tokens="available").shares.collect()}
    assert got["small"].most_uses == 2 and got["small"].tokens == 2 * got["small"].available_tokens < got["small"].goal_tokens
    assert abs(got["big"].tokens - got["big"].goal_tokens) <= 20 and got["big"].share > 0.5


def test_one_row_of_a_document_counts(spark):
    rows = [(1, "a", "uno"), (1, "b", "uno dos tres cuatro cinco seis siete"), (2, "a", "dos tres"), (3, "b", "cuatro")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], "source string, target_share double, max_repeats int")
    m = mix(docs, targets, total_tokens=1_000)
    used = m.copies.collect()
    assert sorted(r.doc_id for r in used) == [1, 2, 3]
    whole = {(d, s): t for d, s, t in rows}
    from estatescope.llm.vocabulary import encoding

    assert all(r.n_tokens == len(encoding().encode_ordinary(whole[r.doc_id, r.source])) for r in used)
