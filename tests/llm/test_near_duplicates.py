import random
import re

import numpy as np
import pytest

from estatescope.llm.dart import signatures
from estatescope.llm.near_duplicates import NearDuplicates


@pytest.mark.parametrize("seed", [1, 2])
def test_signature_agreement_is_weighted_jaccard(seed):
    rng = np.random.default_rng(seed)
    a, b = np.zeros(400), np.zeros(400)
    a[:300] = rng.choice([0.5, 1.0, 2.0, 5.0], 300)
    b[100:] = rng.choice([0.5, 1.0, 3.0], 300)
    b[100:220] = a[100:220]
    both = [np.flatnonzero(a), np.flatnonzero(b)]
    row = np.repeat([0, 1], [len(x) for x in both])
    element = np.concatenate(both).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    s = signatures(row, element, np.concatenate([a[both[0]], b[both[1]]]), 2, 2000)
    assert np.isfinite(s).all()
    assert abs((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.04


def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for _ in range(60):
        base = [rng.choice(words) for _ in range(rng.randint(18, 120))]
        for _ in range(rng.randint(1, 4)):
            text = list(base)
            for _ in range(rng.randint(0, 6)):
                k = rng.randrange(len(text))
                rng.choice([lambda: text.pop(k), lambda: text.insert(k, rng.choice(words)), lambda: text.__setitem__(k, rng.choice(words))])()
            rows += [(n + i, " ".join(text) if i else "\n".join(text).upper()) for i in range(rng.randint(1, 2))]
            n += 2
    return [*rows, (9000, None), (9001, ""), (9002, "few words only"), (9003, "w1 " * 3000), (9004, "w1 " * 3000)]


def brute(rows, width, threshold, least):
    sets = {}
    for i, t in rows:
        w = [x for x in re.split("[ \t\n\f\r]+", (t or "").lower()) if x]
        if len(w) >= least:
            sets[i] = (t, {tuple(w[k : k + width]) for k in range(len(w) - width + 1)})
    keys = sorted(sets)
    return {
        (a, b) for k, a in enumerate(keys) for b in keys[k + 1 :]
        if sets[a][0] != sets[b][0] and len(sets[a][1] & sets[b][1]) >= threshold * len(sets[a][1] | sets[b][1])
    }


@pytest.mark.parametrize("width,threshold,least,bands,per", [(3, 0.5, 20, 40, 3), (5, 0.8, 5, 16, 4)])
def test_pairs_like_brute_force(spark, width, threshold, least, bands, per):
    rows = corpus()
    df = spark.createDataFrame(rows * 2, "id long, text_excerpt string")
    near = NearDuplicates(df, width=width, threshold=threshold, least_words=least, bands=bands, rows_per_band=per)
    got = [tuple(r) for r in near.pairs().collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, width, threshold, least)


def test_groups_have_every_long_text_once(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "id long, text_excerpt string")
    got = NearDuplicates(df, width=3, threshold=0.5, least_words=20, bands=40, rows_per_band=3).groups().collect()
    assert len(got) == len({r.id for r in got})
    same = {(a, b) for a, b in brute(rows, 3, 0.5, 20)}
    group = {r.id: r.group_id for r in got}
    assert all(group[a] == group[b] for a, b in same)
    assert {r.group_id for r in got if r.id in (9003, 9004)} == {9003}
