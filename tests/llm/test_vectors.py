"""Operators on embeddings against brute force over all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from imagelake.llm import embedding_dedup as ed
from imagelake.llm import hard_negatives as hn


def table(spark, rows):
    return spark.createDataFrame([(i, e, y, "x", 1, b"", 2, 3) for i, e, y in rows],
                                 "vec_id long, embedding array<float>, label int, digest string, size int, vec binary, row int, home int")


def usable(e):
    return e is not None and all(x is not None and math.isfinite(x) for x in e)


AWKWARD = [(None, [1.0, 0.0], 1), (901, None, 1), (902, [], 1), (903, [0.0] * 16, 1), (904, [1.0, None], 1), (905, [float("nan"), 1.0], 1),
           (906, [float("inf"), 1.0], 1), (907, [1.0, 0.0], None), (908, [2.0, -0.0], 1), (908, [3.0], 1), (908, [3.0], 1),
           (909, [1e30, 0.0], 1), (910, [1e-30], 1), (911, [0.0, 1.0], 7)]


def vectors(seed, n=300, width=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(6, width))
    rows = []
    for i in range(n):
        v = base[rng.integers(6)] + rng.normal(size=width) * rng.choice([0.1, 0.25, 0.4])
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(rng.integers(3))))
    rows += [(400 + i, *rows[rng.integers(20)][1:]) for i in range(60)]  # exact copies
    return rows + AWKWARD


def linked_by_brute_force(rows):
    """(n_links, component_id) per row number."""
    ids = [2 ** 63 - 1 if i is None else i for i, _, _ in rows]
    ok = [k for k, (_, e, y) in enumerate(rows) if y is not None and usable(e) and any(e)]
    width = max(len(rows[k][1]) for k in ok)
    x = np.array([np.r_[rows[k][1], np.zeros(width - len(rows[k][1]))] for k in ok], np.float64)
    x /= np.abs(x).max(1)[:, None]
    x /= np.linalg.norm(x, axis=1)[:, None]
    links, part = [0] * len(rows), list(range(len(rows)))
    for a, row in enumerate(x @ x.T >= ed.COSINE):
        for b in np.flatnonzero(row):
            i, j = ok[a], ok[b]
            if i != j and rows[i][2] == rows[j][2]:
                links[i] += 1
                if part[i] != part[j]:
                    lo, hi = sorted((part[i], part[j]))
                    part = [lo if p == hi else p for p in part]
    least = {p: min(i for i, q in zip(ids, part) if q == p) for p in set(part)}
    return [(i, n, least[p], i == least[p]) for i, n, p in zip(ids, links, part)]


@pytest.mark.parametrize("lists,margin,block", [(1, ed.MARGIN, 2048), (12, ed.EXACT, 2048), (5, ed.EXACT, 16)])
def test_links_equal_brute_force(spark, monkeypatch, lists, margin, block):
    monkeypatch.setattr(ed, "BLOCK_ROWS", block)
    rows = vectors(lists)
    back = lambda x: 2 ** 63 - 1 if x is None else x
    out = ed.embedding_dedup(spark, table(spark, rows), margin=margin, lists=lists).collect()
    assert sorted((back(r["vec_id"]), r["n_links"], back(r["component_id"]), r["kept"]) for r in out) == sorted(linked_by_brute_force(rows))


def test_the_default_margin_finds_nearly_all(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(40, 64))
    rows = [(i, [float(v) for v in (base[i % 40] + rng.normal(size=64) * 0.17).astype(np.float32)], 0) for i in range(600)]
    want = sum(r[1] for r in linked_by_brute_force(rows))
    got = sum(r["n_links"] for r in ed.embedding_dedup(spark, table(spark, rows), lists=24).collect())
    assert want > 1000 and 0.99 * want <= got <= want


def test_no_vectors(spark):
    assert ed.embedding_dedup(spark, table(spark, [])).count() == 0
    out = ed.embedding_dedup(spark, table(spark, [(1, None, 1), (2, [1.0], None)])).collect()
    assert sorted(map(tuple, out)) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert hn.hard_negatives(spark, table(spark, []), F.col("vec_id") % 2 == 0).count() == 0
    assert hn.hard_negatives(spark, table(spark, [(2, None, 1), (4, [1.0], None)]), F.col("vec_id") % 2 == 0).count() == 0


def mined_by_brute_force(rows, every):
    big = 2 ** 63 - 1
    use = [(big if i is None else i, [math.floor(256 * x) for x in e], y) for i, e, y in rows if y is not None and usable(e)]
    out = []
    for a, (i, q, y) in enumerate(use):
        if i == big or i % every:
            continue
        score = [max(-hn.TOP, min(hn.TOP, sum(u * v for u, v in zip(q, p)))) for _, p, _ in use]
        order = sorted((k for k in range(len(use)) if k != a), key=lambda k: (-score[k], use[k][0]))
        for p in [k for k in order if use[k][2] == y][:5]:
            fit = [k for k in order if use[k][2] != y and 30 * score[p] <= 100 * score[k] <= 90 * score[p]][:10]
            out += [(i, use[p][0], n, use[k][0], score[p], score[k]) for n, k in enumerate(fit, 1)]
    return sorted(out)


@pytest.mark.parametrize("block,step", [(4096, 2048), (7, 32)])
def test_negatives_equal_brute_force(spark, monkeypatch, block, step):
    monkeypatch.setattr(hn, "ANCHOR_BLOCK", block)
    monkeypatch.setattr(hn, "STEP_ROWS", step)
    rows = vectors(5, n=200)
    rng = random.Random(1)
    # ties: many equal scores, zero scores, and scores below zero
    rows += [(1000 + i, [rng.choice([0.0, 0.25, -0.25]) for _ in range(3)], rng.randrange(2)) for i in range(80)]
    rows += [(2000, [0.0, 0.0, 0.0], 1), (2002, [0.0], 0), (2004, [-1.0] * 16, 0)]
    back = lambda x: 2 ** 63 - 1 if x is None else x
    out = hn.hard_negatives(spark, table(spark, rows).repartition(5), F.col("vec_id") % 4 == 0).collect()
    got = sorted((r["anchor_id"], back(r["positive_id"]), r["rank"], back(r["negative_id"]), r["positive_score"], r["negative_score"]) for r in out)
    assert got == mined_by_brute_force(rows, 4)
    assert len(got) > 1000


def test_keys_sort_by_anchor_score_and_id():
    parts = [(5, 1, 10, 0, 7, 3), (5, 1, 10, 1, 6, 2), (5, 1, 10, 1, 8, 2), (5, 1, -4, 0, 1, 1), (5, 2, 99, 1, 1, 1), (700, 0, 99, 0, 1, 1)]
    keys = [hn.packed_key(*p) for p in parts]
    assert sorted(reversed(keys)) == keys
