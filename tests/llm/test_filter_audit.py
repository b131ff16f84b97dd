"""Filter interaction audit against a brute-force walk over all orders."""

import itertools
import random
import re
from collections import Counter

from imagelake.llm.filter_audit import filter_audit, own_mask

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(rows, labels):
    """rows (doc_id, source, text), labels (doc_id, quality, toxic) -> {(part, order, step): counts}."""
    big = 2 ** 63 - 1
    least = {}
    for i, _, t in rows:
        least[t or ""] = min(least.get(t or "", big), big if i is None else i)
    docs = []
    for i, s, t in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
                 "E": (big if i is None else i) > least[t]}
        mine = [x for x in labels if i is not None and x[0] == i]
        docs.append((s or "", {k for k, v in fails.items() if v}, any(x[1] == 1 for x in mine), any(x[2] == 1 for x in mine)))
    out, shapley = {}, Counter()
    for part in {d[0] for d in docs}:
        for order in itertools.permutations("ABCDE"):
            left = gone = None
            for step, f in enumerate(order, 1):
                before = set(order[:step - 1])
                own = [d for d in docs if d[0] == part]
                left = [d for d in own if not d[1] & (before | {f})]
                gone = [d for d in own if f in d[1] and not d[1] & before]
                out[part, "".join(order), step] = (
                    len(left), len(gone), sum(f in d[1] and bool(d[1] & before) for d in own), sum(d[1] == {f} for d in own),
                    sum(d[2] for d in gone), sum(d[3] for d in gone))
                shapley[part, f] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def table(df):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in df.collect()}


def documents(spark, rows):
    return spark.createDataFrame([(i, s, t, "x", 1, "y", 2) for i, s, t in rows],
                                 "doc_id long, source string, text string, part string, mask int, digest string, n int")


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_every_order_equals_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for i in range(120):
        words = [f"w{rng.randrange(80)}" for _ in range(rng.choice([5, 49, 50, 51, 90]))]
        words += rng.choice([[], ["LOUD", "WORDS", "HERE"] * 8, ["a#b"], ["Ünïcode", "ŻÓŁĆ"], ["x|y", "AB"]])
        rows.append((i, rng.choice(["a", "b", None, "", "hot"]), rng.choice([" ", "\n", "\x0b\t"]).join(words)))
    rows += [(200 + i, rng.choice("ab"), rows[rng.randrange(40)][2]) for i in range(40)]
    rows += [(None, None, None), (None, "a", ""), (3, "b", rows[7][2]), (3, "b", rows[7][2]), (None, "b", rows[9][2]),
             (None, "b", "only here"), (None, "b", "only here"), (900, "long", " ".join(f"w{i}" for i in range(30_000)))]
    labels = [(rng.randrange(200), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(150)] + [(None, 1, 1)]
    got = table(filter_audit(spark, documents(spark, rows), labels_of(spark, labels)))
    assert got == brute_force(rows, labels)
    assert len(got) == 600 * 5


def test_empty_table_and_no_labels(spark):
    none = labels_of(spark, [])
    assert filter_audit(spark, documents(spark, []), none).count() == 0
    got = table(filter_audit(spark, documents(spark, [(1, None, None)]), none))
    assert len(got) == 600
    # the empty text fails A alone: B and C compare 0 with 0
    assert got["", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120)


def test_bounds_are_exact():
    words = [f"w{i}" for i in range(65)]
    assert own_mask(" ".join(words + ["w0"] * 35).encode()) == 0
    assert own_mask(" ".join(words[1:] + ["w1"] * 36).encode()) == 2
    assert own_mask(" ".join(words[:49]).encode()) == 1
    lower = " ".join(words).encode()
    upper = (len(lower) * 5) // 95
    assert own_mask(lower + b"A" * upper) == 0 and own_mask(lower + b"A" * (upper + 1)) == 4
