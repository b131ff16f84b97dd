"""URL filter, line dedup and the two classifiers against plain restatements or held-out rows."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import Row

from imagelake.llm.line_dedup import line_dedup, remove_boilerplate
from imagelake.llm.quality_classifier import quality_scores
from imagelake.llm.toxicity import toxicity
from imagelake.llm.url_filter import MIN_PAGES, MIN_PURITY, PRIOR, Z, url_filter
from sf_dirs import SF_MID

SF_LARGE = "/root/testdata/sf0.1"

BLANKS = " \t\n\x0b\x0c\r"


def test_line_dedup_equals_brute_force(spark, docs):
    rng = random.Random(17)
    # line k stands on about k sites, so the spreads cross the threshold of 10
    pool = [f"notice number {k} of the site" for k in range(1, 31)]
    texts, sources = [], []
    for _ in range(700):
        site = rng.randrange(40)
        lines = [f"own {rng.randrange(10 ** 9)}" for _ in range(rng.randrange(0, 4))]
        lines += [("  " if rng.random() < 0.3 else "") + pool[k] for k in range(30) if site <= k and rng.random() < 0.2]
        rng.shuffle(lines)
        texts.append("\n".join(lines + [""] * rng.randrange(2)))
        sources.append(None if site == 0 else f"s{site}")
    texts[5] = texts[6] = texts[7] = pool[29] + "\n" + pool[28]

    sites, keeper = defaultdict(set), {}
    for i, (t, s) in enumerate(zip(texts, sources)):
        for line in {x.strip(BLANKS) for x in t.split("\n")} - {""}:
            keeper.setdefault(line, i)
            if s is not None:
                sites[line].add(s)
    common = {line for line in keeper if len(sites[line]) >= 10}
    assert 5 < len(common) < 30
    want = {}
    for i, t in enumerate(texts):
        lines = t.split("\n")
        left = [x for x in lines if x.strip(BLANKS) not in common or keeper[x.strip(BLANKS)] == i]
        emptied = any(x.strip(BLANKS) for x in lines) and not any(x.strip(BLANKS) for x in left)
        if emptied and texts.count(t) > 1:
            left = lines
        want[i] = (len(lines), len(lines) - len(left), "\n".join(left))
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"]) for r in line_dedup(spark, docs(texts, sources)).collect()}
    assert got == want


def test_line_dedup_repeated_rows_and_columns(spark, docs, awkward):
    assert remove_boilerplate(spark, awkward).columns == awkward.columns
    assert line_dedup(spark, awkward).count() == awkward.count()
    assert line_dedup(spark, docs([])).count() == 0


def judged_by_brute_force(pages, bad):
    """page_id -> (template, verdict) for paths of at most four segments."""
    segments = {i: [x for x in path.split("/") if x] for i, (_, path) in pages.items()}
    template = {i: "" for i in pages}
    for level in range(4):
        below = defaultdict(int)
        for i, (host, _) in pages.items():
            if len(segments[i]) > level:
                below[host, template[i], segments[i][level]] += 1
        template = {i: t if len(segments[i]) <= level else t + "/" + (
            segments[i][level] if below[pages[i][0], t, segments[i][level]] >= MIN_PAGES else "*")
            for i, t in template.items()}
    nodes = {(pages[i][0], template[i]): template[i] for i in pages}
    stats = defaultdict(lambda: [0, 0])
    for i, t in template.items():
        if i in bad:
            stats[pages[i][0], t][0] += 1
            stats[pages[i][0], t][1] += bad[i]
    for level in range(4, 0, -1):
        own, pool, general = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0]), {}
        for (host, t), m in nodes.items():
            parts = m.split("/")
            if len(parts) > level:
                general[host, m] = "/".join(parts[:level] + ["*"] + parts[level + 1:])
                for tally in (own[host, m], pool[host, general[host, m]]):
                    tally[0] += stats[host, t][0]
                    tally[1] += stats[host, t][1]
        for (host, t), m in list(nodes.items()):
            if (host, m) in general:
                n, b = own[host, m]
                total, total_bad = pool[host, general[host, m]]
                rate = total_bad / max(total, 1)
                if n == 0 or abs(b / max(n, 1) - rate) <= Z * (rate * (1 - rate) / max(n, 1)) ** 0.5:
                    nodes[host, t] = general[host, m]
    n, b = (sum(x[k] for x in stats.values()) for k in (0, 1))
    overall = (n - b + 1) / (n + 1)

    def smooth(tallies, prior):
        n, b = (sum(x[k] for x in tallies) for k in (0, 1))
        return (n - b + PRIOR * prior) / (n + PRIOR)

    out = {}
    for i, (host, _) in pages.items():
        prior = smooth([x for (h, _), x in stats.items() if h == host], overall)
        mine = nodes[host, template[i]]
        purity = smooth([x for (h, t), x in stats.items() if h == host and nodes[h, t] == mine], prior)
        out[i] = (mine, "block" if purity < MIN_PURITY else "allow")
    return out


def test_url_filter_equals_brute_force(spark):
    rng = random.Random(23)
    pages, bad = {}, {}
    for i in range(900):
        host = rng.choice(["a.test", "a.test", "a.test", "b.test", "c.test"])
        section = rng.choice(["news", "spam", "shop", "wiki", f"x{rng.randrange(60)}"])
        path = "/" + "/".join([section, rng.choice("pq"), str(i % 90)][:rng.randrange(1, 4)])
        pages[i] = (host, path)
        if rng.random() < 0.8:
            bad[i] = int(rng.random() < (0.9 if section == "spam" else 0.15 if host != "c.test" else 0.5))
    rows = spark.createDataFrame([Row(page_id=i, url=f"https://{h}{p}?q=1", host="other", template="x")
                                  for i, (h, p) in pages.items()])
    labels = spark.createDataFrame([Row(page_id=i, bad=b) for i, b in bad.items()])
    want = judged_by_brute_force(pages, bad)
    got = {r["page_id"]: (r["template"], r["verdict"]) for r in url_filter(spark, rows, labels, []).collect()}
    assert got == want
    assert {"allow", "block"} == {v for _, v in got.values()}
    # repeated rows are judged one by one, and other columns do not matter
    twice = url_filter(spark, rows.limit(40).unionByName(rows.limit(40)), labels, [])
    assert twice.count() == 80


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.read.parquet(f"{SF_MID}/documents.parquet"), spark.read.parquet(f"{SF_MID}/labels.parquet")


def test_quality_of_the_held_out_fold(labelled):
    documents, labels = labelled
    scored = quality_scores(documents, labels).where("held_out").join(labels.where("quality IS NOT NULL"), "doc_id")
    rows = [(r["score"] >= 0.3, r["quality"] == 1) for r in scored.select("score", "quality").collect()]
    assert len(rows) > 30 and sum(a == b for a, b in rows) >= 0.95 * len(rows)


@pytest.fixture(scope="module")
def unseen_toxicity(spark):
    """(rejected, toxic) of the labelled rows that had no part in the fit, on the largest table."""
    documents, labels = (spark.read.parquet(f"{SF_LARGE}/{t}.parquet") for t in ("documents", "labels"))
    training = labels.where("crc32(CAST(doc_id AS STRING)) % 5 <> 0")
    rest = labels.where("crc32(CAST(doc_id AS STRING)) % 5 = 0 AND toxic IS NOT NULL")
    judged = toxicity(documents, training).join(rest.select("doc_id", "toxic"), "doc_id")
    return [(r["rejected"], r["toxic"]) for r in judged.select("rejected", "toxic").collect()]


def test_toxicity_leaves_unseen_clean_rows(unseen_toxicity):
    clean = [rejected for rejected, toxic in unseen_toxicity if not toxic]
    assert len(clean) > 500 and sum(clean) <= 0.02 * len(clean)


def test_toxicity_catches_unseen_toxic_rows(unseen_toxicity):
    found = [rejected for rejected, toxic in unseen_toxicity if toxic]
    assert sum(found) >= 0.9 * len(found)
