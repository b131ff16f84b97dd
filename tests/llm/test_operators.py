"""Operators against brute force on small tables, and their defined edge cases."""

import random
import re

import pyarrow as pa

from imagelake.llm import registered
from imagelake.llm.exact_dedup import DigestIndex, exact_dedup
from imagelake.llm.common import running_totals, scratch_path
from imagelake.llm.components import components
from imagelake.llm.line_dedup import line_dedup, remove_boilerplate
from imagelake.llm.mixing import mix_counts, mix_documents
from imagelake.llm.near_dedup import near_dedup
from imagelake.llm.packing import pack_documents, plan
from imagelake.llm.quality_classifier import quality_scores
from imagelake.llm.quality_rules import FENCE, RATES, count_features, fences, quality_rules, sketches, with_rates
from imagelake.llm.substring_dedup import substring_dedup
from imagelake.llm.toxicity import toxicity
from imagelake.llm.url_filter import url_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def by_id(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in df.collect()}


def test_exact_dedup_and_index(spark, docs, awkward):
    got = by_id(exact_dedup(spark, docs(["a", "b", "a", None, "", "a"])), "keep_id", "group_size", "kept")
    assert got == {0: (5, 3, False), 1: (1, 1, True), 2: (5, 3, False), 3: (4, 2, False), 4: (4, 2, True), 5: (5, 3, True)}
    assert exact_dedup(spark, awkward).count() == awkward.count()
    assert exact_dedup(spark, docs([])).count() == 0
    index = DigestIndex(spark, "index_under_test", scratch_path(spark, "index"), 4)
    index.add(docs(["a", "b"]))
    later = by_id(index.add(docs(["b", "c"], ids=[10, 11])), "keep_id", "kept")
    assert later == {10: (1, False), 11: (11, True)}
    assert index.read().count() == 3


def test_quality_rules_edges(spark, docs, awkward):
    out = quality_rules(spark, awkward)
    assert out.count() == awkward.count()
    assert not out.where("n_words < 10 AND kept").count()
    assert quality_rules(spark, docs([])).count() == 0
    row = quality_rules(spark, docs(["a b c d e x a b c d e"])).first()
    assert (row["n_words"], row["n_repeat_words"], row["base_failed"]) == (11, 10, True)


def test_quality_fences_follow_their_group(spark, docs):
    rng = random.Random(11)
    text = lambda symbols: " ".join(f"w{i}" for i in rng.sample(range(1000, 2000), 40)) + " " + "#" * symbols
    # source a holds code with 10 to 20 symbols a text, source b prose with none
    texts = [text(rng.randrange(10, 21)) for _ in range(150)] + [text(0) for _ in range(150)]
    probes = [text(18), text(90), text(18)]
    d = docs(texts + probes, ["a"] * 150 + ["b"] * 150 + ["a", "a", "b"])
    verdicts = by_id(quality_rules(spark, d), "adaptive_failed", "symbol_rate")
    assert [verdicts[300 + i][0] for i in range(3)] == [False, True, True]
    assert not any(verdicts[i][0] for i in range(300))

    # the fences against the definition: quartiles and outer deciles of the sketch cells
    rated = with_rates(count_features(d)).collect()
    (a,) = [r for r in fences(sketches(with_rates(count_features(d)))).collect() if r["source"] == "a"]
    for rate in RATES:
        kept_bits = lambda v: max(v.bit_length() - 6, 0)
        cells = sorted(r[rate] >> kept_bits(r[rate]) << kept_bits(r[rate]) for r in rated if r["source"] == "a")
        q10, q25, q75, q90 = (cells[-(-q * len(cells) // 100) - 1] for q in (10, 25, 75, 90))
        below = max(q75 - q25, q25 - q10, 1 << kept_bits(q25))
        above = max(q75 - q25, q90 - q75, 1 << kept_bits(q75))
        assert (a[f"lo_{rate}"], a[f"hi_{rate}"]) == (q25 - FENCE * below, q75 + FENCE * above)


def test_mixing_targets(spark, docs, awkward):
    rng = random.Random(3)
    d = docs([prose(rng, rng.randrange(1, 40)) for _ in range(600)], [rng.choice("aabbbbbbbbc") for _ in range(600)])
    out = mix_counts(spark, d).collect()
    total = sum(r["size"] for r in out)
    for s in "abc":
        mine = [r for r in out if r["source"] == s]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 80
        assert all(r["taken"] <= 3 * r["size"] for r in mine)
    assert total - 80 <= sum(r["taken"] for r in out) <= total
    assert sorted(map(tuple, out)) == sorted(map(tuple, mix_counts(spark, d).collect()))
    assert mix_counts(spark, docs([])).count() == 0
    assert mix_documents(spark, awkward).columns == awkward.columns
    assert mix_counts(spark, awkward).count() == awkward.count()


def test_mixing_returns_each_repeated_row(spark, docs):
    repeated = docs(["one two three"] * 3 + ["four five"], ["a"] * 4, [1, 1, 1, None])
    out = sorted((r["size"], r["source_size"], r["copies"], r["taken"]) for r in mix_counts(spark, repeated).collect())
    assert out == [(2, 11, 1, 2)] + [(3, 11, 1, 3)] * 3
    assert mix_documents(spark, repeated).count() == 4


def test_packing_plan_and_pieces(spark, docs, awkward):
    rng = random.Random(5)
    histogram = {rng.randrange(1, 101): rng.randrange(1, 300) for _ in range(60)}
    rows, used = plan(histogram, 100), {}
    for n, c in histogram.items():
        assert sum(hi - lo for m, lo, hi, *_ in rows if m == n) == c
    for n, lo, hi, first, offset, per in rows:
        for r in range(hi - lo):
            used.setdefault(first + r // per, []).append((offset + r % per * n, n))
    for places in used.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 100
    assert len(used) <= 1.05 * -(-sum(n * c for n, c in histogram.items()) // 100) + 1
    out = pack_documents(spark, awkward, registered.tokenizer_path(), with_ids=True).collect()
    assert {r["doc_id"] for r in out} == {1, 2, 3, 4, 5, 7, None}
    assert all(len(r["ids"]) == 4 * r["length"] for r in out)
    assert pack_documents(spark, docs([]), registered.tokenizer_path()).count() == 0


def test_pieces_are_the_tokenizers_ids(spark, docs):
    from tokenizers import Tokenizer
    import numpy as np
    texts = ["Don't stop, ΑΣ Σ. Éá ﬁne!! x.y <|endoftext|>abc 12 34th  b c\x1cd", "Hello, WORLD... it's o'clock?!"]
    tok = Tokenizer.from_file(registered.tokenizer_path())
    got = {r["doc_id"]: bytes(r["ids"]) for r in pack_documents(spark, docs(texts), registered.tokenizer_path(), with_ids=True).collect()}
    for i, t in enumerate(texts):
        assert got[i] == np.asarray(tok.encode(t, add_special_tokens=False).ids + [0], "<u4").tobytes()


def test_letters_of_several_tokenizer_words_shift_no_ids(spark, docs):
    from tokenizers import Tokenizer
    import numpy as np
    texts = ["hello, \u0130stanbul, world, again", "world again \u0130. a\u0130! \u0915\u0958\u0915 \u09dc\u0995, \ufb2a? hello", "again, world"]
    tok = Tokenizer.from_file(registered.tokenizer_path())
    got = {r["doc_id"]: bytes(r["ids"]) for r in pack_documents(
        spark, docs(texts).coalesce(1), registered.tokenizer_path(), with_ids=True).collect()}
    for i, t in enumerate(texts):
        assert got[i] == np.asarray(tok.encode(t, add_special_tokens=False).ids + [0], "<u4").tobytes()


def test_plain_letters_have_the_tokenizers_ids(monkeypatch):
    from tokenizers import Tokenizer
    import numpy as np
    from imagelake.llm import packing
    from imagelake.llm.common import Recent
    rng = random.Random(6)
    letters = [chr(c) for c in range(0x260) if chr(c).isalpha()] + ["\u0130", "\u03a3", "\u1e9e"]
    assert packing.is_plain("\u00c9paule") and not any(map(packing.is_plain, ["", "a1", "\u0130a", "a\u03a3", "a\u0301", "x."]))
    words = ["".join(rng.choices(rng.choice([letters, "etaoinshrdlu"]), k=rng.randrange(1, 12))) + rng.choice(["", ".", "!?"]) for _ in range(3000)]
    text = " ".join(words + [c + "a" for c in letters])
    tok = Tokenizer.from_file(registered.tokenizer_path())
    seen = []
    whole = Tokenizer.encode
    want = np.asarray(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    class Counted:
        def __init__(self, tok):
            self.model, self.tok = tok.model, tok

        def encode(self, text, **kw):
            seen.append(text)
            return whole(self.tok, text, **kw)

    import tokenizers
    monkeypatch.setattr(tokenizers, "Tokenizer", type("T", (), {"from_file": staticmethod(lambda p: Counted(tok))}))
    packing.run_encoder.cache_clear()
    try:
        encode = packing.run_encoder(registered.tokenizer_path())
        seen.clear()
        assert encode([text.encode()], Recent(10 ** 6), Recent(10 ** 6)) == [want]
        assert not any(packing.is_plain(p) for t in seen for p in t.split(" "))  # those went to the model
    finally:
        packing.run_encoder.cache_clear()


def test_runs_are_looked_up_in_columns_not_one_by_one():
    from tokenizers import Tokenizer
    import numpy as np
    from imagelake.llm import packing
    from imagelake.llm.common import Recent

    class Columns(Recent):
        def get(self, key):
            raise AssertionError("a single lookup")
        put = get_all = get

    rng = random.Random(8)
    words = ["".join(rng.choices(rng.choice(["etaoinshr", "\u00e9\u00c0\u00dfaT", "\u0130\u0915\u0958x", "a1'|"]), k=rng.randrange(1, 5)))
             + rng.choice(["", "", ".", "$$$"]) for _ in range(400)]
    tok = Tokenizer.from_file(registered.tokenizer_path())
    encode = packing.run_encoder(registered.tokenizer_path())
    for size in (1, 7, 10 ** 6):
        caches = Columns(size), Columns(size)
        for _ in range(4):
            texts = ["", " \t\n", *(rng.choice(["", " "]) + rng.choice([" ", "\n\t"]).join(rng.choices(words, k=n)) + rng.choice(["", "\n"]) for n in (0, 1, 50, 200)), ""]
            assert encode([t.encode() for t in texts], *caches) == [
                np.asarray(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
            assert all(len(c.columns[0]) == len(c.columns[1]) == len(c.columns[0].unique()) <= 2 * size for c in caches)
        assert encode([], *caches) == [] and encode([b""] * 2, *caches) == [b""] * 2
    latest = Recent(2)
    for keys in ("ab", "cd", "be"):
        latest.put_column(pa.array(list(keys), pa.large_string()), pa.array([k.encode() for k in keys], pa.large_binary()))
    assert latest.get_column(pa.array(list("abcdef"), pa.large_string())).to_pylist() == [None, b"b", b"c", b"d", b"e", None]


def test_batches_of_short_texts_are_taken_together():
    from imagelake.llm.packing import grouped
    batches = [pa.RecordBatch.from_pydict({"doc_id": [i, i], "text": [t, None]}) for i, t in enumerate(["x" * 10] * 30 + ["y" * 5000, "z"])]
    groups = list(grouped(iter(batches), 1000))
    assert pa.concat_tables(groups).equals(pa.Table.from_batches(batches)) and len(groups) <= 4
    assert list(grouped(iter([]), 1000)) == []


def test_substring_dedup_brute_force(spark, docs, awkward):
    rng = random.Random(7)
    passages = [prose(rng, n) for n in (49, 50, 51, 120)]
    texts = [" ".join(rng.choice([prose(rng, rng.randrange(0, 70)), rng.choice(passages)]) for _ in range(4)) for _ in range(80)]
    got = by_id(substring_dedup(spark, docs(texts)), "n_words", "n_removed", "kept_text")
    first = {}
    for i, t in enumerate(texts):
        w, gone = WORD.findall(t), set()
        windows = [tuple(w[p:p + 50]) for p in range(len(w) - 49)]
        for p, x in enumerate(windows):
            if first.setdefault(x, i) < i:
                gone |= set(range(p, p + 50))
        assert got[i] == (len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone))
    assert substring_dedup(spark, awkward).count() == awkward.count()
    assert substring_dedup(spark, docs([])).count() == 0


def test_substring_dedup_keeps_runs_apart_without_id(spark, docs):
    rng = random.Random(17)
    passage, mine, other = (prose(rng, 80, 10 ** 6) for _ in range(3))
    texts = [passage, f"start {passage}", other, f"{mine} {passage}"]
    rows = substring_dedup(spark, docs(texts, ids=[1, None, None, None])).collect()
    assert sorted(r["kept_text"] for r in rows) == sorted([passage, "start", other, mine])


def test_substring_dedup_sends_one_row_per_destination(spark):
    import numpy as np
    import pyarrow as pa
    from imagelake.llm import substring_dedup as sd
    n, buckets, spread = 6000, 40, 7
    rows, bucket = np.arange(n), np.arange(n) % buckets
    sent = sd.routed(bucket, spread, rows, rows, np.full(n, 3), [np.zeros(n, np.uint64)], (rows[:50], np.full(50, 9)))
    table = pa.Table.from_batches([sent]).sort_by([("bucket", "ascending"), ("kind", "ascending")])
    out = list(sd.settled_runs(iter(table.to_batches()), ["u8"], lambda ids, key: np.arange(len(ids)), spread))
    assert sum(b.num_rows for b in out) == spread  # not buckets x spread
    runs = {x for b in out for p in b.column("payload") for x in zip(*(c.tolist() for c in sd.unpacked_runs(p.as_py())))}
    assert runs == {(i, 3, 4) for i in range(n)} | {(i, 9, 10) for i in range(50)}


def test_substring_dedup_never_broadcasts_runs(spark, docs):
    from imagelake.llm import substring_dedup as sd
    runs = spark.createDataFrame([(1, [0], [1])], sd.RUNS)
    rows = docs(["a", "b"]).withColumnRenamed("doc_id", "row").select("row", "text")
    for how in ("inner", "left"):
        joined = sd.with_runs(rows, runs, how)
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_line_dedup(spark, docs, awkward):
    line = "all rights reserved by us"
    texts = [f"{line}\nown words of number {i}" for i in range(12)]
    got = by_id(line_dedup(spark, docs(texts, [f"s{i}" for i in range(12)])), "n_removed", "text")
    assert got[0] == (0, texts[0])
    assert all(got[i] == (1, f"own words of number {i}") for i in range(1, 12))
    few = line_dedup(spark, docs(texts, [f"s{i % 9}" for i in range(12)]))
    assert few.where("n_removed > 0").count() == 0
    kept = remove_boilerplate(spark, docs([line] * 12, [f"s{i}" for i in range(12)]))
    assert [r["text"] for r in kept.collect()] == [line] * 12
    assert remove_boilerplate(spark, awkward).count() == awkward.count()
    assert line_dedup(spark, docs([])).count() == 0


def test_line_dedup_of_short_lines_and_boilerplate_pages(spark, docs):
    lines = ["Read more", "all rights reserved by us", "home about contact help", "Share this"]
    texts = ["\n".join(lines)] + ["\n".join([*rng.sample(lines, 4), ""] * (1 + i)) for i, rng in enumerate(map(random.Random, range(12)))]
    texts += ["Read more\nown words of number one", "Read more\nShare this", "Read more\nShare this"]
    got = by_id(line_dedup(spark, docs(texts, [f"s{i}" for i in range(16)])), "n_removed", "text")
    assert got[0] == (0, texts[0])
    assert all(got[i][0] == 4 * i and not got[i][1].strip() for i in range(1, 13))
    assert got[13] == (1, "own words of number one")
    assert got[14] == got[15] == (0, "Read more\nShare this")


def test_near_dedup_brute_force(spark, docs, awkward):
    rng = random.Random(11)
    base = [prose(rng, 120) for _ in range(6)]
    texts = []
    for _ in range(70):
        w = rng.choice(base).split()
        for _ in range(rng.randrange(0, 12)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10 ** 6)}"
        texts.append(" ".join(w))
    texts += ["a", "A", "a b", None]
    sets = [frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset([tuple(w)] if w else []) for w in
            (WORD.findall((t or "").lower()) for t in texts)]
    part = list(range(len(texts)))
    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= 80 * len(x | sets[j]) and part[i] != part[j]:
                lo, hi = sorted((part[i], part[j]))
                part = [lo if p == hi else p for p in part]
    got = by_id(near_dedup(spark, docs(texts), shingle=2), "n_shingles", "component_id", "kept")
    assert got == {i: (len(x), part[i], part[i] == i) for i, x in enumerate(sets)}
    assert near_dedup(spark, awkward).count() == awkward.count()
    assert near_dedup(spark, docs([])).count() == 0


def test_rows_without_id_are_judged_one_by_one(spark, docs, tmp_path):
    import corpus_pipeline
    rng = random.Random(13)
    a, b, c = (prose(rng, 60) for _ in range(3))
    texts, ids = [a, a, b, c, b + " end", c, "x y"], [1, None, None, None, None, 9, 9]
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0, r["kept"]) for r in near_dedup(
        spark, docs(texts, ids=ids), shingle=2).collect())
    assert sum(r[3] for r in got) == 4 and [r[2] for r in got if r[0] == 0].count(1) == 1
    left = corpus_pipeline.drop_near_duplicates(spark, docs(texts, ids=ids), str(tmp_path))
    rows = sorted((r["doc_id"] or 0, r["text"]) for r in left.collect())
    assert len(rows) == 4 and {(1, a), (9, c), (9, "x y")} < set(rows) and rows[0][1] in (b, b + " end")
    units = mix_counts(spark, docs([a, b, a, None], ids=[None, None, 3, None])).collect()
    assert sorted(r["size"] for r in units) == [0, 60, 60, 60]
    # an id-less toxic row takes no other id-less row with it
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    texts = [prose(rng, 40) + (" vile scoundrel" * 8 if i % 2 else "") for i in range(42)]
    left = corpus_pipeline.drop_toxic(spark, docs(texts, ids=[*range(40), None, None]), str(tmp_path))
    assert [r["text"] for r in left.where("doc_id IS NULL").collect()] == [texts[40]]


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 200)]
    got = {r["node"]: r["component"] for r in components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}


def test_running_totals(spark):
    rng = random.Random(1)
    values = [(rng.randrange(50), i, rng.randrange(9)) for i in range(500)]
    df = spark.createDataFrame(values, "o int, i int, v long")
    got = [r["total"] for r in running_totals(spark, df, ["o", "i"], {"total": "v"}, "t", 7).orderBy("o", "i").collect()]
    at, want = 0, []
    for _, _, v in sorted(values):
        at += v
        want.append(at)
    assert got == want


def test_classifiers(spark, docs, awkward):
    rng = random.Random(2)
    texts = [prose(rng, 60) + (" vile scoundrel" * 8 if i % 3 == 0 else "") for i in range(240)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0), int(i % 3 == 0)) for i in range(240)], "doc_id long, quality int, toxic int")
    d = docs(texts)
    out = by_id(toxicity(d, labels), "severity", "rejected")
    assert sum(out[i][1] == (i % 3 == 0) for i in range(240)) >= 235
    held = [r for r in quality_scores(d, labels).collect() if r["held_out"]]
    assert held and sum((r["score"] >= 0.5) == (r["doc_id"] % 3 == 0) for r in held) >= 0.9 * len(held)
    none = labels.where("false")
    for f in (toxicity, quality_scores):
        assert f(awkward, labels).count() == awkward.count()
        assert f(awkward, none).count() == awkward.count()
        assert f(docs([]), labels).count() == 0


def test_words_are_weighed_many_at_once():
    import numpy as np
    from imagelake.llm import quality_classifier, toxicity as tox, word_models as wm
    rng = random.Random(4)
    odd = [b"", b"a", b"ab", b"abc", b"\x01again", "é".encode(), "Èonai".encode(), "ñ😀x日本".encode(), b"z" * 5000, "e\u0301".encode()]
    words = odd + ["".join(rng.choices("abcdeéüß-.,$", k=rng.randrange(1, 14))).encode() for _ in range(2000)]
    for some in (words, [b"x"], words + [b"caf\xe9", b"\xff\xfe"]):  # the last are not UTF-8
        features, sizes = wm.many_ngrams(some, (3, 4, 6), 1 << 22)
        each = [wm.ngrams(w, (3, 4, 6), 1 << 22) for w in some]
        assert sizes.tolist() == [len(x) for x in each] and features.tolist() == [f for x in each for f in x]
    weights = np.random.default_rng(1).normal(size=wm.BUCKETS).astype(np.float32)
    assert quality_classifier.weigh(weights, words) == [float(weights[wm.ngrams(w, quality_classifier.SIZES)].mean()) for w in words]
    some = {f: rng.uniform(-1, 1) for w in words[::3] for f in wm.ngrams(w, tox.SIZES, tox.BUCKETS)}
    assert list(tox.weigh(some, words)) == [sum(some.get(f, 0.0) for f in wm.ngrams(w, tox.SIZES, tox.BUCKETS)) for w in words]


def test_url_filter(spark):
    urls = [f"http://bad.example.org/spam/{i}" for i in range(60)] + [f"http://bad.example.org/news/{i}" for i in range(60)] + [
        "HTTP://A.NET/x?y", "http://b.net", None, "no url", "https://c.example.net/en/1", "http://D.example.com/de/2#t"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(120)], "page_id long, bad int")
    rules = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
    got = {r["page_id"]: r for r in url_filter(spark, pages, labels, rules).collect()}
    assert len(got) == len(urls)
    assert {got[i]["verdict"] for i in range(60)} == {"block"} and got[0]["template"] == "/spam/*"
    assert {got[i]["verdict"] for i in range(60, 120)} == {"allow"}
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"]) for i in range(120, 126)] == [
        ("a.net", "/x", "net/"), ("b.net", "", None), ("", "", None), ("", "", None),
        ("c.example.net", "/en/1", "example.net/en/"), ("d.example.com", "/de/2", "example.com/de/")]
    assert [got[i]["verdict"] for i in (120, 124, 125)] == ["block", "allow", "block"]
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter(spark, empty, labels, rules).count() == 0


def test_url_filter_judges_small_sections_of_a_large_host(spark):
    urls = [f"http://big.example.org/s{i % 100}/{i}" for i in range(2000)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i % 100 == 7)) for i in range(2000)], "page_id long, bad int")
    got = {r["page_id"]: r["verdict"] for r in url_filter(spark, pages, labels, []).collect()}
    assert got == {i: "block" if i % 100 == 7 else "allow" for i in range(2000)}


def test_url_filter_judges_deep_paths(spark):
    urls = [f"http://deep.example.org/a/b/c/d/e/f/{'spam' if i % 2 else 'news'}/{i}" for i in range(120)]
    urls += ["http://deep.example.org/a/b/c/d/x/y/z", "http://deep.example.org/a/b/c/d"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "page_id long, bad int")
    got = {r["page_id"]: r for r in url_filter(spark, pages, labels, []).collect()}
    assert [got[i]["verdict"] for i in range(120)] == ["allow", "block"] * 60
    assert len(got) == 122 and "/spam/" in got[1]["template"]
    assert got[120]["template"].endswith("/**") and got[121]["template"].count("/") == 4


def test_pipeline_stages(spark, awkward, tmp_path):
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mixing", "packing"]
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = awkward
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == awkward.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() > 0
