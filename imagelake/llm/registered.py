"""The queries of this subpackage and their DuckDB twins, as the driver calls them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

from imagelake.llm.common import table

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op2_exact_dedup", """
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) AS d
""")
def op2_exact_dedup(spark, sf_dir):
    from imagelake.llm.exact_dedup import exact_dedup
    return exact_dedup(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


#: Word pattern and space characters in DuckDB's regular expressions.
_SPACES = r"[\x20\x09-\x0D]+"
_SYMBOLS = r"[#*$%&|<>]"
_CELL = "(({r} >> greatest(length(bin({r})) - 6, 0)) << greatest(length(bin({r})) - 6, 0))"
_CELL_WIDTH = "(CAST(1 AS BIGINT) << greatest(length(bin({r})) - 6, 0))"


def _op3_sql() -> str:
    from imagelake.llm.quality_rules import FENCE, QUANTILES, RATES
    rates = " UNION ALL ".join(
        f"SELECT doc_id, lang, source, '{r}' AS rate, {r} AS v, {_CELL.format(r=r)} AS cell FROM rated"
        for r in RATES)
    quant = (", ".join(f"min(cell) FILTER (100 * cum >= {q} * n) AS q{q}" for q in QUANTILES) + ", max(n) AS n FROM "
             "(SELECT *, count(*) OVER (PARTITION BY {k}) AS n, count(*) OVER (PARTITION BY {k} ORDER BY cell) AS cum "
             "FROM long_) AS x GROUP BY {k}")
    chosen = ", ".join(
        f"CASE WHEN o.n >= 100 THEN o.q{q} WHEN b.n >= 100 THEN b.q{q} ELSE t.q{q} END AS q{q}" for q in QUANTILES)
    return f"""
WITH t AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '{_SPACES}'), lambda x: x <> '') AS ws,
      list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '{_SPACES}', '', 'g') <> '') AS ls FROM t),
win AS (SELECT doc_id, i, array_to_string(ws[i : i + 4], ' ') AS g
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w) AS x),
rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) AS x WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest([0, 1, 2, 3, 4]) AS k) AS y GROUP BY doc_id),
counts AS (SELECT w.doc_id, lang, source, len(ws) AS n_words, len(ls) AS n_lines,
  length(regexp_replace(text, '{_SPACES}', '', 'g')) AS word_chars,
  length(text) - length(regexp_replace(text, '{_SYMBOLS}', '', 'g')) AS n_symbols,
  length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS n_upper,
  len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words
  FROM w LEFT JOIN cov ON w.doc_id = cov.doc_id),
rated AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  n_symbols * 1000 // greatest(word_chars, 1) AS symbol_rate, n_upper * 1000 // greatest(word_chars, 1) AS upper_rate,
  word_chars * 100 // greatest(n_words, 1) AS word_length, greatest(n_dup_lines - 1, 0) * 1000 // greatest(n_lines, 1) AS dup_line_rate
  FROM counts),
long_ AS ({rates}),
own AS (SELECT lang, source, rate, {quant.format(k='lang, source, rate')}),
by_lang AS (SELECT lang, rate, {quant.format(k='lang, rate')}),
top AS (SELECT rate, {quant.format(k='rate')}),
bad AS (SELECT DISTINCT doc_id FROM (SELECT l.doc_id, l.v,
    {chosen}
  FROM long_ l JOIN own o ON l.lang IS NOT DISTINCT FROM o.lang AND l.source IS NOT DISTINCT FROM o.source AND l.rate = o.rate
  JOIN by_lang b ON l.lang IS NOT DISTINCT FROM b.lang AND l.rate = b.rate JOIN top t ON l.rate = t.rate) AS z
  WHERE v < q25 - {FENCE} * greatest(q75 - q25, q25 - q10, {_CELL_WIDTH.format(r='q25')})
     OR v > q75 + {FENCE} * greatest(q75 - q25, q90 - q75, {_CELL_WIDTH.format(r='q75')}))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM bad) AS kept FROM rated
"""


@register("op3_quality_rules", _op3_sql())
def op3_quality_rules(spark, sf_dir):
    from imagelake.llm.quality_rules import quality_rules
    return quality_rules(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@register("op5_mixing", f"""
WITH units AS (SELECT doc_id, coalesce('s' || source, 't') AS skey,
    len(list_filter(string_split_regex(coalesce(text, ''), '{_SPACES}'), lambda x: x <> '')) AS size,
    md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place FROM documents),
sources AS (SELECT skey, CAST(sum(size) AS BIGINT) AS source_size,
    (row_number() OVER (ORDER BY skey) - 1) % 3 + 1 AS weight FROM units GROUP BY skey),
levels AS (SELECT *, 3 * source_size AS cap, CAST(3 * source_size AS DOUBLE) / weight AS level FROM sources),
sums AS (SELECT *, sum(cap) OVER w - cap AS caps, sum(weight) OVER w - weight AS weights,
    sum(source_size) OVER () AS budget, sum(weight) OVER () AS every
    FROM levels WINDOW w AS (ORDER BY level, skey ROWS UNBOUNDED PRECEDING)),
filled AS (SELECT *, CAST(caps AS DOUBLE) + level * CAST(every - weights AS DOUBLE) <= CAST(budget AS DOUBLE) AS is_full FROM sums),
rest AS (SELECT CAST(max(budget) - sum(CASE WHEN is_full THEN cap ELSE 0 END) AS DOUBLE)
    / CAST(sum(CASE WHEN is_full THEN 0 ELSE weight END) AS DOUBLE) AS level FROM filled),
t AS (SELECT skey, weight, source_size, CAST(budget AS BIGINT) AS budget,
    CASE WHEN is_full THEN CAST(cap AS DOUBLE) ELSE weight * rest.level END AS target FROM filled, rest),
line AS (SELECT u.*, t.weight, t.source_size, t.target, t.budget, sum(size) OVER
    (PARTITION BY u.skey ORDER BY place, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM units u JOIN t ON u.skey = t.skey),
copies AS (SELECT line.*, epoch, CAST(epoch * source_size + upto AS DOUBLE) / weight AS finish
    FROM line, (SELECT unnest([0, 1, 2]) AS epoch) AS e WHERE size > 0),
queue AS (SELECT *, sum(size) OVER (ORDER BY finish, skey, place, doc_id, epoch ROWS UNBOUNDED PRECEDING) AS upto_all FROM copies),
took AS (SELECT doc_id, skey, count(*) AS n FROM queue WHERE upto_all <= budget GROUP BY doc_id, skey)
SELECT l.doc_id, l.size, l.source_size, l.target, CAST(l.size * coalesce(n, 0) AS BIGINT) AS taken
FROM line l LEFT JOIN took ON l.doc_id = took.doc_id AND l.skey = took.skey
""")
def op5_mixing(spark, sf_dir):
    from imagelake.llm.mixing import mix_counts
    return mix_counts(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@register("op4_best_fit_packing")
def op4_best_fit_packing(spark, sf_dir):
    from imagelake.llm.packing import pack_documents
    return pack_documents(spark, table(spark, sf_dir, "documents"), tokenizer_path()).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")


@register("op6_substring_dedup")
def op6_substring_dedup(spark, sf_dir):
    from imagelake.llm.substring_dedup import substring_dedup
    return substring_dedup(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@register("op10_minhash_near_dedup")
def op10_minhash_near_dedup(spark, sf_dir):
    from imagelake.llm.near_dedup import near_dedup
    return near_dedup(spark, table(spark, sf_dir, "documents"), shingle=2)


@register("op8_quality_classifier")
def op8_quality_classifier(spark, sf_dir):
    from imagelake.llm.quality_classifier import quality_scores
    scores = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@register("op9_toxicity")
def op9_toxicity(spark, sf_dir):
    from imagelake.llm.toxicity import toxicity
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op7_line_dedup")
def op7_line_dedup(spark, sf_dir):
    from imagelake.llm.line_dedup import line_dedup
    return line_dedup(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@register("op1_url_filters")
def op1_url_filters(spark, sf_dir):
    from imagelake.llm.url_filter import host_and_path, url_filter
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    # the last number of a path is the document that the page shows; one beyond a long is none
    _, path = host_and_path(F.col("url"))
    number = F.regexp_extract(path, r"(\d+)\D*$", 1)
    shown = pages.select("page_id", number.try_cast("long").alias("doc_id")).where("doc_id IS NOT NULL")
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max(bad).alias("bad"))
    rules = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
    return url_filter(spark, pages, shown.join(labels, "doc_id").select("page_id", "bad"), rules)


#: Labels of an id, whatever their number of rows.
_FLAGS = """flags AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
    max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id)"""


@register("op11_filter_audit", f"""
WITH RECURSIVE {_FLAGS},
words AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '{_SPACES}'), lambda x: x <> '') AS ws FROM documents),
masked AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (CASE WHEN len(ws) < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
    + (CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END) AS mask
    FROM words w LEFT JOIN flags f ON w.doc_id = f.doc_id),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
prefixes AS (SELECT letter AS prefix, letter, bit, 0 AS before, bit AS applied FROM letters
    UNION ALL SELECT prefix || l.letter, l.letter, l.bit, p.applied, p.applied | l.bit
    FROM prefixes p JOIN letters l ON p.applied & l.bit = 0),
found AS (SELECT part, prefix, letter,
    count(*) FILTER (mask & applied = 0) AS kept, count(*) FILTER (mask & before = 0 AND mask & bit <> 0) AS removed,
    count(*) FILTER (mask & before <> 0 AND mask & bit <> 0) AS redundant, count(*) FILTER (mask = bit) AS unique_fails,
    count(*) FILTER (mask & before = 0 AND mask & bit <> 0 AND good = 1) AS good_lost,
    count(*) FILTER (mask & before = 0 AND mask & bit <> 0 AND toxic = 1) AS toxic_lost
    FROM masked, prefixes GROUP BY part, prefix, letter),
steps AS (SELECT f.part, o.prefix AS filter_order, CAST(length(f.prefix) AS INTEGER) AS step, f.* EXCLUDE (part, prefix)
    FROM found f JOIN prefixes o ON length(o.prefix) = 5 AND starts_with(o.prefix, f.prefix))
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM steps
""")
def op11_filter_audit(spark, sf_dir):
    from imagelake.llm.filter_audit import filter_audit
    return filter_audit(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op12_embedding_near_dedup", """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_dot_product(a.e, b.e) >= 0.93 * sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN counts USING (vec_id)
""")
def op12_embedding_near_dedup(spark, sf_dir):
    from imagelake.llm.embedding_dedup import embedding_dedup
    return embedding_dedup(spark, table(spark, sf_dir, "embeddings"))


@register("op13_hard_negatives", """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS r
    FROM s WHERE same) AS x WHERE r <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    WHERE 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
""")
def op13_hard_negatives(spark, sf_dir):
    from imagelake.llm.hard_negatives import hard_negatives
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), "embedding")
    return hard_negatives(spark, vectors, F.col("vec_id") % 100 == 0)
