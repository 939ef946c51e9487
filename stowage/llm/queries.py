"""One query for each operator, and SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stowage.llm.best_fit_packing import pack_documents
from stowage.llm.collision_counting import near_vectors
from stowage.llm.conversation_repair import damage, digest_repairs, repair_conversations
from stowage.llm.cross_polytope import nearest
from stowage.llm.fim_frames import digest_outputs, fill_in_middle, store_frames
from stowage.llm.license_scan import BASE, TEMPLATES, scan_licenses, template_regex
from stowage.llm.lm_scoring import score_documents
from stowage.llm.piece_agenda import encode_and_decode
from stowage.llm.prob_minhash import near_duplicates
from stowage.llm.quality_crf import score_quality
from stowage.llm.shared import find_package, scratch_root
from stowage.llm.source_mixing import mix_sources
from stowage.llm.substring_dedup import digest_repeats
from stowage.llm.token_counts import count_tokens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECK_SQL: dict[str, str] = {}

#: Words ``[^\x20\x09-\x0D]+`` of every document, as a list, in DuckDB's SQL.
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def query(check_sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = run
        if check_sql:
            CHECK_SQL[run.__name__] = check_sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(f"""
WITH w AS (
    SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
    FROM (SELECT doc_id, {WORDS} AS ws FROM documents)),
g AS (
    SELECT doc_id, i, w, lag(w, 1) OVER d AS a, lag(w, 2) OVER d AS b
    FROM w WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
n1 AS (SELECT doc_id, w, count(*) AS n, sum(count(*)) OVER (PARTITION BY w) AS t FROM g GROUP BY doc_id, w),
n2 AS (SELECT doc_id, a, w, count(*) AS n, sum(count(*)) OVER (PARTITION BY a, w) AS t
       FROM g WHERE a IS NOT NULL GROUP BY doc_id, a, w),
n3 AS (SELECT doc_id, b, a, w, count(*) AS n, sum(count(*)) OVER (PARTITION BY b, a, w) AS t
       FROM g WHERE b IS NOT NULL GROUP BY doc_id, b, a, w),
per AS (SELECT doc_id, count(*) AS n FROM w GROUP BY doc_id),
s AS (
    SELECT g.doc_id,
        coalesce(n3.t - n3.n, 0) AS c3, coalesce(n2.t - n2.n, 0) AS c2, n1.t - n1.n AS c1,
        m2.t - m2.n AS c2_before, m1.t - m1.n AS c1_before,
        least(g.i - 1, 2) AS k, greatest((SELECT count(*) FROM w) - per.n, 1) AS rest
    FROM g JOIN per ON per.doc_id = g.doc_id
    JOIN n1 ON n1.doc_id = g.doc_id AND n1.w = g.w
    LEFT JOIN n2 ON n2.doc_id = g.doc_id AND n2.a = g.a AND n2.w = g.w
    LEFT JOIN n3 ON n3.doc_id = g.doc_id AND n3.b = g.b AND n3.a = g.a AND n3.w = g.w
    LEFT JOIN n1 AS m1 ON m1.doc_id = g.doc_id AND m1.w = g.a
    LEFT JOIN n2 AS m2 ON m2.doc_id = g.doc_id AND m2.a = g.b AND m2.w = g.a),
l AS (
    SELECT doc_id, CASE WHEN c3 > 0 THEN 3 WHEN c2 > 0 THEN 2 ELSE 1 END AS level,
        CASE WHEN c3 > 0 THEN ln(CAST(c3 AS DOUBLE) / CAST(c2_before AS DOUBLE))
             WHEN c2 > 0 THEN ln(CAST(c2 AS DOUBLE) / CAST(c1_before AS DOUBLE)) + ln(0.4::DOUBLE) * (k - 1)
             ELSE ln(CAST(greatest(c1, 1) AS DOUBLE) / CAST(rest AS DOUBLE)) + ln(0.4::DOUBLE) * k END AS s
    FROM s)
SELECT d.doc_id, CAST(count(l.s) AS BIGINT) AS n_words,
    CAST(count(*) FILTER (l.level = 3) AS BIGINT) AS n_trigrams,
    CAST(count(*) FILTER (l.level = 2) AS BIGINT) AS n_bigrams,
    CAST(count(*) FILTER (l.level = 1) AS BIGINT) AS n_unigrams,
    round(coalesce(sum(l.s), 0.0::DOUBLE), 6) AS log_score, round(avg(l.s), 6) AS mean_log_score
FROM documents d LEFT JOIN l ON l.doc_id = d.doc_id GROUP BY d.doc_id
""")
def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff scores of all documents, each by the counts of all others."""
    return score_documents(table(spark, sf_dir, "documents"))


@query(f"""
WITH d AS (SELECT doc_id, {WORDS} AS ws FROM documents),
win AS (
    SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM d)),
hit AS (
    SELECT DISTINCT doc_id, i + o.j AS i
    FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS least FROM win), range(13) AS o(j)
    WHERE least < doc_id),
kept AS (
    SELECT w.doc_id, string_agg(w.w, ' ' ORDER BY w.i) AS t, count(*) AS n
    FROM (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d) AS w
    ANTI JOIN hit ON hit.doc_id = w.doc_id AND hit.i = w.i GROUP BY w.doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(len(ws) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
""")
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document once passages of earlier ones are removed."""
    return digest_repeats(table(spark, sf_dir, "documents"))


def _license_sql() -> str:
    """Base phrases by comparing lists of words, templates by regular expressions on joined words."""
    phrases = [(p.split(), label) for p, label in BASE.items()]
    places = " + ".join(
        f"len(list_filter(range(1, len(ws) + 1), lambda i: ws[i:i + {len(p) - 1}] = {p}))" for p, _ in phrases)
    starts = "list_concat(" * (len(phrases) - 1) + ", ".join(
        f"list_filter(range(1, len(ws) + 1), lambda i: ws[i:i + {len(p) - 1}] = {p})" + ")" * (k > 0) for k, (p, _) in enumerate(phrases))
    base = ", ".join(f"CASE WHEN list_contains(at{k}, true) THEN '{label}' END" for k, (_, label) in enumerate(phrases))
    hits = ", ".join(
        f"list_transform(range(1, len(ws) + 1), lambda i: ws[i:i + {len(p) - 1}] = {p}) AS at{k}" for k, (p, _) in enumerate(phrases))
    more = ", ".join(f"CASE WHEN regexp_matches(line, '{template_regex(t)}') THEN '{label}' END" for label, t in TEMPLATES.items())

    def listed(items: str) -> str:
        return f"list_sort(list_distinct(list_filter([{items}], lambda x: x IS NOT NULL)))"

    return rf"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
h AS (SELECT doc_id, ws, ' ' || array_to_string(ws, ' ') || ' ' AS line, {hits}, {places} AS n, {starts} AS begins FROM d),
l AS (SELECT doc_id, ws, n, begins, {listed(base)} AS b, {listed(base + ", " + more)} AS m FROM h)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(n AS BIGINT) AS n_base,
    CAST(list_min(begins) - 1 AS BIGINT) AS first_word, CAST(list_max(begins) - 1 AS BIGINT) AS last_word,
    array_to_string(b, ',') AS base_labels, array_to_string(m, ',') AS labels,
    1 - pow(0.5::DOUBLE, len(m)) AS score FROM l"""


@query()
def op2_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20, the stated query set."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


@query()
def op3_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of near copies of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))


@query("""
WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
    WHERE label IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
        AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
u AS (SELECT vec_id, label, list_transform(x, lambda e: e / sqrt(list_dot_product(x, x))) AS x FROM v),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM u AS a JOIN u AS b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_dot_product(a.x, b.x) >= 0.93),
reach AS (
    SELECT a AS vec_id, b AS other FROM links UNION SELECT r.vec_id, l.b FROM reach AS r JOIN links AS l ON l.a = r.other)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links,
    least(e.vec_id, coalesce(r.low, e.vec_id)) AS component_id, e.vec_id <= coalesce(r.low, e.vec_id) AS kept
FROM embeddings AS e LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) AS n ON n.a = e.vec_id
LEFT JOIN (SELECT vec_id, min(other) AS low FROM reach GROUP BY vec_id) AS r ON r.vec_id = e.vec_id
""")
def op4_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of one label."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query(_license_sql())
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License wording in every document."""
    return scan_licenses(table(spark, sf_dir, "documents"))


@query()
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document. The cache is new, so the work is the same in each run."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return count_tokens(table(spark, sf_dir, "documents"), path, f"{scratch_root(spark)}/cache")


@query(f"""
WITH s AS (
    SELECT doc_id, source, len({WORDS}) AS size,
        md5('1|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS draw FROM documents),
src AS (
    SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s GROUP BY source),
w AS (SELECT source, source_size, CAST(source_size * 2.0 AS DOUBLE) AS most, [5.0::DOUBLE, 2.0, 1.0][rank % 3 + 1] AS weight FROM src),
o AS (
    SELECT *, coalesce(sum(most) OVER p, 0.0) AS m, coalesce(sum(weight) OVER p, 0.0) AS v,
        sum(weight) OVER () AS all_v, CAST(1.5 * sum(source_size) OVER () AS DOUBLE) AS total
    FROM w WINDOW p AS (ORDER BY most / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
    SELECT source, source_size, least(most, weight * (SELECT max((total - m) / (all_v - v)) FROM o)) AS target FROM o),
r AS (SELECT *, CAST(round(target) AS BIGINT) AS words FROM t),
f AS (SELECT *, CASE WHEN source_size > 0 THEN words // source_size ELSE 0 END AS whole FROM r)
SELECT s.doc_id, CAST(s.size AS BIGINT) AS size, CAST(f.source_size AS BIGINT) AS source_size, f.target,
    CAST(whole * s.size + greatest(0, least(s.size, words - whole * f.source_size - coalesce(sum(s.size) OVER b, 0))) AS BIGINT) AS taken
FROM s JOIN f ON s.source IS NOT DISTINCT FROM f.source
WINDOW b AS (PARTITION BY s.source ORDER BY s.draw, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
""")
def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query()
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their bins."""
    return pack_documents(table(spark, sf_dir, "documents"))


@query()
def op10_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, by a model fitted on the labels that are not held out."""
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
h AS (
    SELECT *, len(u) AS n, CAST('0x' || x[1:8] AS BIGINT) % (len(u) + 1) AS one, CAST('0x' || x[9:16] AS BIGINT) % (len(u) + 1) AS two,
        CAST('0x' || x[17:24] AS BIGINT) % 100 AS h3, CAST('0x' || x[25:32] AS BIGINT) % 100 AS h4 FROM d),
c AS (
    SELECT doc_id, t, n, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 50 THEN 'plain'
            WHEN h4 < 80 THEN 'spm' ELSE 'psm' END AS form,
        array_to_string(u[1:least(one, two)], '') AS p, array_to_string(u[least(one, two) + 1:greatest(one, two)], '') AS m,
        array_to_string(u[greatest(one, two) + 1:], '') AS s FROM h)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(t) AS restored_sha256 FROM c
""")
def op11_fim_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in its fill-in-the-middle form, and rebuilt from that."""
    store = store_frames(table(spark, sf_dir, "documents"), f"{scratch_root(spark)}/frames")
    return digest_outputs(fill_in_middle(store))


def _repair_sql() -> str:
    """The same recurrence from the last row to the first, with whole audits and texts for each state."""
    after = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
    gives = [("user", 2), ("user", 2), ("assistant", 3), ("user", 2)]

    def way(edit: str, cost: str, then: str, line: str = "") -> str:
        lines = f"list_prepend({line}, {then}.l)" if line else f"{then}.l"
        return f"{{'c': {cost} + {then}.c, 'a': '{edit}' || {then}.a, 'l': {lines}}}"

    def direct(state: int) -> str:
        keeps = " ".join(f"WHEN '{i}' THEN {way('K', 'x', f'v{to}', 'role || chr(58) || text')}" for i, to in after[state].items())
        role, to = gives[state]
        kept = f"CASE WHEN fault IN (0, 3) THEN CASE left(role, 1) {keeps} END END"
        other = f"CASE WHEN fault IN (0, 3) THEN {way('R', '3 + x', f'v{to}', f'{chr(39)}{role}:{chr(39)} || text')} END"
        return f"list_min(list_filter([{way('D', '4', f'v{state}')}, {kept}, {other}], lambda w: w IS NOT NULL))"

    def with_insert(state: int, then: str) -> str:
        return f"list_min([b{state}, {way('I', '3', f'{then}{gives[state][1]}', f'{chr(39)}{gives[state][0]}:{chr(39)}')}])"

    empty = "CAST([] AS VARCHAR[])"
    return rf"""
WITH RECURSIVE k AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, list_transform(
        string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda ch: CAST(ascii(ch) AS BIGINT)) AS bytes
    FROM conversations),
h AS (
    SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b: list_reduce(
        [xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295::BIGINT) % 20 AS kind FROM k),
hurt AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM h),
r AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM hurt),
r2 AS (
    SELECT *, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM r),
f AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 1 WHEN nth > 1 THEN 2
        WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 3 ELSE 0 END AS fault FROM r2),
s AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
        count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
        count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
dp AS (
    SELECT conv_id, n + 1 AS i, {{'c': 0, 'a': '', 'l': {empty}}} AS v0, {{'c': 6, 'a': 'II', 'l': ['user:', 'assistant:']}} AS v1,
        {{'c': 3, 'a': 'I', 'l': ['assistant:']}} AS v2, {{'c': 0, 'a': '', 'l': {empty}}} AS v3 FROM s
    UNION ALL
    SELECT conv_id, i, {with_insert(0, 'e')} AS v0, {with_insert(1, 'e')} AS v1, e2 AS v2, e3 AS v3 FROM (
        SELECT *, {with_insert(2, 'b')} AS e2, {with_insert(3, 'b')} AS e3 FROM (
            SELECT conv_id, i, {direct(0)} AS b0, {direct(1)} AS b1, {direct(2)} AS b2, {direct(3)} AS b3 FROM (
                SELECT f.conv_id, f.i, f.role, f.text, f.fault, CASE WHEN f.fault = 3 THEN 3 ELSE 0 END AS x, v0, v1, v2, v3
                FROM dp JOIN f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.i = dp.i - 1))))
SELECT o.conv_id, CAST(coalesce(s.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(s.blank, 0) AS BIGINT) AS blank,
    CAST(coalesce(s.duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(s.truncated, 0) AS BIGINT) AS truncated,
    CAST(coalesce(s.illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(dp.v0.c, 0) AS BIGINT) AS cost,
    coalesce(dp.v0.a, '') AS audit, sha256(coalesce(array_to_string(dp.v0.l, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o
LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN dp ON dp.conv_id IS NOT DISTINCT FROM o.conv_id AND dp.i = 1
"""


@query(_repair_sql())
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest repair of every conversation, after planting faults in them."""
    rows = table(spark, sf_dir, "conversations")
    audits = digest_repairs(repair_conversations(damage(rows)))
    return audits.withColumn("conv", F.col("conv").cast(rows.schema["conv_id"].dataType)).withColumnRenamed("conv", "conv_id")


@query()
def op13_piece_agenda(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and what they decode to."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = encode_and_decode(table(spark, sf_dir, "documents"), path)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
