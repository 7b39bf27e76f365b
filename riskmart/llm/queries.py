"""Registered queries of the training-data operators, each over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskmart.llm import collocations, decontamination, html_text, language_id, license_scan, merkle_manifest, mixing, near_dedup, quality_model, quality_rules, secrets, sharding, token_counts
from riskmart.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


OP9_SQL = r"""
WITH worded AS (
    SELECT doc_id, coalesce(text, '') AS t,
           [w FOR w IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF w <> ''] AS words,
           [l FOR l IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(l, '[^\x20\x09-\x0D]')] AS lines
    FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS win
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM worded)
), repeats AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1
), covered AS (
    SELECT doc_id, count(DISTINCT i + k) AS n FROM repeats, range(8) AS r(k) GROUP BY doc_id
), measured AS (
    SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
           CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(length(regexp_replace(t, '[^A-Z]', '', 'g')) AS BIGINT) AS n_upper,
           CAST(length(regexp_replace(t, '[^!]', '', 'g')) AS BIGINT) AS n_exclaims,
           CAST(len(lines) AS BIGINT) AS n_lines,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(len([i FOR i IN range(2, len(words) + 1) IF words[i] = words[i - 1]]) AS BIGINT) AS n_stutter,
           CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
    FROM worded w LEFT JOIN covered c ON c.doc_id = w.doc_id
), bits AS (
    SELECT *, CAST(""" + " + ".join(
    f"CASE WHEN {condition} THEN {1 << bit} ELSE 0 END" for bit, condition in enumerate(quality_rules.RULES.values())
) + r""" AS BIGINT) AS rule_bits FROM measured
)
SELECT *, rule_bits & 3 <> 0 AS base_failed, rule_bits = 0 AS kept, 'v2' AS policy FROM bits
"""


@query("op9_quality_rules", OP9_SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judged(quality_rules.ledger(table(spark, folder, "documents")))


@query("op6_token_counts")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op5_secrets")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(table(spark, folder, "documents"))


@query("op1_language_id")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(table(spark, folder, "documents"))


@query("op7_sharding")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shards(table(spark, folder, "documents"))


@query("op10_quality_model")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return quality_model.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


OP3_SQL = r"""
WITH dw AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), iw AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), win AS (
    SELECT DISTINCT item, w[i:i + 12] AS ws, least(len(w), 13) AS n
    FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM iw WHERE len(w) > 0)
), dwin AS (
    SELECT doc_id, i, n, w[i:i + n - 1] AS ws
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, (SELECT DISTINCT n FROM win))
), exact AS (
    SELECT doc_id, i, item, d.n FROM dwin d JOIN win ON array_to_string(d.ws, ' ') = array_to_string(win.ws, ' ') AND d.n = win.n
), hit AS (
    SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM (SELECT doc_id, i, unnest(range(n)) AS k FROM exact) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM exact) GROUP BY doc_id
), pairs AS (
    SELECT d.doc_id, win.item, d.ws AS a, win.ws AS b FROM dwin d JOIN win ON d.n = 13 AND win.n = 13 AND array_to_string(d.ws[1:4], ' ') = array_to_string(win.ws[1:4], ' ')
    UNION ALL SELECT d.doc_id, win.item, d.ws, win.ws FROM dwin d JOIN win ON d.n = 13 AND win.n = 13 AND array_to_string(d.ws[5:8], ' ') = array_to_string(win.ws[5:8], ' ')
    UNION ALL SELECT d.doc_id, win.item, d.ws, win.ws FROM dwin d JOIN win ON d.n = 13 AND win.n = 13 AND array_to_string(d.ws[9:13], ' ') = array_to_string(win.ws[9:13], ' ')
), near AS (
    SELECT doc_id, count(DISTINCT item) AS n_near FROM pairs WHERE len([k FOR k IN range(1, 14) IF a[k] <> b[k]]) BETWEEN 1 AND 2
        AND (doc_id, item) NOT IN (SELECT (doc_id, item) FROM exact) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
       CAST(coalesce(n_near, 0) AS BIGINT) AS n_near
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN near USING (doc_id)
"""


@query("op3_decontamination", OP3_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op2_html_text")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


@query("op8_near_dedup")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"), width=3, percent=85)


def _raking_sql(docs: str) -> str:
    """Common table expressions from ``docs`` (a table of documents) to ``mixed``: every document with factor, probability and selected."""
    topic = "CASE " + " ".join(f"WHEN t LIKE '{pattern}' THEN '{name}'" for name, pattern in mixing.TOPICS) + f" ELSE '{mixing.OTHER_TOPIC}' END"
    parts = [f"""mix_rows AS (
    SELECT doc_id, source, lang, {topic} AS topic, len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')) AS n_tokens,
           CAST('0x' || substr(md5('29:' || doc_id), 1, 13) AS BIGINT) / CAST(pow(16, 13) AS DOUBLE) AS place
    FROM (SELECT *, coalesce(text, '') AS t FROM {docs})
), mix_cells AS MATERIALIZED (
    SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS n, CAST(sum(n_tokens) AS DOUBLE) AS w FROM mix_rows GROUP BY ALL
)"""]
    for d in mixing.DIMENSIONS:
        parts.append(f"""mix_{d} AS MATERIALIZED (
    SELECT {d}, pow(own, {mixing.TEMPER}) / sum(pow(own, {mixing.TEMPER})) OVER () * sum(own) OVER () AS target FROM (SELECT {d}, sum(n) AS own FROM mix_cells GROUP BY {d}) WHERE own > 0
)""")
    last = "mix_cells"
    for k in range(mixing.ROUNDS):
        for d in mixing.DIMENSIONS:
            now = f"mix_{k}_{d}"
            parts.append(f"""{now} AS MATERIALIZED (
    SELECT c.source, c.lang, c.topic, n, CASE WHEN sum(w) OVER (PARTITION BY c.{d}) > 0 THEN w * (target / sum(w) OVER (PARTITION BY c.{d})) ELSE 0 END AS w FROM {last} c JOIN mix_{d} t ON t.{d} = c.{d}
)""")
            last = now
    # Of the scales that fix the first k cells (by factor) at probability 1, the right one is the first that leaves the next cell below 1.
    parts.append(f"""mix_ranked AS (
    SELECT *, w / n AS factor, coalesce(sum(n) OVER before, 0) AS held, sum(w) OVER onward AS rest, sum(n) OVER () AS tokens FROM {last} WHERE n > 0
    WINDOW before AS (ORDER BY w / n DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           onward AS (ORDER BY w / n DESC, source, lang, topic ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), mix_scale AS (
    SELECT arg_min(({mixing.BUDGET} * tokens - held) / rest, held) AS scale FROM mix_ranked WHERE factor * ({mixing.BUDGET} * tokens - held) / rest < 1
), mixed AS (
    SELECT r.doc_id, r.source, r.lang, r.topic, CAST(r.n_tokens AS BIGINT) AS n_tokens, round(factor, 8) AS factor, round(least(1, factor * scale), 8) AS probability,
           place < least(1, factor * scale) AS selected
    FROM mix_rows r JOIN mix_ranked c ON c.source = r.source AND c.lang = r.lang AND c.topic = r.topic, mix_scale
)""")
    return ", ".join(parts)


OP4_SQL = f"WITH {_raking_sql('documents')} SELECT * FROM mixed"


@query("op4_mixing", OP4_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.probabilities(table(spark, folder, "documents"))


def _license_sql() -> str:
    rules = ", ".join(f"({r.at}, '{r.label}', {r.priority}, {r.weight}, '{r.keyword}', '{r.pattern}')" for r in license_scan.RULES)
    return rf"""
WITH rules(rid, label, priority, weight, keyword, pattern) AS (VALUES {rules}),
cleaned AS (
    SELECT doc_id, row_number() OVER () AS k, trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', '  ', 'g'), ' ') AS t FROM documents
), docs AS MATERIALIZED (
    SELECT doc_id, k, CASE WHEN t = '' THEN '' ELSE ' ' || t || ' ' END AS normal, CASE WHEN t = '' THEN 0 ELSE len(string_split(t, '  ')) END AS n_words FROM cleaned
), marked AS MATERIALIZED (
    SELECT k, rid, label, priority, weight, string_split(regexp_replace(normal, pattern, ' ' || chr(1) || '\1' || chr(2) || ' ', 'g'), '  ') AS w
    FROM docs JOIN rules ON contains(normal, ' ' || keyword || ' ') AND regexp_matches(normal, pattern)
), spans AS (
    SELECT k, rid, label, priority, CAST(weight AS DOUBLE) AS weight,
           unnest([i - 1 FOR i IN range(1, len(w) + 1) IF contains(w[i], chr(1))]) AS first, unnest([i - 1 FOR i IN range(1, len(w) + 1) IF contains(w[i], chr(2))]) AS last
    FROM marked
), kept AS (
    SELECT * FROM spans s WHERE priority = {license_scan.BASE} OR NOT EXISTS (
        SELECT 1 FROM spans o WHERE o.k = s.k AND o.first <= s.first AND o.last >= s.last AND o.rid <> s.rid AND (o.priority > s.priority
            OR o.priority = s.priority AND (o.last - o.first > s.last - s.first OR o.last - o.first = s.last - s.first AND o.rid < s.rid)))
), summed AS (
    SELECT k, count(*) AS n_spans, count(*) FILTER (priority = {license_scan.BASE}) AS n_base, min(first) FILTER (priority = {license_scan.BASE}) AS first_word,
           max(first) FILTER (priority = {license_scan.BASE}) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (priority = {license_scan.BASE}) AS base_labels,
           string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(weight) AS score
    FROM kept GROUP BY k
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans
FROM docs LEFT JOIN summed USING (k)
"""


@query("op13_license_scan", _license_sql())
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(table(spark, folder, "documents"))


def _merkle_sql(depth: int = 5, top_depth: int = 3) -> str:
    """Levels are taken ``depth`` times in a source and ``top_depth`` times over the sources; where one node is left, a level changes nothing."""
    field = lambda f: f"coalesce(octet_length(encode(CAST({f} AS VARCHAR))) || ':' || CAST({f} AS VARCHAR), '-')"
    head = " || ".join(field(f) for f in merkle_manifest.FIELDS[:4])
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    byte = "list_reduce([xor(c, b)] || [CAST(0 AS BIGINT) FOR i IN range(8)], lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    crc = f"xor(list_reduce([CAST(4294967295 AS BIGINT)] || [CAST(ascii(d) AS BIGINT) FOR d IN string_split(CAST(doc_id AS VARCHAR), '')], lambda c, b: {byte}), 4294967295)"
    parts = [f"""leaves AS MATERIALIZED (
    SELECT doc_id, coalesce('s' || source, 'n') AS tree, sha256({head} || {field('text')}) AS leaf, CASE WHEN doc_id IS NOT NULL AND {crc} % 5 = 0 THEN sha256({head} || {field(low)}) END AS tampered
    FROM documents
), r0 AS MATERIALIZED (
    SELECT doc_id, tree, leaf, coalesce(tampered, leaf) AS node, '' AS proof, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves
), n0 AS MATERIALIZED (
    SELECT tree, pos, leaf AS d, count(*) OVER (PARTITION BY tree) AS total FROM r0
)"""]

    def level(n: str, r: str, up_n: str, up_r: str, more: str) -> str:
        before, after = "array_to_string(ds[1:r.pos % 16], '')", "array_to_string(ds[r.pos % 16 + 2:], '')"
        return f"""run_{n} AS MATERIALIZED (
    SELECT tree, pos // 16 AS up, list(d ORDER BY pos) AS ds, max(total) AS total FROM {n} GROUP BY ALL
), {up_n} AS MATERIALIZED (
    SELECT tree, up AS pos, CASE WHEN total = 1 THEN ds[1] ELSE sha256(array_to_string(ds, '')) END AS d, count(*) OVER (PARTITION BY tree) AS total FROM run_{n}
), {up_r} AS MATERIALIZED (
    SELECT r.doc_id, r.tree, r.leaf, {more} CASE WHEN total = 1 THEN node ELSE sha256({before} || node || {after}) END AS node,
           CASE WHEN total = 1 THEN proof ELSE proof || {before} || {after} END AS proof, r.pos // 16 AS pos
    FROM {r} r JOIN run_{n} g ON g.tree = r.tree AND g.up = r.pos // 16
)"""

    parts += [level(f"n{k}", f"r{k}", f"n{k + 1}", f"r{k + 1}", "") for k in range(depth)]
    parts.append(f"""t0 AS MATERIALIZED (
    SELECT 'top' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, d, count(*) OVER () AS total, tree AS name FROM n{depth}
), q0 AS MATERIALIZED (
    SELECT doc_id, 'top' AS tree, leaf, t0.d AS subroot, node, proof, t0.pos FROM r{depth} r JOIN t0 ON t0.name = r.tree
)""")
    parts += [level(f"t{k}", f"q{k}", f"t{k + 1}", f"q{k + 1}", "r.subroot,") for k in range(top_depth)]
    return "WITH " + ", ".join(parts) + f""" SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = d AS verified FROM q{top_depth}, t{top_depth}"""


@query("op11_merkle_manifest", _merkle_sql())
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return merkle_manifest.proofs(table(spark, folder, "documents"))


OP12_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, [w FOR w IN string_split_regex(piece, '[\x20\x09]+') IF w <> ''] AS w FROM pieces
), grams AS (
    SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f
    FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM worded, (VALUES (1), (2), (3)) AS s(size)) GROUP BY ALL
), totals AS (
    SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE size = 1 GROUP BY lang
), often AS MATERIALIZED (
    SELECT lang, size, phrase, string_split(phrase, ' ') AS w, f FROM grams WHERE f >= 10
), cuts AS (
    SELECT g.lang, g.size, g.phrase, g.f AS a, k, l.f AS l, r.f AS r, CAST(1000000 AS HUGEINT) * g.f * g.f // (CAST(l.f AS HUGEINT) * r.f) AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM often WHERE size > 1) g
    JOIN often l ON l.lang = g.lang AND l.phrase = array_to_string(g.w[1:k], ' ') JOIN often r ON r.lang = g.lang AND r.phrase = array_to_string(g.w[k + 1:], ' ')
), least AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
    SELECT lang, part, max(f) AS f FROM (SELECT lang, f, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM often WHERE size = 3) GROUP BY ALL
), ranked AS (
    SELECT c.*, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
    FROM least c LEFT JOIN longer o ON o.lang = c.lang AND o.part = c.phrase AND c.size = 2 WHERE o.f IS NULL OR 100 * o.f < 50 * c.a
)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query("op12_collocations", OP12_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))
