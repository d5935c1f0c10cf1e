"""Registered queries of the training-data operators, with DuckDB SQL where it can say the same.

Each builder takes (spark, sf_dir), applies its operator with production
parameters to the whole table and derives the contract's columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from usagelens.llm import (
    decontam,
    fill_in_middle,
    html_extract,
    language_id,
    licenses,
    mixing,
    prefix_trie,
    quality,
    sharding,
    simhash,
    suffix_dedup,
    url_filter,
    window_dedup,
)
from usagelens.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return deco


WINDOW_DEDUP_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, p, list_slice(w, p, p + 12) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM d)
), f AS (
  SELECT k, min(doc_id) AS m FROM win GROUP BY k
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS q FROM win JOIN f USING (k) WHERE doc_id > m
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY q) AS t
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS q FROM d) ANTI JOIN gone USING (doc_id, q)
  GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""


@query("op4_window_dedup", WINDOW_DEDUP_SQL)
def op4_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copied 13-word windows removed from every document."""
    return window_dedup.dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


SUFFIX_DEDUP_SQL = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), win AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS k FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS p FROM d)
), f AS (
  SELECT k, min(doc_id) AS m FROM win GROUP BY k
), hit AS (
  SELECT doc_id, p, p - coalesce(lag(p) OVER (PARTITION BY doc_id ORDER BY p), -100) > 50 AS first
  FROM win JOIN f USING (k) WHERE doc_id > m
), span AS (
  SELECT doc_id, min(p) AS s, max(p) + 50 AS e
  FROM (SELECT doc_id, p, sum(first::INT) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM hit) GROUP BY doc_id, g
), gap AS (
  SELECT doc_id, s, e, lead(s) OVER (PARTITION BY doc_id ORDER BY s) AS next, row_number() OVER (PARTITION BY doc_id ORDER BY s) AS k FROM span
), r AS (
  SELECT d.doc_id, any_value(h) AS h, count(s) AS n, coalesce(sum(e - s), 0)::BIGINT AS gone,
         coalesce(max(CASE WHEN k = 1 THEN substr(h, 1, 2 * s) END), any_value(h))
         || coalesce(string_agg(substr(h, 2 * e + 1, 2 * (coalesce(next, len(h) // 2) - e)), '' ORDER BY s), '') AS rest
  FROM d LEFT JOIN gap ON d.doc_id = gap.doc_id GROUP BY d.doc_id
)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, gone AS n_removed, n AS n_spans, sha256(unhex(rest)) AS kept_sha256 FROM r
"""


@query("op5_suffix_dedup", SUFFIX_DEDUP_SQL)
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copied 50-byte strings removed from every document."""
    return suffix_dedup.dedup(table(spark, sf_dir, "documents")) \
        .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def _quality_sql() -> str:
    space, q = r"[\x20\x09-\x0D]", quality
    count = lambda cls: f"length(t) - length(regexp_replace(t, '{cls}', '', 'g'))"
    classes = {"lower": "[a-z]", "upper": "[A-Z]", "digit": "[0-9]", "beyond_ascii": r"[^\x00-\x7F]", "point": r"[.,;:!?''\"()-]",
               "symbol": "[#*$%&|<>]"}
    bins = ", ".join(f"('{w.decode()}', {k})" for w, k in q._BINS.items())
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '(none)') AS lang, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents)
), win AS (
  SELECT doc_id, p, list_slice(w, p, p + 4) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS p FROM d)
), rep AS (
  SELECT doc_id, count(DISTINCT q) AS n FROM (
    SELECT doc_id, unnest(range(p, p + 5)) AS q FROM win JOIN (SELECT doc_id, k FROM win GROUP BY ALL HAVING count(*) > 1) USING (doc_id, k))
  GROUP BY doc_id
), base AS (
  SELECT d.doc_id, lang, len(w)::BIGINT AS n_words, length(regexp_replace(t, '{space}', '', 'g'))::BIGINT AS word_chars,
         ({count(classes["symbol"])})::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words, {", ".join(f"{count(c)} AS c_{n}" for n, c in classes.items())},
         len(w) < {q.MIN_WORDS} OR 100 * coalesce(rep.n, 0) > {q.MAX_REPEAT_PERCENT} * len(w) AS base_failed
  FROM d LEFT JOIN rep ON rep.doc_id = d.doc_id
), h AS (
  SELECT doc_id, lang, 'c' AS kind, bin, n FROM (
    SELECT doc_id, lang, unnest([{", ".join(f"'{n}'" for n in classes)}, 'other']) AS bin,
           unnest([{", ".join(f"c_{n}" for n in classes)}, word_chars - {" - ".join(f"c_{n}" for n in classes)}]) AS n FROM base)
  UNION ALL
  SELECT doc_id, lang, 'w', coalesce(b.bin, 0)::VARCHAR, count(*) FROM (
    SELECT doc_id, lang, trim(lower(unnest(w)), '.,;:!?''"()-#*$%&|<>') AS word FROM d) x
  LEFT JOIN (VALUES {bins}) AS b(word, bin) ON b.word = x.word GROUP BY ALL
), langs AS (
  SELECT lang, CASE WHEN coalesce(sum(word_chars) FILTER (NOT base_failed), 0) >= {q.MIN_REFERENCE_CHARS} AND lang <> '(none)' THEN lang ELSE '*' END AS ref FROM base GROUP BY lang
), sound AS (
  SELECT h.* FROM h JOIN base USING (doc_id) WHERE NOT base_failed
), r AS (
  SELECT lang AS ref, kind, bin, sum(n) AS n FROM sound GROUP BY ALL UNION ALL SELECT '*', kind, bin, sum(n) FROM sound GROUP BY ALL
), ps AS (
  SELECT doc_id, ref, kind, bin, n / sum(n) OVER (PARTITION BY doc_id, kind) AS p FROM h JOIN langs USING (lang) WHERE n > 0
), qs AS (
  SELECT ref, kind, bin, n / sum(n) OVER (PARTITION BY ref, kind) AS q FROM r
), js AS (
  SELECT doc_id, kind, sqrt(greatest(0, least(1, sum(p + CASE WHEN coalesce(q, 0) = 0 THEN 0 ELSE p * log2(p / (p + q)) + q * log2(2 * q / (p + q)) END) / 2 + (1 - coalesce(sum(q), 0)) / 2))) AS dist
  FROM ps LEFT JOIN qs USING (ref, kind, bin) WHERE (ref, kind) IN (SELECT (ref, kind) FROM qs) GROUP BY ALL
), v AS (
  SELECT base.*, c.dist AS cd, x.dist AS wd
  FROM base LEFT JOIN js c ON c.doc_id = base.doc_id AND c.kind = 'c' LEFT JOIN js x ON x.doc_id = base.doc_id AND x.kind = 'w'
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, round(cd, 6) AS char_distance, round(wd, 6) AS word_distance, base_failed,
       NOT base_failed AND NOT coalesce(word_chars >= {q.MIN_CHARS_JUDGED} AND cd > {q.MAX_CHAR_DISTANCE}, FALSE)
       AND NOT coalesce(n_words >= {q.MIN_WORDS_JUDGED} AND wd > {q.MAX_WORD_DISTANCE}, FALSE) AS kept
FROM v
"""


@query("op9_quality_rules", _quality_sql())
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, distances from the language's reference, and the verdict of every document."""
    return quality.judge(table(spark, sf_dir, "documents")).drop("tag") \
        .withColumns({c: F.round(c, 6) for c in ("char_distance", "word_distance")})


@query("op10_simhash_near_dedup")
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def _values(rows) -> str:
    lit = lambda x: "NULL" if x is None else str(x).upper() if isinstance(x, bool) else str(x) if isinstance(x, int) else "'" + x + "'"
    return ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows)


LICENSES_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), tpl(template, label, phrase, votes, n_template, tpos, t1, t2, t3) AS (VALUES {_values(licenses.template_rows())}),
pos AS (
  SELECT doc_id, p, w[p + 1] AS w1, w[p + 2] AS w2, w[p + 3] AS w3 FROM (SELECT doc_id, w, unnest(range(0, len(w) - 1)) AS p FROM d)
), v AS (
  SELECT doc_id, template, label, phrase, votes, n_template, p - tpos AS diagonal, bit_or(1::BIGINT << tpos) AS bits,
         bit_count(bit_or(1::BIGINT << tpos)) AS n, min(p) AS lo, max(p) AS hi
  FROM pos JOIN tpl ON w1 = t1 AND w2 = t2 AND (t3 IS NULL OR t3 = w3) GROUP BY ALL
), near AS (
  SELECT *, coalesce((diagonal - lag(diagonal) OVER o > {licenses.GAP})::INT, 1) AS new FROM v
  WHERE NOT phrase AND (n > 1 OR votes < 3) WINDOW o AS (PARTITION BY doc_id, template ORDER BY diagonal)
), run AS (
  SELECT *, sum(new) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM near
), merged AS (
  SELECT doc_id, template, label, votes, n_template, span, bit_count(bit_or(bits)) AS n, max(hi) + 2 - min(lo) + 1 AS length
  FROM run GROUP BY doc_id, template, label, votes, n_template, span
), stretch AS (
  SELECT x.doc_id, x.template, x.span, x.diagonal, bit_count(bit_or(y.bits)) AS n
  FROM run x JOIN run y USING (doc_id, template, span) JOIN merged m USING (doc_id, template, span)
  WHERE m.length > {licenses.MAX_STRETCH} * m.n_template AND y.lo >= x.lo AND y.hi + 2 - x.lo + 1 <= {licenses.MAX_STRETCH} * x.n_template GROUP BY ALL
), best AS (
  SELECT m.doc_id, m.label, m.votes, CASE WHEN m.length <= {licenses.MAX_STRETCH} * m.n_template THEN m.n ELSE max(s.n) END AS n
  FROM merged m LEFT JOIN stretch s USING (doc_id, template, span)
  GROUP BY m.doc_id, m.template, m.span, m.label, m.votes, m.n, m.length, m.n_template
), hit AS (
  SELECT doc_id, label, TRUE AS phrase, diagonal AS start, 1.0::DOUBLE AS coverage FROM v WHERE phrase AND n = votes
  UNION ALL
  SELECT doc_id, label, FALSE, NULL, n / votes::DOUBLE FROM best WHERE n / votes::DOUBLE >= {licenses.MIN_COVERAGE}
), f AS (
  SELECT doc_id, count(*) FILTER (phrase) AS n_base, min(start) AS first_word, max(start) AS last_word,
         list_sort(list_distinct(list(label) FILTER (phrase))) AS base_labels, list_sort(list_distinct(list(label))) AS labels,
         max(coverage) AS score FROM hit GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(array_to_string(base_labels, ','), '') AS base_labels,
       coalesce(array_to_string(labels, ','), '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN f ON d.doc_id = f.doc_id
"""


@query("op1_license_scan", LICENSES_SQL)
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices of every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def _case(column: str, values: dict, default) -> str:
    lit = lambda x: str(x) if isinstance(x, int) else f"'{x}'"
    return f"CASE {column} " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in values.items()) + f" ELSE {lit(default)} END" \
        if values else lit(default)


def _fill_sql(name: str, source: str, parent: str, level: str) -> str:
    """Water filling of one tree level: CTEs that end in ``name`` with the column ``budget``."""
    order = f"(PARTITION BY {parent} ORDER BY CASE WHEN weight > 0 THEN cap / weight END NULLS LAST, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"""{name}_a AS (
  SELECT *, given - coalesce(sum(cap) OVER {order}, 0) AS room,
         sum(weight) OVER (PARTITION BY {parent}) - coalesce(sum(weight) OVER {order}, 0) AS pull FROM {source}
), {name}_b AS (
  SELECT *, weight > 0 AND cap::DOUBLE * pull <= room::DOUBLE * weight AS whole FROM {name}_a
), {name}_c AS (
  SELECT *, given - coalesce(sum(cap) FILTER (whole) OVER (PARTITION BY {parent}), 0) AS rem,
         sum(weight) FILTER (NOT whole) OVER (PARTITION BY {parent}) AS open FROM {name}_b
), {name}_d AS (
  SELECT *, CASE WHEN whole THEN cap WHEN weight > 0 THEN floor(rem::DOUBLE * weight / open)::BIGINT ELSE 0 END AS share FROM {name}_c
), {name}_e AS (
  SELECT *, given - sum(share) OVER (PARTITION BY {parent}) AS rest, NOT whole AND weight > 0 AS takes FROM {name}_d
), {name}_f AS (
  SELECT *, row_number() OVER (PARTITION BY {parent} ORDER BY takes DESC, {level}) AS turn FROM {name}_e
), {name} AS (
  SELECT *, (share + CASE WHEN takes AND turn <= rest AND share < cap THEN 1 ELSE 0 END)::BIGINT AS budget FROM {name}_f
)"""


def _children_sql(level: str, path: str) -> str:
    return f"SELECT {path}, sum(tokens * {mixing.MAX_EPOCHS})::BIGINT AS cap, {_case(level, mixing.WEIGHTS.get(level, {}), 1)} AS weight FROM leaf GROUP BY ALL"


MIXING_SQL = rf"""
WITH r AS (
  SELECT doc_id, {_case("coalesce(source, '(none)')", mixing.DOMAINS, mixing.OTHER_DOMAIN)} AS domain, coalesce(lang, '(none)') AS lang,
         coalesce(source, '(none)') AS source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens FROM documents
), leaf AS (
  SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens FROM r GROUP BY ALL
), c1 AS ({_children_sql("domain", "domain")}),
i1 AS (SELECT *, 0 AS root, least(floor((SELECT sum(tokens) FROM leaf) * {mixing.BUDGET_SHARE}::DOUBLE), sum(cap) OVER ())::BIGINT AS given FROM c1),
{_fill_sql("n1", "i1", "root", "domain")},
c2 AS ({_children_sql("lang", "domain, lang")}),
i2 AS (SELECT c2.*, n1.budget AS given FROM c2 JOIN n1 USING (domain)),
{_fill_sql("n2", "i2", "domain", "lang")},
c3 AS ({_children_sql("source", "domain, lang, source")}),
i3 AS (SELECT c3.*, n2.budget AS given FROM c3 JOIN n2 USING (domain, lang)),
{_fill_sql("n3", "i3", "domain, lang", "source")},
b AS (
  SELECT domain, lang, source, tokens, budget, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS epochs
  FROM n3 JOIN leaf USING (domain, lang, source)
), k AS (
  SELECT r.*, epochs, budget - epochs * tokens AS rest,
         md5('{mixing.SEED}:' || epochs || ':' || coalesce(doc_id::VARCHAR, '-') || ':' || n_tokens) AS key
  FROM r JOIN b USING (domain, lang, source)
), s AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key) AS through FROM k
)
SELECT doc_id, domain, lang, source, n_tokens, unnest(range(0, (epochs + CASE WHEN rest > 0 AND through <= rest THEN 1 ELSE 0 END)::BIGINT)) AS epoch FROM s
"""


@query("op2_source_mix", MIXING_SQL)
def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn for the target weights, once per epoch that draws them."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "domain", "lang", "source", "n_tokens", "epoch")


def _sharding_sql(limit: int) -> str:
    return rf"""
WITH r AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT AS n_bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '-') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h FROM documents
), deep AS (SELECT *, unnest(range(0, 61)) AS depth FROM r
), fits AS (
  SELECT depth, h >> (60 - depth)::INT AS bucket FROM deep GROUP BY ALL HAVING sum(n_bytes) <= {limit} OR count(*) = 1
), f AS (
  SELECT doc_id, n_bytes, h, min(depth) AS depth FROM deep JOIN fits USING (depth) WHERE h >> (60 - depth)::INT = bucket GROUP BY ALL
)
SELECT doc_id, n_bytes, depth::INT AS depth,
       CASE WHEN depth = 0 THEN 'all' ELSE lpad(bin(h >> (60 - depth)::INT), depth::INT, '0') END AS shard, 0::BIGINT AS page FROM f
"""


@query("op3_extendible_shards", _sharding_sql(sharding.LIMIT_BYTES))
def op3_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document."""
    return sharding.shards(table(spark, sf_dir, "documents"))


@query("llm_shards_small", _sharding_sql(64 << 10))
def llm_shards_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with shards of 64 KB, so that small tables split too."""
    return sharding.shards(table(spark, sf_dir, "documents"), limit=64 << 10)


@query("op6_main_text")
def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, without what its site repeats."""
    return html_extract.main_text(table(spark, sf_dir, "pages"))


@query("op7_benchmark_leaks")
def op7_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain benchmark items, one row per document and item."""
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("tag")


@query("op8_url_filter")
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL, by rule or classifier."""
    return url_filter.judge(table(spark, sf_dir, "pages"))


TRIE_SQL = """
WITH t AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, m) AS k, length(text)::BIGINT AS n FROM (
    SELECT conv_id, turn, role, text, md5(octet_length(encode(role))::VARCHAR || ':' || role || text) AS m FROM (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL))
), c AS (
  SELECT conv_id, xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda x, y: xor(x >> 1, (x & 1) * 3988292384::UBIGINT)))) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT c.conv_id, k, m, n FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 WHERE k <= h
  UNION ALL SELECT c.conv_id, k, m, n FROM c JOIN t ON t.conv_id = c.conv_id WHERE k > h
), q AS (
  SELECT conv_id, row_number() OVER o AS depth, n, string_agg(m, ',') OVER o AS key, count(*) OVER (PARTITION BY conv_id) AS length
  FROM r WINDOW o AS (PARTITION BY conv_id ORDER BY k)
), p AS (
  SELECT conv_id, 0::BIGINT AS depth, 0::BIGINT AS n, '' AS key, (SELECT count(*) FROM r WHERE r.conv_id = c.conv_id) AS length FROM c
  UNION ALL SELECT conv_id, depth, n, key, length FROM q
), node AS (
  SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, max(n) AS n,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = length), '')) AS ends_sha256 FROM p GROUP BY ALL
), up AS (
  SELECT node.*, p.key AS above FROM node LEFT JOIN p ON p.conv_id = node.conv_id AND p.depth = node.depth - 1
), kid AS (SELECT depth - 1 AS depth, above AS key, count(*) AS n_children FROM up GROUP BY ALL
), e AS (SELECT up.*, coalesce(n_children, 0) AS n_children FROM up LEFT JOIN kid ON kid.depth = up.depth AND kid.key = up.key
), s AS (
  SELECT a.depth, a.key, sum((e.n_convs - 1) * e.n)::BIGINT AS saved_tokens, count(*) FILTER (e.n_children = 0) AS n_leaves
  FROM e JOIN p a ON a.conv_id = e.conv_id AND a.depth <= e.depth GROUP BY ALL
)
SELECT e.conv_id, e.depth, o.conv_id AS parent_conv_id, e.n_convs, e.n_children, s.n_leaves, s.saved_tokens, e.ends_sha256
FROM e JOIN s ON s.depth = e.depth AND s.key = e.key LEFT JOIN node o ON o.depth = e.depth - 1 AND o.key = e.above
"""


@query("op11_prefix_trie", TRIE_SQL)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all conversations, the head of each group's first one shared."""
    ordered = prefix_trie.turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.grouped_heads(ordered))


FILL_IN_MIDDLE_SQL = rf"""
WITH d AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u,
         [('0x' || substr(h, 8 * k + 1, 8))::BIGINT for k in range(0, 4)] AS h FROM (
    SELECT doc_id, coalesce(text, '') AS t, sha256('{fill_in_middle.SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents)
), c AS (
  SELECT *, len(u) AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b FROM d
), f AS (
  SELECT doc_id, n, t, array_to_string(list_slice(u, 1, a), '') AS p, array_to_string(list_slice(u, a + 1, b), '') AS m, array_to_string(list_slice(u, b + 1, n), '') AS s,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= {fill_in_middle.RATE} THEN 'plain'
              WHEN h[4] % 100 < {fill_in_middle.SPM_RATE} THEN 'spm' ELSE 'psm' END AS form FROM c
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM f
"""


@query("op12_fill_in_middle", FILL_IN_MIDDLE_SQL)
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, counts and digests of every document's transformed text and of the text rebuilt from it."""
    made = fill_in_middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return fill_in_middle.restored(made).select("doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars",
                                                sha("fim.output").alias("output_sha256"), sha("restored").alias("restored_sha256"))


@query("op13_language_id")
def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; documents of one CRC-32 remainder are kept from fitting."""
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(docs)) \
        .select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole corpus pipeline (corpus_pipeline.py)."""
    return corpus_pipeline.run(spark, sf_dir)
