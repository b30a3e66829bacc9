"""Registered queries of the subpackage and their SQL.

Each ``opN_`` query applies one operator with production parameters to its
whole table and derives the digest columns from the operator's result.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, cotrain, decontam, html_paths, jaccard, langid, merkle, mixing, mtree, repair, resample, secrets,
               substring)

#: Labels of the quality classifier and what is kept.
WANT = {"quality": 1, "toxic": 0}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets_digest(secrets.scan_secrets(_table(spark, sf_dir, "documents")))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.jaccard_components(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                        F.col("component").alias("component_id"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_paths.extract_pages(_table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"), "path")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    models = cotrain.train(docs, _table(spark, sf_dir, "labels"), list(WANT))
    return cotrain.classify(docs, models, WANT).withColumnRenamed("id", "doc_id")


def damaged_replica(pages: DataFrame) -> DataFrame:
    """A replica of ``pages`` with damage that follows from the ids alone:
    records lost, a sign changed, cut short, and stored twice."""
    body = (F.when(F.col("page_id") % 103 == 1, F.concat(F.lit("?"), F.substring(F.col("html"), 2, 1 << 30)))
            .when(F.col("page_id") % 107 == 2, F.substring(F.col("html"), 1, 100)).otherwise(F.col("html")))
    kept = pages.where("page_id IS NULL OR page_id % 101 <> 0").select("page_id", "url", body.alias("html"))
    return kept.union(pages.where("page_id % 211 = 5 AND page_id % 101 <> 0").select("page_id", "url", "html"))


def op6_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    body = merkle.warc_record(F.col("url"), F.col("page_id"), F.col("html"))
    return merkle.audit(pages, damaged_replica(pages), "page_id", body, body).select(
        F.col("slot").alias("page_id"), "status", F.col("file").alias("file_no"), F.col("start").alias("start_byte"),
        F.col("stop").alias("end_byte"), "sha256")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


def _held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.learn(docs.where(~_held_out()), "text", "lang")
    found = langid.identify(docs, "doc_id", "text", model, {"held_out": _held_out()})
    return found.withColumnRenamed("id", "doc_id")


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(_table(spark, sf_dir, "embeddings"))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "copies")


#: A conversation that says the template's own control strings.
PLANTED = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op11_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = spark.createDataFrame(PLANTED, "conv_id long, turn long, role string, text string")
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(planted)
    return chat.chats_digest(chat.format_chats(turns))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def damaged_turns(turns: DataFrame) -> DataFrame:
    """``turns`` with damage that follows from a checksum of ``conv_id:turn``:
    lost, emptied, without full stops, repeated, or all the user's."""
    space = F.lit(" ")
    code = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                            F.coalesce(F.col("turn").cast("string"), space))) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return (turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), code.alias("code")).where("code <> 0")
            .select("conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.explode(F.array_repeat(F.lit(0), F.when(F.col("code") == 3, 2).otherwise(1))).alias("copy"))
            .drop("copy"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    found = repair.repairs_digest(*repair.repair_conversations(damaged_turns(turns))).withColumnRenamed("conv_id", "id")
    every = turns.select("conv_id").distinct()
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("id")), "left").select(
        "conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_secret_scan, op2_ngram_jaccard, op3_substring_dedup, op4_html_extraction,
                            op5_quality_classifier, op6_warc_fixity, op7_decontamination, op8_language_id,
                            op9_exact_top_k, op10_source_mixing, op11_chat_formatting,
                            op12_importance_resampling, op13_conversation_repair)}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _secrets_sql() -> str:
    patterns = (secrets.ASSIGN, secrets.ACCESS, secrets.HEX, secrets.ACCOUNT, secrets.BARE, secrets.ENDPOINT)
    each = []
    for no, (kind, pattern) in enumerate(zip(secrets.KINDS, patterns), 1):
        p, group = _quoted(pattern), 2 if kind == "assign" else 0
        keep = {"assign": "length(val) >= 8", "bare": "regexp_matches(val, '[0-9]') AND regexp_matches(val, '[a-z]') "
                "AND regexp_matches(val, '[A-Z]')"}.get(kind, "TRUE")
        each.append(f"""
  SELECT rid, {no} AS kind, '{kind}' AS name, '{secrets.ROLE[kind]}' AS role, place AS start, place + length(hit) AS stop FROM (
    SELECT rid, hit, val, sum(length(gap)) OVER (PARTITION BY rid ORDER BY i)
           + coalesce(sum(length(hit)) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
    FROM (SELECT rid, unnest(range(len(regexp_extract_all(text, {p})))) AS i,
                 unnest(regexp_split_to_array(text, {p})[1:len(regexp_extract_all(text, {p}))]) AS gap,
                 unnest(regexp_extract_all(text, {p})) AS hit, unnest(regexp_extract_all(text, {p}, {group})) AS val
          FROM t WHERE regexp_matches(text, {p}))) WHERE {keep}""")
    near = (f"b.rid = a.rid AND b.role = '{{}}' AND ((b.start >= a.stop AND b.start - a.stop <= {secrets.SCOPE}) "
            f"OR (a.start >= b.stop AND a.start - b.stop <= {secrets.SCOPE}))")
    needs = " OR ".join(
        "(a.name = '{}' AND {})".format(kind, " AND ".join(
            f"EXISTS (SELECT 1 FROM parts b WHERE {near.format(role)})" for role in roles))
        for kind, roles in secrets.NEEDS.items())
    listed = "coalesce(string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind, stop), '')"
    return f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
found AS ({' UNION ALL '.join(each)}),
parts AS (SELECT * FROM found a WHERE kind <= 3 OR NOT EXISTS (
  SELECT 1 FROM found b WHERE b.rid = a.rid AND b.kind <= 3 AND b.start < a.stop AND a.start < b.stop)),
told AS (SELECT * FROM parts a WHERE kind <= 3 OR {needs}),
base AS (SELECT rid, count(*) FILTER (kind = 1) AS n1, count(*) FILTER (kind = 2) AS n2, count(*) FILTER (kind = 3) AS n3,
                {listed} AS spans FROM told WHERE kind <= 3 GROUP BY rid),
every AS (SELECT rid, {listed} AS spans FROM told GROUP BY rid)
SELECT doc_id, coalesce(n1, 0) AS n_assign, coalesce(n2, 0) AS n_access, coalesce(n3, 0) AS n_hex,
       sha256(coalesce(base.spans, '')) AS base_sha256, coalesce(every.spans, '') AS spans
FROM t LEFT JOIN base USING (rid) LEFT JOIN every USING (rid)"""


_SPLIT = r"[x FOR x IN regexp_split_to_array({}, '[\x20\x09-\x0D]+') IF x <> '']"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_JACCARD_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_SPLIT.format(_LOWER)} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5
        THEN [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)]
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM o JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * o >= 80 * (a.n + b.n - o)),
r AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.y) AS component_id
FROM w LEFT JOIN n USING (doc_id) JOIN r ON r.x = w.doc_id GROUP BY w.doc_id"""

_SUBSTRING_SQL = f"""
WITH w AS (SELECT doc_id, {_SPLIT.format("coalesce(text, '')")} AS ws FROM documents),
win AS (SELECT doc_id, i, sha256(array_to_string(ws[i:i + 34], ' ')) AS h
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM again),
one AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
         FROM one ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""

_FIXITY_SQL = """
WITH r AS (SELECT page_id, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
      || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'WARC-Record-ID: <urn:record:' || page_id || '>'
      || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
      || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS body, html FROM pages),
f AS (SELECT page_id, html, page_id // 4096 AS file_no, sha256(body) AS sha256, strlen(body) AS bytes,
      sum(strlen(body)) OVER (PARTITION BY page_id // 4096 ORDER BY page_id) AS stop FROM r)
SELECT page_id, CASE WHEN page_id % 101 = 0 THEN 'missing' WHEN page_id % 211 = 5 THEN 'repeated' ELSE 'corrupt' END AS status,
       file_no, CAST(stop - bytes AS BIGINT) AS start_byte, CAST(stop AS BIGINT) AS end_byte, sha256
FROM f WHERE page_id % 101 = 0 OR page_id % 211 = 5 OR (page_id % 103 = 1 AND length(html) > 0 AND html[1] <> '?')
   OR (page_id % 107 = 2 AND page_id % 103 <> 1 AND length(html) > 100)"""

_TOP_K_SQL = """
WITH v AS (SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM (SELECT DISTINCT vec_id, v FROM v WHERE vec_id % 50 = 0) q JOIN v c ON q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""



def _chat_sql() -> str:
    rests = "|".join(re.escape(c[1:]) for c in chat.INSTRUCTION.control)
    escaped = rf"regexp_replace({{}}, '([<\[])(\\*)({rests})', '\1\\\2\3', 'g')"
    marks = {r: sum(len(p.text) for p in parts) for r, parts in chat.INSTRUCTION.turns.items()}
    sizes = " ".join(f"WHEN '{r}' THEN {n}" for r, n in marks.items())
    other = sum(len(p.text) for p in chat.INSTRUCTION.other)
    moves = ", ".join(_quoted(f"{s and '=' + s}>{r}") for s, roles in chat.INSTRUCTION.follows.items() for r in roles)
    planted = " ".join(f"UNION ALL SELECT {c}, {t}, {_quoted(r)}, {_quoted(x)}" for c, t, r, x in PLANTED)
    order = "turn NULLS FIRST, role, text"
    return f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations {planted}),
e AS (SELECT *, length({escaped.format('text')}) + CASE role {sizes} ELSE {other} + length({escaped.format('role')}) END AS chars,
        coalesce('=' || lag(role) OVER w, '') || '>' || role AS move, lead(role) OVER w IS NULL AS ends
      FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY {order}))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY {order})) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY {order}) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST({len(chat.INSTRUCTION.begin)} + sum(chars) AS BIGINT) AS formatted_chars,
       bool_and(move IN ({moves})) AND bool_or(ends AND role = 'assistant') AS valid,
       count(*) FILTER (move NOT IN ({moves})) AS n_faults
FROM e GROUP BY conv_id"""


#: The checksum CRC-32 of the text ``{0}``, by a table of 256 entries.
_CRC_TABLE = """SELECT list(v ORDER BY i) AS crc FROM (SELECT i, list_reduce(range(8), lambda c, k:
  CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v FROM range(256) t(i))"""
_CRC = """xor(list_reduce([CAST('0x' || hex({0})[j:j + 1] AS BIGINT) FOR j IN range(1, 2 * strlen({0}), 2)],
  lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"""

_RESAMPLE_SQL = rf"""
WITH crcs AS ({_CRC_TABLE}),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
w AS (SELECT rid, unnest(ws) AS word FROM d),
b AS (SELECT unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
h AS (SELECT word, {_CRC.format('word')} % 10000 AS bucket FROM (SELECT word FROM w UNION SELECT word FROM b), crcs),
s AS (SELECT bucket, count(*) AS n FROM w JOIN h USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM b JOIN h USING (word) GROUP BY bucket),
g AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1::DOUBLE) * ((SELECT count(*) FROM w) + 10000::DOUBLE)
        / ((s.n + 1::DOUBLE) * ((SELECT count(*) FROM b) + 10000::DOUBLE)))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket)),
x AS (SELECT rid, CAST(sum(gain) AS BIGINT) AS weight FROM w JOIN h USING (word) JOIN g USING (bucket) GROUP BY rid),
y AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000
        * ln(-ln((CAST('0x' || left(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 8) AS BIGINT) + 0.5::DOUBLE)
        / 4294967296::DOUBLE))) AS BIGINT) AS score FROM d LEFT JOIN x USING (rid)),
z AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place,
        count(*) OVER (PARTITION BY n_features >= 20) AS n FROM y)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM z"""


def _repair_sql() -> str:
    def keep(state: str, initial: str) -> str:
        return f"WHEN ini = '{initial}' THEN {{'c': more + {state}.c, 'a': 'K' || {state}.a}}"

    none = "{'c': 1000000000, 'a': ''}"

    def best(here: str, forced: str, kept: str) -> str:
        return (f"least({{'c': 4 + {here}.c, 'a': 'D' || {here}.a}}, CASE WHEN gone THEN {none} {kept} ELSE {none} END, "
                f"CASE WHEN gone THEN {none} ELSE {{'c': 3 + more + {forced}.c, 'a': 'R' || {forced}.a}} END)")

    def put(node: str, n: int = 1) -> str:
        return f"{{'c': {3 * n} + {node}.c, 'a': '{'I' * n}' || {node}.a}}"

    return rf"""
WITH RECURSIVE crcs AS ({_CRC_TABLE}),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
c AS (SELECT k.*, {_CRC.format('key')} % 20 AS code FROM k, crcs),
m AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
        CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS copy FROM c WHERE code <> 0),
o AS (SELECT *, dense_rank() OVER (ORDER BY conv_id) AS cid,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM m),
f AS (SELECT *, left(role, 1) AS ini, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
        WHEN row_number() OVER (PARTITION BY cid, role, text ORDER BY i) > 1 THEN 2
        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault,
        lag(left(role, 1)) OVER (PARTITION BY cid ORDER BY i) AS ahead FROM o),
facts AS (SELECT cid, any_value(conv_id) AS conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
        count(*) FILTER (ahead || ini NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM f GROUP BY cid),
dp AS (SELECT cid, n + 1 AS i, {{'c': 0, 'a': ''}} AS s0, {{'c': 6, 'a': 'II'}} AS s1, {{'c': 3, 'a': 'I'}} AS s2,
        {{'c': 0, 'a': ''}} AS s3 FROM facts
  UNION ALL
  SELECT cid, i, least(n0, {put('n2')}, {put('n3', 2)}), least(n1, {put('n2')}, {put('n3', 2)}),
         least(n2, {put('n3')}), least(n3, {put('n2')})
  FROM (SELECT cid, i, {best('s0', 's2', keep('s1', 's') + ' ' + keep('s2', 'u'))} AS n0, {best('s1', 's2', keep('s2', 'u'))} AS n1,
               {best('s2', 's3', keep('s3', 'a'))} AS n2, {best('s3', 's2', keep('s2', 'u'))} AS n3
        FROM (SELECT dp.cid, f.i, s0, s1, s2, s3, ini, fault IN (1, 2) AS gone, CASE WHEN fault = 3 THEN 3 ELSE 0 END AS more
              FROM dp JOIN f ON f.cid = dp.cid AND f.i = dp.i - 1))),
plan AS (SELECT cid, s0.c AS cost, s0.a AS audit FROM dp WHERE i = 1),
e AS (SELECT cid, k, substr(audit, k, 1) AS edit FROM (SELECT cid, audit, unnest(range(1, length(audit) + 1)) AS k FROM plan)),
n AS (SELECT *, count(*) FILTER (edit <> 'I') OVER (PARTITION BY cid ORDER BY k) AS at FROM e),
p AS (SELECT n.cid, n.k, n.edit, f.role, f.text, row_number() OVER w AS place, first_value(n.edit = 'K' AND f.ini = 's') OVER w AS s
      FROM n LEFT JOIN f ON f.cid = n.cid AND f.i = n.at AND n.edit <> 'I' WHERE n.edit <> 'D' WINDOW w AS (PARTITION BY n.cid ORDER BY n.k)),
r AS (SELECT cid, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - CASE WHEN s THEN 1 ELSE 0 END) % 2 = 1 THEN 'user'
        ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS repaired FROM p GROUP BY cid)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN plan USING (cid) LEFT JOIN r USING (cid)"""


ORACLE: dict[str, str] = {"op1_secret_scan": _secrets_sql(), "op2_ngram_jaccard": _JACCARD_SQL,
                          "op3_substring_dedup": _SUBSTRING_SQL, "op6_warc_fixity": _FIXITY_SQL,
                          "op9_exact_top_k": _TOP_K_SQL, "op11_chat_formatting": _chat_sql(),
                          "op12_importance_resampling": _RESAMPLE_SQL, "op13_conversation_repair": _repair_sql()}
