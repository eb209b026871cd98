"""One registered query for each corpus operator, over its whole table, and check SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.llm import ann, chat, decontam, licenses, neardup, packing, pii, quality, repair, suffixes, toxicity, trie, warc
from ladle.llm.common import read, stage


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(read(spark, sf_dir, "documents"))


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stage(pii.with_candidates(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "_cands"), "pii")
    return pii.report(found, pii.fit(found))


def op4_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(read(spark, sf_dir, "documents"), percent=85)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.fit(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", (quality.fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                         (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.sql("SELECT * FROM VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), (-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') "
                      "AS t(conv_id, turn, role, text)")
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digest(chat.format_conversations(rows))


def op10_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), share=0.8)


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    sequences, convs = trie.lend(stage(trie.turns(read(spark, sf_dir, "conversations")), "own"))
    return trie.nodes(sequences, convs)


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.report(read(spark, sf_dir, "conversations"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", (toxicity.fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_ann, op3_pii, op4_neardup, op5_packing, op6_warc, op7_licenses, op8_quality, op9_chat, op10_decontam, op11_trie, op12_repair,
                                   op13_toxicity)}

_ESC = "coalesce({}, '')"
for _raw, _coded in chat.ESCAPES:
    _ESC = f"replace({_ESC}, '{_raw}', '{_coded}')"

_WORDS = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \\t\\n\\x0b\\f\\r]+'), lambda w: w <> '')"


def _shingled(table: str, key: str) -> str:
    return f"""SELECT DISTINCT {key}, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM (SELECT {key}, {_WORDS} AS w FROM {table})"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII string, bit by bit: each character, then seven more shifts."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda x: [ascii(x)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))"
    step = "(xor(a, x) >> 1)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda a, x: xor({step}, 3988292384 * (xor(a, x) & 1))), 4294967295::BIGINT)"


_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES = {
    "op12_repair": f"""
        WITH RECURSIVE raw AS (SELECT conv_id AS c, turn, coalesce(role, ' ') AS r, coalesce(text, ' ') AS t,
            {_crc32("(conv_id::VARCHAR || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS k FROM conversations WHERE conv_id IS NOT NULL),
        hurt AS (SELECT c, turn, CASE WHEN k = 4 THEN 'user' ELSE r END AS r, CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(t, '[.!?]', '', 'g') ELSE t END AS t,
            unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy FROM raw WHERE k <> 0),
        x AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, r, t) AS i, rtrim(t, {_BLANKS}) AS e FROM hurt),
        y AS (SELECT *, left(r, 1) AS f, row_number() OVER (PARTITION BY c, r, t ORDER BY i) > 1 AS seen, lag(left(r, 1)) OVER (PARTITION BY c ORDER BY i) AS was FROM x),
        z AS (SELECT *, CASE WHEN e = '' THEN 'blank' WHEN seen THEN 'duplicate' WHEN right(e, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM y),
        moves AS (SELECT * FROM (VALUES (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3), (0, 's', 1)) m(st, emit, nxt)),
        size AS (SELECT c, max(i) AS n FROM z GROUP BY c),
        w AS (SELECT c, 0::BIGINT AS i, 0 AS st, 0::BIGINT AS cost, '' AS audit FROM size UNION ALL
            SELECT c, i + 1, st, (min(b)).cost, (min(b)).audit FROM (
                SELECT v.c, v.i, coalesce(m.nxt, v.st) AS st, {{'cost': v.cost + CASE WHEN m.nxt IS NULL THEN 3 ELSE (CASE WHEN m.emit = z.f THEN 0 ELSE 2 END) + (fault = 'truncated')::INT END,
                    'audit': v.audit || CASE WHEN m.nxt IS NULL THEN 'D' WHEN m.emit = z.f THEN 'K' ELSE 'R' END}} AS b
                FROM (SELECT c, i, st, cost, audit FROM w UNION ALL SELECT w.c, w.i, m.nxt, w.cost + 2, w.audit || 'I' FROM w JOIN moves m ON m.st = w.st AND m.emit <> 's') v
                JOIN z ON z.c = v.c AND z.i = v.i + 1
                JOIN (SELECT * FROM moves UNION ALL SELECT NULL, NULL, NULL) m ON m.nxt IS NULL OR (m.st = v.st AND fault NOT IN ('blank', 'duplicate') AND (m.emit <> 's' OR z.f = 's'))
            ) GROUP BY c, i, st),
        finish AS (SELECT c, min({{'cost': cost + 2 * length(more), 'audit': audit || more}}) AS b FROM (
            SELECT w.c, cost, audit, CASE st WHEN 0 THEN '' WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END AS more FROM w JOIN size ON size.c = w.c AND w.i = size.n) GROUP BY c),
        letters AS (SELECT c, b.audit AS audit, unnest(range(1, length(b.audit) + 1)) AS k FROM finish),
        placed AS (SELECT c, k, substr(audit, k, 1) AS o, length(replace(substr(audit, 1, k), 'I', '')) AS i, length(replace(substr(audit, 1, k), 'D', '')) AS p, length(replace(audit, 'D', '')) % 2 AS odd FROM letters),
        fixed AS (SELECT placed.c, p, CASE WHEN o = 'K' THEN z.r WHEN (p - odd) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN o = 'I' THEN '' ELSE z.t END AS line
            FROM placed LEFT JOIN z ON z.c = placed.c AND z.i = placed.i WHERE o <> 'D'),
        said AS (SELECT c, string_agg(line, chr(10) ORDER BY p) AS t FROM fixed GROUP BY c),
        n AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
            count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (was || f NOT IN ('su', 'ua', 'au')) AS illegal FROM z GROUP BY c)
        SELECT o.c AS conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
            coalesce(b.cost, 0)::BIGINT AS cost, coalesce(b.audit, '') AS audit, sha256(coalesce(said.t, '')) AS repaired_sha256
        FROM (SELECT DISTINCT c FROM raw) o LEFT JOIN n ON n.c = o.c LEFT JOIN finish ON finish.c = o.c LEFT JOIN said ON said.c = o.c""",
    "op11_trie": f"""
        WITH o AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS t,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i FROM conversations WHERE conv_id IS NOT NULL),
        k AS (SELECT c, c - c % 5 AS base, {_crc32("c::VARCHAR")} % 9 AS h FROM (SELECT DISTINCT c FROM o)),
        x AS (SELECT k.c, 0 AS own, i, r, t FROM k JOIN o ON o.c = base AND i <= h UNION ALL SELECT k.c, 1, i, r, t FROM k JOIN o ON o.c = k.c AND i > h),
        p AS (SELECT c, row_number() OVER w AS d, octet_length(encode(t)) AS b, list({{'r': r, 't': t}}) OVER w AS pre, count(*) OVER (PARTITION BY c) AS n
            FROM x WINDOW w AS (PARTITION BY c ORDER BY own, i)),
        q AS (SELECT c, d, b, pre, n FROM p UNION ALL SELECT k.c, 0, 0, [], coalesce(n, 0) FROM k LEFT JOIN (SELECT c, max(n) AS n FROM p GROUP BY c) s ON s.c = k.c),
        v AS (SELECT d, pre, min(c) AS rep, count(*) AS n, max(b) AS b, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (q.n = d) AS ends FROM q GROUP BY d, pre),
        m AS (SELECT q.c, q.d, v.rep FROM q JOIN v ON q.d = v.d AND q.pre = v.pre),
        e AS (SELECT v.*, u.rep AS parent FROM v LEFT JOIN m u ON u.c = v.rep AND u.d = v.d - 1),
        f AS (SELECT e.d, e.rep, e.parent, e.n, e.b, e.ends, count(g.rep) AS kids FROM e LEFT JOIN e g ON g.d = e.d + 1 AND g.parent = e.rep GROUP BY ALL),
        s AS (SELECT m.d, m.rep, count(*) FILTER (w.kids = 0) AS n_leaves, sum((w.n - 1) * w.b)::BIGINT AS saved FROM m JOIN f w ON w.rep = m.c AND w.d >= m.d GROUP BY m.d, m.rep)
        SELECT f.rep AS conv_id, f.d AS depth, f.parent AS parent_conv_id, f.n AS n_convs, f.kids AS n_children, n_leaves, saved AS saved_tokens,
            sha256(coalesce(f.ends, '')) AS ends_sha256 FROM f JOIN s USING (d, rep)""",
    "op6_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
        h AS (SELECT page_id, n, sha256(body) AS d FROM p),
        f AS (SELECT d, min(page_id) AS first FROM h WHERE n >= 100 GROUP BY d)
        SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN first < page_id THEN first END AS refers_to FROM h LEFT JOIN f USING (d)""",
    "op9_chat": f"""
        WITH c AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL
            SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))),
        t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, {_ESC.format('text')} AS body, {_ESC.format('role')} AS r,
            lag(coalesce(role, '')) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS was FROM c)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(length(body) + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE 14 + length(r) END)::BIGINT AS formatted_chars,
            bool_and(CASE WHEN was IS NULL THEN role IN ('system', 'user') WHEN was IN ('system', 'assistant') THEN role = 'user'
                WHEN was = 'user' THEN role = 'assistant' ELSE FALSE END) AS valid
        FROM t GROUP BY conv_id""",
    "op10_decontam": f"""
        WITH few AS (SELECT item_id, len(w) AS n, array_to_string(w, ' ') AS s FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) BETWEEN 1 AND 4),
        runs AS (SELECT DISTINCT doc_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS s
            FROM (SELECT doc_id, {_WORDS} AS w FROM documents), (SELECT DISTINCT n FROM few) WHERE len(w) >= n),
        d AS ({_shingled('documents', 'doc_id')}), i AS ({_shingled("(SELECT * FROM benchmark WHERE item_id NOT IN (SELECT item_id FROM few))", 'item_id')}),
        n AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY item_id),
        b AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN i USING (s) GROUP BY doc_id, item_id)
        SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment FROM b JOIN n USING (item_id) WHERE n_shared * 1000 >= n_item * 800
        UNION ALL SELECT DISTINCT doc_id, item_id, 1, 1, 1.0 FROM runs JOIN few USING (n, s)""",
}
