"""The registered queries of this subpackage and the SQL of those that SQL
can express (DuckDB, over the same tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import (exact_dedup, langid, licenses, line_dedup, merkle, mixing, packing, pii, simhash, sketch, spelling,
                           url_rules, warc)
from meterlake.llm.common import scratch, table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = simhash.cluster(table(spark, sf_dir, "documents"))
    return c.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.col("component").alias("component_id"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = pii.detect(table(spark, sf_dir, "documents"))
    counts = [F.size(F.col("base")[k]).cast("long").alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    return d.select(F.col("id").alias("doc_id"), *counts, F.sha2(pii.span_text("base"), 256).alias("base_sha256"),
                    pii.span_text("spans").alias("spans"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.captures(warc.read_archives(spark, path)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), ["doc_id", "source", "text"])


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out())
    return langid.predict(docs, langid.fit(docs.filter("not held_out")), ["doc_id", "held_out"])


def op6_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = sketch.compare_edited(table(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_chars", "edited_sha256", sketch.as_text("sketch").alias("fingerprint"),
                    sketch.as_text("edited_sketch").alias("edited_fingerprint"), "near_edited", "near_next")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), url_rules.rule_table(spark), ["page_id"])


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = exact_dedup.assign(table(spark, sf_dir, "documents"))
    # rows that equal the best in id, length and text all are it
    kept = (F.col("_k1") == F.col("keep._k1")) & (F.col("_k2") == F.col("keep._k2"))
    return d.select(F.col("id").alias("doc_id"), F.col("keep.id").alias("keep_id"), F.col("size").alias("group_size"),
                    kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return d.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = merkle.audit(table(spark, sf_dir, "documents"))
    return m.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("path")), 256).alias("proof_sha256"),
                    "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {f.__name__: f for f in (
    op1_simhash, op2_pii, op3_warc, op4_poisson_mix, op5_language, op6_sketch, op7_license_scan, op8_url_rules,
    op9_packing, op10_exact_dedup, op11_spelling, op12_line_dedup, op13_merkle)}


def _op3_sql() -> str:
    digits = " || ".join(
        f"substr('{warc.BASE32}', (((('0x' || substr(h, {10 * p + 1}, 10))::BIGINT) >> {35 - 5 * i}) & 31)::INT + 1, 1)"
        for p in range(4) for i in range(8))
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
q AS (SELECT page_id, octet_length(encode(t))::BIGINT AS payload_bytes, sha1(t) AS h,
             min(page_id) OVER (PARTITION BY t) AS least FROM p)
SELECT page_id, payload_bytes, {digits} AS payload_digest,
       CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> least THEN least END AS refers_to
FROM q"""


_OP4_SQL = f"""
WITH d AS (SELECT doc_id, source, text, length(coalesce(text, '')) + 1 AS size,
                  md5(coalesce(doc_id::VARCHAR, 'text:' || coalesce(text, ''))) AS own,
                  ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, 'text:' || coalesce(text, ''))), 1, 13))::BIGINT
                      / {float(1 << 52)} AS u FROM documents),
s AS (SELECT source, sum(size)::DOUBLE AS size, pow(sum(size)::DOUBLE, {mixing.TEMPER}) AS raw FROM d GROUP BY source),
r AS (SELECT source, raw / sum(raw) OVER () * (sum(size) OVER () * {mixing.EPOCHS}) / size AS rate FROM s),
k AS (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 40)::BIGINT + 1)) AS k FROM r),
p AS (SELECT source, k, exp(k * ln(rate) - rate - sum(ln(greatest(k, 1)::DOUBLE)) OVER (PARTITION BY source ORDER BY k)) AS p FROM k),
c AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM p),
n AS (SELECT d.doc_id, d.source, d.text, d.own, (SELECT count(*) FROM c WHERE c.source IS NOT DISTINCT FROM d.source AND c.c <= d.u) AS n FROM d)
SELECT doc_id, source, text, unnest(range(1, n + 1)) AS copy FROM n WHERE n > 0"""


def _op7_sql() -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    pairs = lambda d: "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in d.items()) + "}"
    listed = lambda xs: "(" + ", ".join(map(q, xs)) + ")"
    known = licenses.known_sentences()
    names = {"".join(i + ";" for i in ids): n for n, ids in licenses.rules()}
    text = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    for pattern, to in licenses.STEPS:
        text = f"regexp_replace({text}, {q(pattern)}, {q(to)}, 'g')"
    return f"""
WITH a AS (SELECT row_number() OVER () AS rid, doc_id, trim({text}, ' ' || chr(10) || 'P') AS t FROM documents),
s AS (SELECT rid, string_split(unnest(string_split(t, 'P')), chr(10)) AS own, generate_subscripts(string_split(t, 'P'), 1) AS sn FROM a),
l AS (SELECT rid, sn, own, unnest(range(1, len(own) + 1)) AS i FROM s),
o AS (SELECT * FROM l WHERE own[i] IN {listed(licenses.openers())} OR array_to_string(
        string_split(own[i] || coalesce(' ' || own[i + 1], ''), ' ')[1:2], ' ') IN {listed(licenses.openers())}),
c AS (SELECT rid, sn, own, i, unnest(range(1, least(len(own) - i + 1, {licenses.longest()}) + 1)) AS n FROM o),
m AS (SELECT rid, sn, i, max(n) AS n, arg_max(cand, n) AS cand FROM (SELECT *, array_to_string(own[i:i + n - 1], ' ') AS cand FROM c)
      WHERE cand IN {listed(known)} GROUP BY rid, sn, i),
k AS (SELECT *, coalesce(max(i + n) OVER (PARTITION BY rid, sn ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > i, false) AS inside FROM m),
f AS (SELECT rid, string_agg({pairs(known)}[cand] || ';', '' ORDER BY sn, i) AS ids FROM k WHERE NOT inside GROUP BY rid),
d AS (SELECT a.doc_id, CASE WHEN t = '' THEN 0 ELSE length(t) - length(translate(t, chr(10) || 'P', '')) + 1 END::BIGINT AS n_sentences,
        coalesce(f.ids, '') AS sentence_ids, regexp_extract_all(coalesce(f.ids, ''), {q(licenses.rule_pattern())}) AS m
      FROM a LEFT JOIN f ON f.rid = a.rid)
SELECT doc_id, n_sentences, sentence_ids,
    coalesce(array_to_string(list_sort(list_distinct(list_transform(m, lambda x: {pairs(names)}[x]))), ','), '') AS licenses,
    len(m)::BIGINT AS n_matches FROM d"""


_OP8_SQL = f"""
WITH r(verdict, rh, rp) AS (VALUES {", ".join(str(tuple(r)) for r in url_rules.RULES)}),
u AS (SELECT page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
j AS (SELECT u.*, r.rh || r.rp AS rule, r.verdict,
        row_number() OVER (PARTITION BY page_id ORDER BY length(r.rh || r.rp) DESC NULLS LAST, length(r.rh) DESC, r.verdict DESC) AS n
      FROM u LEFT JOIN r ON (u.host = r.rh OR ends_with(u.host, '.' || r.rh)) AND starts_with(u.path, r.rp))
SELECT page_id, host, path, rule, coalesce(verdict, '{url_rules.DEFAULT}') AS verdict FROM j WHERE n = 1"""

_OP10_SQL = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
             regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents),
g AS (SELECT *, count(*) OVER (PARTITION BY t) AS group_size,
        first_value(doc_id) OVER (PARTITION BY t ORDER BY chars DESC, doc_id) AS keep_id FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g"""

_OP12_SQL = f"""
WITH l AS (SELECT rid, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM (
        SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(coalesce(doc_id, {-(1 << 63)})) AS keeper FROM k WHERE length(key) >= {line_dedup.MIN_CHARS}
      GROUP BY key HAVING count(DISTINCT rid) >= {line_dedup.MIN_DOCS})
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM (SELECT k.*, c.key IS NOT NULL AND coalesce(doc_id, {-(1 << 63)}) <> c.keeper AS gone FROM k LEFT JOIN c ON k.key = c.key)
GROUP BY rid"""


def _op13_sql() -> str:
    """Both trees as recursive queries: runs of three are hashed until one node
    is left, and every row's tampered leaf is folded along them."""
    def enc(c: str) -> str:
        return f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join([enc("doc_id"), enc("source"), enc("lang"), enc("n_chars"), enc(text)]) + ")"

    # CRC-32 of an id's decimal digits, bit by bit
    bits = "list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, _: xor(y >> 1, 3988292384 * (y & 1)))"
    crc = ("xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), "
           f"lambda s: ascii(s)::BIGINT)), lambda c, x: {bits}))")
    # a tree: nodes (g, i, h), the tracked items (item, g, i, acc, proof) and their levels
    tree = """
{t}_n AS (SELECT g, 0 AS lv, i, h, cnt FROM {t}_0 UNION ALL
  SELECT g, lv + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (any_value(cnt) + 2) // 3
  FROM {t}_n WHERE cnt > 1 GROUP BY g, lv, i // 3),
{t}_run AS (SELECT g, lv, i // 3 AS run, list(h ORDER BY i) AS hs FROM {t}_n WHERE cnt > 1 GROUP BY g, lv, i // 3),
{t}_fold AS (SELECT item, g, 0 AS lv, i, acc, '' AS proof FROM {t}_items UNION ALL
  SELECT f.item, f.g, f.lv + 1, f.i // 3,
         sha256(array_to_string(list_concat(hs[1:f.i % 3], [f.acc], hs[f.i % 3 + 2:]), '')),
         f.proof || array_to_string(list_concat(hs[1:f.i % 3], hs[f.i % 3 + 2:]), '')
  FROM {t}_fold f JOIN {t}_run r ON r.g = f.g AND r.lv = f.lv AND r.run = f.i // 3),
{t}_end AS (SELECT item, arg_max(acc, lv) AS acc, arg_max(proof, lv) AS proof FROM {t}_fold GROUP BY item),
{t}_root AS (SELECT g, arg_max(h, lv) AS root FROM {t}_n WHERE cnt = 1 GROUP BY g)"""
    return f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, source, text, {leaf("text")} AS leaf,
    CASE WHEN ({crc}) % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS seen,
    CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS g FROM documents),
n AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS i, count(*) OVER (PARTITION BY g) AS cnt FROM d),
a_0 AS (SELECT g, i, leaf AS h, cnt FROM n),
a_items AS (SELECT rid AS item, g, i, seen AS acc FROM n),{tree.format(t="a")},
b_0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY encode(g)) - 1 AS i, root AS h, count(*) OVER () AS cnt, g AS source FROM a_root),
b_items AS (SELECT n.rid AS item, 0 AS g, b_0.i, e.acc FROM n JOIN b_0 ON b_0.source = n.g JOIN a_end e ON e.item = n.rid),{tree.format(t="b")}
SELECT n.doc_id, n.leaf, b_0.h AS subroot, r.root, sha256(e.proof || f.proof) AS proof_sha256, f.acc AS folded_root, f.acc = r.root AS verified
FROM n JOIN a_end e ON e.item = n.rid JOIN b_end f ON f.item = n.rid JOIN b_0 ON b_0.source = n.g JOIN b_root r ON r.g = 0"""


ORACLE_SQL = {"op3_warc": _op3_sql(), "op4_poisson_mix": _OP4_SQL, "op7_license_scan": _op7_sql(),
              "op8_url_rules": _OP8_SQL, "op10_exact_dedup": _OP10_SQL, "op12_line_dedup": _OP12_SQL, "op13_merkle": _op13_sql()}
