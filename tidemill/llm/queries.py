"""The opN queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, embed_dedup, lang_crf, license_scan, mixing, packing, prefix_trie, quality, simhash, spelling,
               substring, url_filter, warc)
from ._common import table
from .url_filter import UrlRule

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return deco


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# ---------------------------------------------------------------- op1

# The host rules of the contract.
HOST_RULES = [UrlRule("com/", "allow"), UrlRule("example.com/en/", "block"), UrlRule("www.example.com/en/", "allow"),
              UrlRule("net/es/", "block"), UrlRule("net/fr/", "block")]
# The method's own patterns, for urls that no host rule fits.
URL_PATTERNS = [UrlRule(p, "block", "pattern") for p in (
    "/ads/", "/adserver/", "^banner^", ".doubleclick.", "/tracking/", "/pixel^", "^login^", "/signin^", "/cart/",
    "/checkout/", ".casino.", ".bet/", "/wp-admin/", "/cgi-bin/", "^sex^", "^porn*.jpg", "/feed^", "/tag/*/page/")]
URL_RULES = HOST_RULES + URL_PATTERNS

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_RULE_ROWS = ", ".join(f"({_quoted(r.rule)}, {_quoted(r.action)}, {_quoted(r.kind)}, {_quoted(r.regex())})"
                       for r in URL_RULES)

OP1_SQL = f"""
WITH rules(rule, action, kind, regex) AS (VALUES {_RULE_ROWS}),
after AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM after),
urls AS (SELECT DISTINCT host, path FROM parts),
best AS (SELECT host, path, max({{'is_host': kind = 'host', 'n': length(rule), 'rule': rule, 'action': action}}) AS b
         FROM urls JOIN rules ON regexp_matches(host || path, regex) GROUP BY host, path)
SELECT page_id, host, path, CASE WHEN b.is_host THEN b.rule END AS rule, coalesce(b.action, 'allow') AS verdict,
       CASE WHEN NOT b.is_host THEN b.rule END AS pattern_rule
FROM parts LEFT JOIN best USING (host, path)
"""


@query("op1_url_filters", OP1_SQL)
def op1(spark, sf_dir):
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


# ---------------------------------------------------------------- op2, op3

@query("op2_substring_dedup")
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substring.dedup_substrings(docs)
    spans = F.col("substring_spans")
    return out.select("doc_id", "text", F.coalesce(F.size(spans), F.lit(0)).alias("n_removed"),
                      F.array_join(F.transform(spans, lambda s: F.concat(s["s"].cast("string"), F.lit("-"), s["e"].cast("string"))),
                                   ",").alias("removed_bytes"))


@query("op3_embedding_near_dedup")
def op3(spark, sf_dir):
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


# ---------------------------------------------------------------- op4

OP4_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM d GROUP BY payload_digest),
r AS (SELECT d.*, first_id, payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id AS again FROM d JOIN f USING (payload_digest))
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first_id END AS refers_to FROM r
"""


@query("op4_warc", OP4_SQL)
def op4(spark, sf_dir):
    archive = warc.write_archive(table(spark, sf_dir, "pages"))
    return warc.parse_records(warc.read_records(archive))


# ---------------------------------------------------------------- op5

OP5_SQL = r"""
WITH s AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
g AS (SELECT source, sum(size)::HUGEINT AS source_size FROM s GROUP BY source),
w AS (SELECT *, ([5, 2, 1])[((row_number() OVER (ORDER BY source ASC NULLS LAST)) - 1) % 3 + 1] AS weight,
             row_number() OVER (ORDER BY source ASC NULLS LAST) AS rn FROM g),
c AS (SELECT *, source_size * 3 AS cap, (source_size * 3 * (10 // weight))::HUGEINT AS met,
             (sum(source_size) OVER ())::HUGEINT AS total, sum(weight) OVER () AS all_weight FROM w),
b AS (SELECT *, coalesce(sum(cap) OVER v, 0) AS cap_before, coalesce(sum(weight) OVER v, 0) AS weight_before FROM c
      WINDOW v AS (ORDER BY met, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
k AS (SELECT *, cap * (all_weight - weight_before) <= weight * (total - cap_before) AS capped FROM b),
o AS (SELECT *, total - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER () AS rest,
             sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () AS open_weight FROM k),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE rest::DOUBLE * weight / open_weight END AS target FROM o),
r AS (SELECT *, CASE WHEN source_size > 0 THEN least(target / source_size, 3.0::DOUBLE) ELSE 0.0::DOUBLE END AS rate FROM t)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (size * (floor(rate) + CASE WHEN ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE
                                        < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM s JOIN r ON s.source IS NOT DISTINCT FROM r.source
"""


@query("op5_mixing", OP5_SQL)
def op5(spark, sf_dir):
    plan = mixing.mix_plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return plan.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                       F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"))


# ---------------------------------------------------------------- op6

@query("op6_nearest_neighbours")
def op6(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"))


# ---------------------------------------------------------------- op7

def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query("op7_packing")
def op7(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), default_tokenizer())


# ---------------------------------------------------------------- op8, op9

@query("op8_simhash_near_dedup")
def op8(spark, sf_dir):
    marked = simhash.simhash_components(table(spark, sf_dir, "documents"))
    return marked.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op9_quality_classifier")
def op9(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# ---------------------------------------------------------------- op10

_SIGNATURES = license_scan.signature_rules()
_SIG_ROWS = ", ".join(f"({_quoted(r.label)}, {_quoted(r.regex)}, {_quoted(r.keyword)}, {r.priority}, {r.score}::DOUBLE, {r.base})"
                      for r in _SIGNATURES)

OP10_SQL = rf"""
WITH rules(label, regex, keyword, priority, score, base) AS (VALUES {_SIG_ROWS}),
docs AS (SELECT row_number() OVER () AS rid, doc_id,
                list_filter(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
         FROM documents),
norm AS (SELECT rid, doc_id, len(words)::BIGINT AS n_words, words, ' ' || array_to_string(words, '  ') || ' ' AS norm FROM docs),
hit AS (SELECT rid, rules.*, norm FROM norm JOIN rules ON list_contains(words, keyword) AND regexp_matches(norm, regex)),
cut AS (SELECT rid, label, priority, score, base,
               list_transform(regexp_split_to_array(norm, regex), lambda p: (length(p) - length(replace(p, ' ', ''))) // 2) AS gaps,
               list_transform(regexp_extract_all(norm, regex), lambda p: (length(p) - length(replace(p, ' ', ''))) // 2) AS lens FROM hit),
num AS (SELECT *, unnest(range(1, len(lens) + 1)) AS k FROM cut),
det AS (SELECT rid, label, priority, score, base,
               (list_sum(gaps[1:k]) + coalesce(list_sum(lens[1:k - 1]), 0))::BIGINT AS s,
               (list_sum(gaps[1:k]) + list_sum(lens[1:k]))::BIGINT AS e FROM num),
run AS (SELECT *, coalesce(max(e) OVER (PARTITION BY rid ORDER BY s, e DESC, priority DESC, label, score, base
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS furthest FROM det),
agg AS (SELECT rid, count(*) FILTER (base) AS n_base, min(s) FILTER (base) AS first_word, max(s) FILTER (base) AS last_word,
               array_to_string(list_sort(list_distinct(list(label) FILTER (base))), ',') AS base_labels,
               array_to_string(list_sort(list_distinct(list(label) FILTER (base OR e > furthest))), ',') AS labels,
               max(score) FILTER (base OR e > furthest) AS score FROM run GROUP BY rid)
SELECT doc_id, n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM norm LEFT JOIN agg USING (rid)
"""


@query("op10_license_scans", OP10_SQL)
def op10(spark, sf_dir):
    return license_scan.scan_licenses(table(spark, sf_dir, "documents")).drop("detections")


# ---------------------------------------------------------------- op11

# CRC-32 in SQL: the table of its 256 steps, and a fold over a text's bytes
_CRC_TABLE = """crc AS (SELECT list(t ORDER BY n) AS t FROM (SELECT n, list_reduce(range(8), lambda c, k:
           CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n) AS t FROM range(256) r(n)))"""
_BYTES = "list_transform(range(length(hex(encode({0}))) // 2), lambda i: ('0x' || substr(hex(encode({0})), 2 * i + 1, 2))::BIGINT)"
_CRC = "xor(list_reduce(" + _BYTES + ", lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295)"

OP11_SQL = f"""
WITH {_CRC_TABLE},
t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':'
             || coalesce(role, '') || coalesce(text, ''))) AS pos, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS turn
      FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(turn ORDER BY pos) AS own FROM t GROUP BY conv_id),
h AS (SELECT conv_id, own, {_CRC.format("conv_id::VARCHAR")} % 9 AS h FROM c, crc),
r AS (SELECT h.conv_id, list_concat(coalesce(b.own, [])[1:h], h.own[h + 1:]) AS turns FROM h LEFT JOIN c b ON b.conv_id = h.conv_id - h.conv_id % 5),
p AS (SELECT conv_id, len(turns) AS n, unnest(range(len(turns) + 1)) AS depth, turns FROM r),
g AS (SELECT turns[1:depth] AS prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256 FROM p GROUP BY 1, 2),
k AS (SELECT prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM g WHERE depth > 0 GROUP BY 1),
v AS (SELECT g.*, coalesce(n_children, 0) AS n_children,
             CASE WHEN depth > 0 THEN (n_convs - 1) * octet_length(encode(prefix[depth].text)) ELSE 0 END AS saved FROM g LEFT JOIN k USING (prefix)),
u AS (SELECT prefix[1:unnest(range(depth + 1))] AS prefix, n_children, saved FROM v),
s AS (SELECT prefix, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM u GROUP BY 1)
SELECT v.conv_id, v.depth, up.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, saved_tokens, v.ends_sha256
FROM v JOIN s ON s.prefix = v.prefix LEFT JOIN v up ON v.depth > 0 AND up.depth = v.depth - 1 AND up.prefix = v.prefix[1:v.depth - 1]
"""


@query("op11_conversation_trie", OP11_SQL)
def op11(spark, sf_dir):
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


# ---------------------------------------------------------------- op12

@query("op12_language_id")
def op12(spark, sf_dir):
    return lang_crf.identify(table(spark, sf_dir, "documents"))


# ---------------------------------------------------------------- op13

OP13_SQL = rf"""
WITH RECURSIVE {_CRC_TABLE},
r AS (SELECT doc_id, {_LOWER.format("unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+'))")} AS run FROM documents),
d AS (SELECT run, coalesce(doc_id::VARCHAR, '') || ':' || run AS key, count(*) AS k FROM r GROUP BY doc_id, run),
h AS (SELECT run, k, {_CRC.format("key")} AS h FROM d, crc),
w AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, k FROM h),
v AS (SELECT word, sum(k)::BIGINT AS n FROM w WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
gap AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
hole AS (SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM gap),
near AS (SELECT x.word, x.n, y.word AS near, y.n AS near_n FROM hole x JOIN hole y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
         UNION ALL SELECT DISTINCT x.word, x.n, y.word, y.n FROM hole x JOIN v y ON y.word = x.a || x.b
         UNION ALL SELECT DISTINCT y.word, y.n, x.word, x.n FROM hole x JOIN v y ON y.word = x.a || x.b),
top AS (SELECT word, n, count(*) AS n_near, min({{'minus': -near_n, 'near': encode(near)}}) AS t FROM near GROUP BY word, n),
f AS (SELECT word, n_near, CASE WHEN -t.minus >= 5 * n THEN decode(t.near) END AS form, CASE WHEN -t.minus >= 5 * n THEN -t.minus END AS form_n FROM top),
chain AS (SELECT word, form AS at FROM f WHERE form IS NOT NULL
          UNION ALL SELECT chain.word, f.form FROM chain JOIN f ON f.word = chain.at WHERE f.form IS NOT NULL),
root AS (SELECT chain.word, chain.at AS root FROM chain LEFT JOIN f ON f.word = chain.at WHERE f.form IS NULL)
SELECT v.word, f.form, coalesce(root.root, v.word) AS root, v.n, coalesce(f.n_near, 0) AS n_near, f.form_n
FROM v LEFT JOIN f USING (word) LEFT JOIN root USING (word)
"""


@query("op13_spelling_variants", OP13_SQL)
def op13(spark, sf_dir):
    return spelling.spelling_forms(table(spark, sf_dir, "documents"))
