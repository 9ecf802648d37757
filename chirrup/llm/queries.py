"""The ten operators as registered queries over whole tables, with SQL checks where SQL can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chirrup.llm import decontaminate, fingerprints, labelled, language, licenses, middle, mixture, near_dup, passages, quality, shards, suffixes, toxicity, trie
from chirrup.llm.common import PLAIN_SQL, table
from chirrup.llm.license_texts import KNOWN
from chirrup.plans.registry import Query


def op1(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("digest")


def op2(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_classes(table(spark, folder, "documents")).drop("node")


def op3(spark: SparkSession, folder: str) -> DataFrame:
    return passages.repeated_passages(table(spark, folder, "documents"))


def op4(spark: SparkSession, folder: str) -> DataFrame:
    return mixture.mix(table(spark, folder, "documents")).select(
        "doc_id", "source", "size", "source_size", F.round("target", 6).alias("target"), "epochs", "taken")


def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    rest = labelled.fold(F.col("doc_id"), 4)
    langs, logp = language.learn(docs.where(rest != 2))
    return language.identify(docs, langs, logp, "doc_id").select("doc_id", (rest == 2).alias("held_out"), "lang_pred", "score", "langs", "shares")


def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    rest = labelled.fold(F.col("doc_id"), 5)
    model = quality.train(*labelled.labelled_sample(docs, labels, "quality", rest != 0))
    return quality.score(docs, model, "doc_id").select("doc_id", (rest == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    rest = labelled.fold(F.col("doc_id"), 5)
    model = toxicity.train(*labelled.labelled_sample(docs, labels, "toxic", rest != 0))
    scored = docs.select("doc_id", toxicity.toxic_score(model, F.col("text")).alias("score"))
    return scored.select("doc_id", (rest == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8(spark: SparkSession, folder: str) -> DataFrame:
    return shards.shard(table(spark, folder, "documents").select("doc_id", "text")).drop("text")


def op9(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, folder, "documents"))


def op10(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op11(spark: SparkSession, folder: str) -> DataFrame:
    made = table(spark, folder, "documents").select("doc_id", middle.fill_in_middle(F.col("text"), F.col("doc_id")).alias("m")).select("doc_id", "m.*")
    back = middle.restore(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


def op12(spark: SparkSession, folder: str) -> DataFrame:
    made = suffixes.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return made.select("row.doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op13(spark: SparkSession, folder: str) -> DataFrame:
    own = trie.paths(table(spark, folder, "conversations"))
    return trie.prefix_trie(trie.with_shared_start(own, 100, 5, F.crc32(F.col("conv_id").cast("string")))).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256")


OP1_SQL = f"""
WITH items AS (SELECT DISTINCT item_id, {PLAIN_SQL.format('text')} AS p FROM benchmark),
split AS (SELECT item_id, p, string_split(p, ' ') AS w FROM items WHERE p <> ''),
grams AS (
  SELECT item_id, p, list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + least(len(w), 5) - 1], ' '))) AS g FROM split),
docs AS (SELECT DISTINCT doc_id, {PLAIN_SQL.format('text')} AS p FROM documents),
held AS (
  SELECT doc_id, item_id, len(list_filter(g, lambda x: contains(' ' || docs.p || ' ', ' ' || x || ' '))) AS shared, len(g) AS n FROM docs, grams)
SELECT doc_id, item_id, CAST(shared AS INTEGER) AS shared, CAST(n AS INTEGER) AS item_shingles, shared / n AS containment
FROM held WHERE shared * 5 >= n * 4"""

OP2_SQL = f"""
WITH RECURSIVE rows AS (SELECT doc_id, {PLAIN_SQL.format('text')} AS p FROM documents),
texts AS (SELECT p, min(doc_id) AS id FROM rows WHERE p <> '' GROUP BY p),
split AS (SELECT id, string_split(p, ' ') AS w FROM texts),
gram AS (
  SELECT id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS g FROM split),
bag AS (SELECT id, g, count(*) AS n FROM gram GROUP BY id, g),
size AS (SELECT id, sum(n) AS n FROM bag GROUP BY id),
met AS (SELECT a.id AS a, b.id AS b, sum(least(a.n, b.n)) AS n FROM bag a JOIN bag b ON a.g = b.g AND a.id < b.id GROUP BY a.id, b.id),
link AS (SELECT a, b FROM met JOIN size x ON x.id = a JOIN size y ON y.id = b WHERE met.n * 5 >= (x.n + y.n - met.n) * 4),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT id AS a, id AS b FROM texts UNION SELECT reach.a, edge.b FROM reach JOIN edge ON edge.a = reach.b),
class AS (SELECT a AS id, min(b) AS class_id FROM reach GROUP BY a),
one AS (SELECT doc_id, p, count(*) AS copies FROM rows WHERE p <> '' GROUP BY doc_id, p)
SELECT one.doc_id, class_id, copies, one.doc_id = class_id AS kept
FROM one JOIN texts ON texts.p = one.p JOIN class ON class.id = texts.id
UNION ALL SELECT doc_id, doc_id, 1, true FROM rows WHERE p = ''"""

OP4_SQL = r"""
WITH rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         -ln((CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0)
         / CASE WHEN length(text) > 0 THEN greatest((length(text) - length(regexp_replace(text, '\p{L}', '', 'g'))) / length(text), 0.01) ELSE 0.01 END AS draw
  FROM documents),
total AS (
  SELECT source, sum(size) AS s, CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS w
  FROM rows GROUP BY source),
-- The level at which the capped shares add up: for every number of capped sources, most easily capped first.
step AS (
  SELECT *, 3.0 * s / w AS r, (SELECT sum(s) FROM total)
    - coalesce((SELECT sum(3.0 * b.s) FROM total b WHERE (3.0 * b.s / b.w, coalesce(b.source, chr(1114111))) < (3.0 * a.s / a.w, coalesce(a.source, chr(1114111)))), 0) AS open,
    (SELECT sum(b.w) FROM total b WHERE (3.0 * b.s / b.w, coalesce(b.source, chr(1114111))) >= (3.0 * a.s / a.w, coalesce(a.source, chr(1114111)))) AS weights
  FROM total a),
level AS (SELECT max(open / weights) AS v FROM step WHERE open / weights <= r),
target AS (SELECT source, s, least(3.0 * s, v * w) AS t FROM total, level),
plan AS (
  SELECT source, s, t, CASE WHEN s > 0 THEN least(CAST(floor(t / s + 1e-12) AS BIGINT), 3) ELSE 0 END AS epochs FROM target),
placed AS (
  SELECT rows.*, plan.s, plan.t, plan.epochs, greatest(CAST(round(plan.t - plan.epochs * plan.s) AS BIGINT), 0) AS rest,
         coalesce(sum(rows.size) OVER (PARTITION BY rows.source ORDER BY draw, rows.size, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior
  FROM rows JOIN plan ON rows.source IS NOT DISTINCT FROM plan.source)
SELECT doc_id, source, size, CAST(s AS BIGINT) AS source_size, round(t, 6) AS target, CAST(epochs AS BIGINT) AS epochs,
       CAST(epochs * size + least(greatest(rest - prior, 0), size) AS BIGINT) AS taken
FROM placed"""

OP8_SQL = f"""
WITH rows AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || coalesce('t' || md5(text), 'n')), 1, 15) AS BIGINT) AS h
  FROM documents),
tried AS (SELECT doc_id, h, bytes, d, h >> (60 - d) AS p FROM rows, range(0, 61) t(d)),
bucket AS (SELECT d, p, sum(bytes) AS bytes, count(*) AS n FROM tried GROUP BY d, p),
fit AS (
  SELECT t.doc_id, min_by(struct_pack(d := t.d, p := t.p, bytes := b.bytes, n := b.n), t.d) AS x
  FROM tried t JOIN bucket b ON b.d = t.d AND b.p = t.p WHERE b.bytes <= {shards.SHARD_BYTES} OR b.n = 1 GROUP BY t.doc_id, t.h)
SELECT doc_id, CASE WHEN x.d = 0 THEN '-' ELSE lpad(bin(x.p), CAST(x.d AS INTEGER), '0') END AS shard,
       CAST(x.bytes AS BIGINT) AS shard_bytes, x.n AS shard_rows FROM fit"""


def _canonical_sql(text: str) -> str:
    words = f"' ' || regexp_replace(lower({text}), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+', ' ', 'g') || ' '"
    for old, new in licenses.SPELLINGS:
        words = f"replace({words}, ' {old} ', ' {new} ')"
    return f"trim({words})"


# A copyright line, said without look-ahead: the sign or a year after the opening word, or the sign as the opening.
_NOTICE_SQL = (r"(?mi)^[^\p{L}\p{N}\n(©]*(?:\(c\)[^\n]*|©[^\n]*|copyright\b[^\n]*(?:\(c\)|©|\b(?:19|20)[0-9][0-9]\b)[^\n]*"
               r"|all rights reserved[^\p{L}\p{N}\n]*)$")
_KNOWN_SQL = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in KNOWN)
OP10_SQL = f"""
WITH known(license_id, wording) AS (VALUES {_KNOWN_SQL}),
wording AS (
  SELECT license_id, {_canonical_sql('wording')} AS c FROM known
  UNION SELECT license_id, {_canonical_sql(f"regexp_replace(wording, '{_NOTICE_SQL}', ' ', 'g')")} FROM known),
line AS (SELECT doc_id, len(string_split(text, chr(10))) AS n, unnest(string_split(text, chr(10))) AS unit FROM documents),
parts AS (
  SELECT doc_id, 'text' AS scope, text AS unit FROM documents
  UNION ALL SELECT doc_id, 'line', unit FROM line WHERE trim(unit) <> '' AND n > 1),
forms AS (SELECT doc_id, scope, {_canonical_sql('unit')} AS c, {_canonical_sql(f"regexp_replace(unit, '{_NOTICE_SQL}', ' ', 'g')")} AS bare FROM parts),
one AS (SELECT doc_id, scope, CASE WHEN c IN (SELECT c FROM wording) THEN c ELSE bare END AS c FROM forms)
SELECT doc_id, license_id, scope, count(*) AS matches FROM one JOIN wording USING (c) WHERE c <> '' GROUP BY doc_id, license_id, scope"""

_DRAW = ", ".join(f"CAST('0x' || substr(s, {1 + 8 * i}, 8) AS BIGINT) AS h{i + 1}" for i in range(4))
OP11_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u, {_DRAW} FROM d),
c AS (
  SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS lo, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS hi,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(u[1:lo], '') AS pre, array_to_string(u[lo + 1:hi], '') AS mid, array_to_string(u[hi + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM p"""

OP12_SQL = """
WITH d AS (SELECT doc_id, row_number() OVER () AS r, encode(coalesce(text, '')) AS x FROM documents),
w AS (SELECT r, i, md5(x[i + 1:i + 200]) AS k FROM (SELECT r, x, unnest(range(0, octet_length(x) - 199)) AS i FROM d)),
again AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1),
hit AS (SELECT r, i, i - lag(i, 1, -1000) OVER (PARTITION BY r ORDER BY i) > 200 AS fresh FROM w JOIN again USING (k)),
isle AS (SELECT r, i, count(*) FILTER (WHERE fresh) OVER (PARTITION BY r ORDER BY i) AS g FROM hit),
run AS (SELECT r, min(i) AS a, max(i) + 200 AS b FROM isle GROUP BY r, g),
part AS (SELECT r, a, b, x, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS before FROM run JOIN d USING (r)),
cut AS (
  SELECT r, count(*) AS n_spans, sum(b - a) AS n_removed, string_agg(hex(x[before + 1:a]), '' ORDER BY a) || hex(any_value(x)[max(b) + 1:]) AS kept FROM part GROUP BY r)
SELECT doc_id, CAST(octet_length(x) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       CASE WHEN cut.r IS NULL THEN sha256(x) ELSE sha256(unhex(kept)) END AS kept_sha256
FROM d LEFT JOIN cut USING (r)"""

# crc32 of the decimal id, bit by bit: a code is taken in, then eight shifts follow.
_CRC = """list_reduce(flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, 4294967295)"""
OP13_SQL = f"""
WITH own AS (
  SELECT conv_id, list(struct_pack(id := id, n := n) ORDER BY turn NULLS FIRST, id) AS p
  FROM (SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id, length(coalesce(text, '')) AS n
        FROM conversations WHERE conv_id IS NOT NULL) GROUP BY conv_id),
start AS (SELECT *, xor({_CRC}, 4294967295) % 6 AS h FROM own),
built AS (SELECT c.conv_id, list_concat(coalesce(f.p[1:c.h], []), c.p[c.h + 1:]) AS p FROM start c LEFT JOIN own f ON f.conv_id = c.conv_id - c.conv_id % 100),
keyed AS (SELECT conv_id, p, unnest(range(0, len(p) + 1)) AS d FROM built),
pre AS (
  SELECT conv_id, d, len(p) = d AS ends, p[d].n AS n, array_to_string(list_transform(p[1:d], lambda x: x.id), '') AS k,
         CASE WHEN d > 0 THEN array_to_string(list_transform(p[1:d - 1], lambda x: x.id), '') END AS above FROM keyed),
node AS (
  SELECT k, any_value(above) AS above, any_value(d) AS d, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(any_value(n), 0) AS n,
         sha256(coalesce(string_agg(CASE WHEN ends THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256 FROM pre GROUP BY k),
kids AS (SELECT above AS k, count(*) AS c FROM node WHERE above IS NOT NULL GROUP BY above),
under AS (
  SELECT a.k, count(*) FILTER (WHERE kids.c IS NULL) AS leaves, sum((node.n_convs - 1) * node.n) AS saved
  FROM node JOIN pre a ON a.conv_id = node.conv_id AND a.d <= node.d LEFT JOIN kids ON kids.k = node.k GROUP BY a.k)
SELECT node.conv_id, node.d AS depth, up.conv_id AS parent_conv_id, node.n_convs, coalesce(kids.c, 0) AS n_children,
       under.leaves AS n_leaves, CAST(under.saved AS BIGINT) AS saved_tokens, node.ends_sha256
FROM node JOIN under USING (k) LEFT JOIN kids ON kids.k = node.k LEFT JOIN node up ON up.k = node.above"""

QUERIES: dict[str, Query] = {
    "op1_decontamination": Query(op1, OP1_SQL),
    "op2_near_duplicates": Query(op2, OP2_SQL),
    "op3_repeated_passages": Query(op3),
    "op4_mixture": Query(op4, OP4_SQL),
    "op5_language": Query(op5),
    "op6_quality": Query(op6),
    "op7_toxicity": Query(op7),
    "op8_shards": Query(op8, OP8_SQL),
    "op9_fingerprints": Query(op9),
    "op10_licenses": Query(op10, OP10_SQL),
    "op11_fill_in_middle": Query(op11, OP11_SQL),
    "op12_suffix_dedup": Query(op12, OP12_SQL),
    "op13_prefix_trie": Query(op13, OP13_SQL),
}
