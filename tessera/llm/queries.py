"""One query for each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontamination, jaccard_join, language_id, line_dedup, merkle, packing, periodic_runs, pii, quality_classifier, quality_rules, sharding, suffix_dedup, url_filters


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of each document under a model of trusted text, and the verdict by its language's threshold."""
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of 2,048 tokens, mixed in the proportions of the sources."""
    return packing.pack(table(spark, sf_dir, "documents")).drop("ids", "source")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics, base rules and the isolation forest's verdict on each document."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", F.round("anomaly", 6).alias("anomaly"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with a Jaccard similarity of 0.9 or more over three-word shingles."""
    return jaccard_join.cluster(table(spark, sf_dir, "documents"), words=3, percent=90)


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents WHERE doc_id IS NOT NULL
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 90 * (x.n + y.n - shared)),
r(doc_id, reached) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.reached)
SELECT r.doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(reached) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each document, learned from the four fifths that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model, names = language_id.train(docs.where(~held_out))
    out = language_id.identify(docs.select("doc_id", "text"), model, names)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item in every document, with up to 5 % of its bytes edited."""
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of each page's URL."""
    return url_filters.judge(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document without the 50-byte strings that an earlier document has."""
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"), length=50).drop("kept")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with pseudonyms for its personal data, and how many values of each kind were replaced."""
    out = pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), pii.session_key(spark))
    return out.select("doc_id", "text", *[F.coalesce(F.try_element_at("pii", F.lit(k)), F.lit(0)).cast("long").alias(f"n_{k}") for k in pii.PATTERNS])


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document without the lines that are equal or within an edit for each ten characters, two at most, to an earlier one of the corpus."""
    return line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), edits=2)


WORD = r"[^\x20\x09-\x0D]"


def rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality rules' statistics alone, which SQL can express."""
    stats = quality_rules.with_statistics(table(spark, sf_dir, "documents"), ["doc_id"])
    return stats.select("doc_id", *quality_rules.COUNTS, "base_failed")


RULE_COUNTS_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}+') AS ws FROM documents),
g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 1))) AS i FROM d WHERE len(ws) >= 3)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM twice, (SELECT unnest(range(3)) AS o) GROUP BY doc_id),
l AS (SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{WORD}')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM l GROUP BY doc_id),
c AS (SELECT d.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[ 	-
]', '', 'g'))::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c
"""


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path and rule of each page's URL, and the rule's verdict (none where none fits)."""
    out = url_filters.with_features(table(spark, sf_dir, "pages").select("page_id", "url"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("__verdict", F.lit("none")).alias("by_rule"))


URL_RULES_SQL = r"""
WITH p AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(verdict, rh, rp) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
f AS (SELECT page_id, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(verdict, length(rh || rp)) AS verdict FROM h JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id)
SELECT h.page_id, host, path, f.rule, coalesce(f.verdict, 'none') AS by_rule FROM h LEFT JOIN f USING (page_id)
"""

OP8_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents WHERE doc_id IS NOT NULL),
p AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(greatest(length(h) // 2 - 49, 0))) AS i FROM d)),
f AS (SELECT s, min(doc_id) AS owner FROM p GROUP BY s HAVING min(doc_id) < max(doc_id)),
x AS (SELECT p.doc_id, p.i FROM p JOIN f USING (s) WHERE f.owner < p.doc_id),
n AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS new FROM x),
g AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM n),
r AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS e FROM g GROUP BY doc_id, g),
k AS (SELECT r.doc_id, a, e, substr(h, 2 * coalesce(lag(e) OVER w, 0) + 1, 2 * (a - coalesce(lag(e) OVER w, 0))) AS piece FROM r JOIN d USING (doc_id) WINDOW w AS (PARTITION BY r.doc_id ORDER BY a)),
m AS (SELECT doc_id, sum(e - a)::BIGINT AS n_removed, count(*) AS n_spans, string_agg(piece, '' ORDER BY a) AS head, max(e) AS last FROM k GROUP BY doc_id)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256 FROM d LEFT JOIN m USING (doc_id)
"""


def line_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of each document and how many of them are copies of an earlier one, which SQL can express."""
    out = line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), edits=2)
    return out.select("doc_id", "n_lines", "n_copies")


LINE_COPIES_SQL = rf"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS no FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL),
c AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, row_number() OVER (PARTITION BY line ORDER BY doc_id, no) AS k FROM l WHERE regexp_matches(line, '{WORD}')) WHERE k > 1 GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) END::BIGINT AS n_lines, coalesce(c.n, 0) AS n_copies FROM documents d LEFT JOIN c USING (doc_id)
"""


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def crc32_of_id() -> Column:
    """The unsigned CRC-32 of the decimal doc_id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of each document, and the root its siblings give after a third of the texts were lower-cased."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.when(crc32_of_id() % 3 == 0, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    out = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], changed={"text": tampered})
    out = out.withColumn("proof_sha256", merkle.digest(merkle.siblings(F.col("path")))).withColumn("folded_root", merkle.folded(F.col("changed_leaf"), F.col("path")))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _crc_sql(of_bytes: str) -> str:
    """DuckDB: the CRC-32 of a list of bytes (UBIGINT), by the sums of the remainders of each byte's bits."""
    bits = [0xEDB88320]
    for _ in range(7):
        bits.insert(0, bits[0] >> 1 ^ (0xEDB88320 if bits[0] & 1 else 0))
    table = "0::UBIGINT"
    for k, v in enumerate(bits):
        table = f"xor({table}, ((xor(c, b) >> {k}) & 1) * {v}::UBIGINT)"
    return f"xor(list_reduce([4294967295::UBIGINT] || {of_bytes}, lambda c, b: xor(c >> 8, {table})), 4294967295::UBIGINT)"


CRC_OF_ID = _crc_sql("list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)")


def _leaf_sql(text: str) -> str:
    field = lambda v: f"coalesce(strlen({v}::VARCHAR)::VARCHAR || ':' || {v}::VARCHAR, '-')"
    return "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


OP11_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce('=' || lang, '') AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n,
  {_leaf_sql('text')} AS leaf, CASE WHEN {CRC_OF_ID} % 3 = 0 THEN {_leaf_sql(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {_leaf_sql('text')} END AS changed FROM documents),
l(g, level, i, n, h) AS (SELECT g, 0, i, n, leaf FROM d UNION ALL SELECT g, level + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM l WHERE n > 1 GROUP BY g, level, i // 8, n),
s AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM l WHERE n = 1),
t(level, i, n, h) AS (SELECT 0, i, n, subroot FROM s UNION ALL SELECT level + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM t WHERE n > 1 GROUP BY level, i // 8, n),
steps AS (
  SELECT g, 0 AS tier, level, p.i, string_agg(q.h, '' ORDER BY q.i) FILTER (WHERE q.i < p.i) AS a, string_agg(q.h, '' ORDER BY q.i) FILTER (WHERE q.i > p.i) AS b
  FROM l p JOIN l q USING (g, level) WHERE p.n > 1 AND p.i // 8 = q.i // 8 GROUP BY ALL
  UNION ALL SELECT '', 1, level, p.i, string_agg(q.h, '' ORDER BY q.i) FILTER (WHERE q.i < p.i), string_agg(q.h, '' ORDER BY q.i) FILTER (WHERE q.i > p.i)
  FROM t p JOIN t q USING (level) WHERE p.n > 1 AND p.i // 8 = q.i // 8 GROUP BY ALL),
f(doc_id, g, leaf, subroot, tier, level, i, n, top_i, top_n, proof, h) AS (
  SELECT doc_id, d.g, leaf, subroot, 0, 0, d.i, d.n, s.i, s.n, '', changed FROM d JOIN s USING (g)
  UNION ALL SELECT doc_id, f.g, leaf, subroot, CASE WHEN f.n = 1 THEN 1 ELSE f.tier END, CASE WHEN f.n = 1 THEN 0 ELSE f.level + 1 END,
    CASE WHEN f.n = 1 THEN top_i ELSE f.i // 8 END, CASE WHEN f.n = 1 THEN top_n ELSE (f.n + 7) // 8 END, top_i, top_n,
    CASE WHEN f.n = 1 THEN proof ELSE proof || coalesce(a, '') || coalesce(b, '') END, CASE WHEN f.n = 1 THEN h ELSE sha256(coalesce(a, '') || h || coalesce(b, '')) END
  FROM f LEFT JOIN steps x ON x.tier = f.tier AND x.level = f.level AND x.i = f.i AND x.g = CASE WHEN f.tier = 0 THEN f.g ELSE '' END WHERE f.n > 1 OR f.tier = 0)
SELECT doc_id, leaf, subroot, (SELECT h FROM t WHERE n = 1) AS root, sha256(proof) AS proof_sha256, h AS folded_root, h = (SELECT h FROM t WHERE n = 1) AS verified FROM f WHERE tier = 1 AND n = 1
"""


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in one of 40 shards that hold the sources in the same proportions, their counts of rows at most one apart."""
    out = sharding.assign(table(spark, sf_dir, "documents"), n_shards=40)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")


OP12_SQL = rf"""
WITH d AS (SELECT doc_id, source, hex(encode(coalesce(text, ''))) AS x FROM documents),
b AS (SELECT doc_id, source, length(x) // 2 + 16 AS size, {_crc_sql("list_transform(regexp_extract_all(x, '..'), lambda h: ('0x' || h)::UBIGINT)")} AS text_crc32 FROM d),
r AS (SELECT *, ((row_number() OVER (PARTITION BY source ORDER BY md5('{sharding.SEED}:' || coalesce(doc_id::VARCHAR, '')), doc_id, text_crc32) - 1)::DOUBLE
  + ('0x' || substr(md5('{sharding.SEED}:' || coalesce(source, '')), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE) / (count(*) OVER (PARTITION BY source))::DOUBLE AS part FROM b),
p AS (SELECT *, row_number() OVER (ORDER BY part, source NULLS FIRST) - 1 AS p, count(*) OVER () AS n FROM r)
SELECT doc_id, size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, (p * 40 // n)::INT AS shard, row_number() OVER (PARTITION BY p * 40 // n ORDER BY p) - 1 AS slot, NULL::INT AS grown_shard, source FROM p
"""


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in each document, a tenth of them with a tail that was made periodic."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    h = crc32_of_id()
    planted = docs.withColumn("h", h).withColumn("words", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD}+)"), 1)))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    planted = planted.withColumn("n", n).withColumn("a", (g % F.greatest("n", F.lit(1))).cast("int"))
    planted = planted.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8))).cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times)), F.lit(1), F.col("n") - F.col("a"))
    text = F.when(F.col("n") > 0, F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")).otherwise(F.col("text"))
    found = periodic_runs.with_runs(planted.select("doc_id", text.alias("text")))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    out = found.withColumn("best", best)
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), (-F.col("best.l")).alias("length"), F.col("best.period").alias("period"),
        F.expr("-1000 * best.l div best.period").alias("exponent_milli"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


OP13_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}+') AS ws, {CRC_OF_ID} AS h FROM documents),
e AS (SELECT doc_id, ws, h, len(ws) AS n, (h // 10)::BIGINT AS g, ((h // 10) % greatest(len(ws), 1))::BIGINT AS a FROM d),
w AS (SELECT doc_id, i, CASE WHEN h % 10 = 0 AND i >= a THEN ws[1 + a + (i - a) % (1 + (n - a) // (3 + g % 8))] ELSE ws[i + 1] END AS w FROM (SELECT *, unnest(range(n)) AS i FROM e)),
s AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM w x JOIN w y ON x.doc_id = y.doc_id AND x.w = y.w AND x.i < y.i),
z AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS l FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS k FROM s) GROUP BY doc_id, q, k HAVING count(*) >= q AND count(*) + q >= 12),
r AS (SELECT * FROM z WHERE NOT EXISTS (FROM z o WHERE o.doc_id = z.doc_id AND o.q < z.q AND o.s <= z.s AND o.s + o.l >= z.s + z.l)),
best AS (SELECT doc_id, count(*) AS n_runs, arg_min({{'s': s, 'l': l, 'q': q}}, (-l, s, q)) AS b, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS t FROM r GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + l)) AS i FROM r),
k AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS t FROM w ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, b.l AS length, b.q AS period, 1000 * b.l // b.q AS exponent_milli, sha256(coalesce(best.t, '')) AS runs_sha256, sha256(coalesce(k.t, '')) AS collapsed_sha256
FROM d LEFT JOIN best USING (doc_id) LEFT JOIN k USING (doc_id)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality_classifier, op2_packing, op3_quality_rules, op4_jaccard_join, op5_language_id, op6_decontamination, op7_url_filters, op8_suffix_dedup, op9_pii, op10_line_dedup, op11_merkle_manifest, op12_sharding, op13_periodic_runs, rule_counts, url_rules, line_copies)}


def oracle_sql() -> dict[str, str]:
    return {"op4_jaccard_join": OP4_SQL, "op8_suffix_dedup": OP8_SQL, "op11_merkle_manifest": OP11_SQL, "op12_sharding": OP12_SQL, "op13_periodic_runs": OP13_SQL, "rule_counts": RULE_COUNTS_SQL, "url_rules": URL_RULES_SQL, "line_copies": LINE_COPIES_SQL}
