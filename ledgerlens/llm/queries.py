"""Registered queries, one per operator, with DuckDB statements where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (divergence, language, licences, mixing, ngram_join, packing, quality, repeats, shards, spelling, spots,
                            url_rules, warc)
from ledgerlens.llm.common import shared_folder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
SHARDS = 24


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.component_ids(table(spark, sf_dir, "documents"))


SQL["op1_ngram_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS a FROM documents),
p AS (SELECT doc_id, a, unnest(range(1, greatest(len(a) - 3, 2))) AS i FROM w WHERE len(a) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(a[i:i + 4], ' ') AS g FROM p),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
  JOIN n na ON na.doc_id = x.doc_id JOIN n nb ON nb.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, na.n, nb.n HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
reach(a, b) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN c ON c.a = w.doc_id"""


@query
def op2_histogram_sort_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign_shards(table(spark, sf_dir, "documents"), SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


SQL["op3_mix_sources"] = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rk FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][rk % 3 + 1]::BIGINT AS weight, source_size * 2 AS cap FROM s),
o AS (SELECT *, cap::DOUBLE / weight AS ratio,
  (1.5::DOUBLE * (sum(source_size) OVER ())::BIGINT - (sum(cap) OVER (ORDER BY cap::DOUBLE / weight, rk) - cap)::BIGINT)
   / ((sum(weight) OVER ())::BIGINT - (sum(weight) OVER (ORDER BY cap::DOUBLE / weight, rk) - weight)::BIGINT)::DOUBLE AS level FROM w),
t AS (SELECT source, rk, source_size, coalesce(least(cap::DOUBLE, (SELECT arg_min(level, ratio) FROM o WHERE ratio > level) * weight), cap::DOUBLE) AS target FROM o),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size * 16777216)::BIGINT ELSE 0 END AS step,
  ('0x' || substr(md5('mix:' || coalesce(source, 'null')), 1, 6))::BIGINT AS off FROM t),
q AS (SELECT d.doc_id, d.size, p.source_size, p.target, p.step, p.off, row_number() OVER (PARTITION BY p.rk
  ORDER BY d.size, md5('mix:' || coalesce(d.doc_id::VARCHAR, 'null')), d.doc_id) - 1 AS i FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, ((((i + 1) * step + off) >> 24) - ((i * step + off) >> 24)) * size AS taken FROM q"""


@query
def op4_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spots.edited_likeness(table(spark, sf_dir, "documents"))


@query
def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def _url_sql() -> str:
    case, verdict = [], []
    for r in sorted(url_rules.HOST_RULES, key=lambda r: (-len(r.text), r.text)):
        host, _, path = r.text.partition("/")
        fits = f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')"
        case.append(f"WHEN {fits} THEN '{r.text}'")
        verdict.append(f"WHEN {fits} THEN '{r.verdict}'")
    own = "|".join(url_rules.SPAM_LABELS)
    return rf"""
WITH u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{url_rules.UPPER}', '{url_rules.LOWER}') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages)
SELECT page_id, host, path, CASE {' '.join(case)} END AS rule,
  CASE {' '.join(verdict)} WHEN regexp_matches(host, '(^|[^a-z0-9])({own})($|[^a-z0-9])') THEN 'block' ELSE 'allow' END AS verdict FROM u"""


SQL["op5_url_rules"] = _url_sql()


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language.train(table(spark, sf_dir, "documents"))
    return language.identify_pages(table(spark, sf_dir, "pages"), model)


@query
def op7_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality.BASE, "base_failed", "kept", "rule")


@query
def op8_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path()).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op9_license_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"), licences.known_digests(spark))


def _licence_sql() -> str:
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def canonical(c: str) -> str:
        out = f"lower({c})"
        for old, new in licences.SPELLINGS:
            out = f"replace({out}, {quoted(old)}, {quoted(new)})"
        notice = licences.NOTICE_LINE.replace("(?md)", "(?m)")
        return f"trim(regexp_replace(regexp_replace({out}, {quoted(notice)}, '', 'g'), {quoted(licences.GAP)}, ' ', 'g'), ' ')"

    known = ", ".join(f"({quoted(n)}, {quoted(t)})" for n, t in licences.KNOWN.items())
    return f"""
WITH k AS (SELECT sha256({canonical('body')}) AS digest, min(licence) AS licence FROM (VALUES {known}) v(licence, body)
  WHERE {canonical('body')} <> '' GROUP BY 1),
d AS (SELECT doc_id, sha256({canonical('text')}) AS digest FROM documents)
SELECT d.doc_id, d.digest, k.licence FROM d LEFT JOIN k ON d.digest = k.digest"""


SQL["op9_license_digest"] = _licence_sql()


@query
def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, folder = shared_folder(spark, "warc"), shared_folder(spark, "warc")
    warc.write_archives(warc.mark_revisits(warc.with_digest(table(spark, sf_dir, "pages"))), source)
    warc.rewrite(spark, source, folder)
    return warc.resolve(warc.read_archives(spark, folder, payload=False))


SQL["op10_warc_revisits"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest FROM p),
o AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS original FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN original <> page_id THEN original END AS refers_to FROM o"""


@query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


SQL["op11_source_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*)::HUGEINT AS total FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
l AS (SELECT lang, sum(total)::HUGEINT AS ln, count(*)::HUGEINT AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM w GROUP BY lang, source, term),
e AS (SELECT g.lang, g.source, k.term, k.total, coalesce(c.c, 0) AS c FROM g JOIN k ON g.lang = k.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (SELECT e.lang, e.source, e.term, e.c, 1 + (1000000000 * (e.c + 5)) // ((sum(e.c) OVER (PARTITION BY e.lang, e.source))::HUGEINT + 5 * l.v) AS p,
  1 + (1000000000 * (e.total + 5)) // (l.ln + 5 * l.v) AS q FROM e JOIN l ON e.lang = l.lang),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE c > 0 AND p > q),
o AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM r)
SELECT lang, source, part, item, value, rank FROM o WHERE part = 'pair' OR rank <= 50"""


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


SQL["op12_spelling_variants"] = r"""
WITH RECURSIVE t(i, v, k) AS (SELECT i::UBIGINT, i::UBIGINT, 0 FROM range(256) x(i)
  UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END, k + 1 FROM t WHERE k < 8),
tab AS (SELECT list(v ORDER BY i) AS tab FROM t WHERE k = 8),
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents),
own AS (SELECT run, coalesce(doc_id::VARCHAR, '') || ':' || run AS s, count(*) AS m FROM runs GROUP BY doc_id, run),
hexed AS (SELECT run, m, hex(encode(s)) AS x FROM own),
h AS (SELECT run, m, xor(list_reduce(list_concat([4294967295::UBIGINT], [('0x' || x[2 * j + 1:2 * j + 2])::UBIGINT FOR j IN range(length(x) // 2)]),
  lambda a, b: xor(tab[(xor(a, b) & 255)::INT + 1], a >> 8)), 4294967295::UBIGINT) AS h FROM hexed, tab),
cut AS (SELECT CASE WHEN h % 97 = 0 THEN run[1:(h % length(run))::INT] || run[(h % length(run))::INT + 2:] ELSE run END AS word, m FROM h),
w AS (SELECT word, sum(m)::BIGINT AS n FROM cut WHERE length(word) >= 5 GROUP BY word HAVING sum(m) >= 3),
gap AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
less AS (SELECT DISTINCT word, n, word[1:i - 1] || word[i + 1:] AS v FROM gap),
hole AS (SELECT word, n, i, word[1:i - 1] || '*' || word[i + 1:] AS v FROM gap),
near AS (SELECT a.word, b.word AS near, b.n AS near_n FROM hole a JOIN hole b ON a.v = b.v AND a.word <> b.word
  UNION ALL SELECT w.word, l.word, l.n FROM w JOIN less l ON l.v = w.word
  UNION ALL SELECT l.word, w.word, w.n FROM w JOIN less l ON l.v = w.word),
best AS (SELECT word, count(*) AS n_near, min(struct_pack(less := -near_n, near := near)) AS b FROM near GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -b.less >= 2 * w.n THEN b.near END AS form, CASE WHEN -b.less >= 2 * w.n THEN (-b.less)::BIGINT END AS form_n
  FROM w LEFT JOIN best ON best.word = w.word),
chain(word, tip) AS (SELECT word, word FROM f UNION ALL SELECT chain.word, f.form FROM chain JOIN f ON f.word = chain.tip WHERE f.form IS NOT NULL),
ends AS (SELECT chain.word, chain.tip FROM chain JOIN f ON f.word = chain.tip WHERE f.form IS NULL)
SELECT f.word, f.form, ends.tip AS root, f.n, f.n_near, f.form_n FROM f JOIN ends ON ends.word = f.word"""


@query
def op13_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL["op13_repeated_passages"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS a FROM documents),
s AS (SELECT doc_id, a, unnest(range(1, len(a) - 18)) AS i FROM d WHERE len(a) >= 20),
w AS (SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(a[i:i + 19], ' ') ORDER BY doc_id, i) AS k FROM s),
again AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM w WHERE k > 1),
gone AS (SELECT doc_id, list(i) AS l, count(*) AS n FROM again GROUP BY doc_id),
kept AS (SELECT d.doc_id, len(a) AS n_words, coalesce(gone.n, 0) AS n_removed,
  CASE WHEN gone.n IS NULL THEN a ELSE list_filter(a, lambda x, i: NOT list_contains(l, i)) END AS b FROM d LEFT JOIN gone ON gone.doc_id = d.doc_id)
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(coalesce(array_to_string(b, ' '), '')) AS kept_sha256 FROM kept"""
