"""Registered queries of the training-data operators and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.llm import chat_format, decontaminate, fill_middle, html_text, license_scan, mixing, ngram_join, personal_data, quality_rules, suffix_dedup, token_scan, turn_repair, url_filter
from remitlens.llm.common import joined_sha256, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


#: Words of the contracts in DuckDB, over the text ``t``.
_SPACED = "regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')"
_ALNUM = (
    "regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)


def query(name: str, sql: str | None = None):
    def register(build: Query) -> Query:
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


@query(
    "op6_quality_rules",
    """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
win AS (SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS s FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM win) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM again, (SELECT unnest(range(0, 8)) AS k) GROUP BY r),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep USING (r)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR (n_lines >= 4 AND 2 * n_dup_lines > n_lines)
    OR (n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words))) AS kept
FROM f
""",
)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality_rules.ledger(table(spark, folder, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id",
        *[m for m in quality_rules.MEASURES if m != "n_lines"],
        quality_rules.rejected(quality_rules.BASE).alias("base_failed"),
        (~quality_rules.rejected(quality_rules.V1)).alias("kept"),
    )


@query(
    "op4_decontaminate",
    f"""
WITH d AS (SELECT r, doc_id, {_ALNUM} AS ws FROM (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents)),
b AS (SELECT item, {_ALNUM} AS ws FROM (SELECT item_id::VARCHAR AS item, text AS t FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL)),
bw AS (SELECT DISTINCT item, least(10, len(ws)) AS m, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
ms AS (SELECT DISTINCT m FROM bw),
dw AS (SELECT r, i, m, array_to_string(ws[i:i + m - 1], ' ') AS s FROM (SELECT r, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM d, ms)),
h AS (SELECT DISTINCT r, i, m, item FROM dw JOIN bw USING (m, s)),
hw AS (SELECT r, count(DISTINCT i + k) AS n FROM h, (SELECT unnest(range(0, 10)) AS k) WHERE k < m GROUP BY r),
hi AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(hw.n, 0)::BIGINT AS n_hit, coalesce(hi.n, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(hw.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (r) LEFT JOIN hi USING (r)
""",
)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    rows = decontaminate.with_hits(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"))
    return rows.select(
        "doc_id",
        "n_words",
        decontaminate.n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        joined_sha256(F.col("items")).alias("items_sha256"),
        (F.size("hit_runs") > 0).alias("contaminated"),
    )


@query(
    "op8_mixing",
    f"""
WITH d AS (SELECT doc_id, source, len({_SPACED})::BIGINT AS size FROM (SELECT doc_id, source, coalesce(text, '') AS t FROM documents)),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM s),
l AS (SELECT *, row_number() OVER o AS pos, (sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
  / (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM w WINDOW o AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST)),
g AS (SELECT source, source_size, least(cap::DOUBLE, weight * (SELECT arg_min(level, pos) FROM l WHERE level <= cap::DOUBLE / weight)) AS target,
  ('0x' || substr(md5('7:' || coalesce(source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS shift FROM l),
p AS (SELECT doc_id, d.source, size, source_size, target, shift, CASE WHEN source_size > 0 THEN least(target / source_size, 3.0::DOUBLE) ELSE 0.0::DOUBLE END AS e,
  row_number() OVER (PARTITION BY d.source ORDER BY size DESC, doc_id NULLS LAST) - 1 AS nth
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, (size * (floor(e * (nth + 1) + shift) - floor(e * nth + shift)))::BIGINT AS taken FROM p
""",
)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    rows = mixing.with_copies(table(spark, folder, "documents").select("doc_id", "source", mixing.size().alias("size")))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query("op3_license_scan")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    rows = license_scan.scan(table(spark, folder, "documents").select("doc_id", "text"))
    return rows.select("doc_id", *license_scan.ADDED)


_ROLE_OUT = r"replace(replace(role, '\', '\\'), chr(10), '\n')"


@query(
    "op1_chat_format",
    rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
f AS (SELECT *, CASE WHEN regexp_matches(text, '\\(###|</turn>)') OR regexp_matches(text || chr(10), '(^|[^\\])</turn>\n')
  THEN regexp_replace(text, '(\\*)(###|</turn>)', '\\\1\2', 'g') ELSE text END AS body FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(15 + length({_ROLE_OUT}) + length(body))::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
""",
)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    return chat_format.read_back(chat_format.formatted(rows.unionByName(more)))


def _rank_encoder():
    import public_tokenizers

    return token_scan.rank_encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op2_token_counts")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    rows = token_scan.document_tokens(table(spark, folder, "documents").select("doc_id", "text"), _rank_encoder, separator=50256)
    return rows.select("doc_id", "n_tokens")


def _is(kind: str):
    return lambda value: value == kind


@query("op5_personal_data")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    rows = personal_data.entities(table(spark, folder, "documents").select("doc_id", "text"), keep_text=False)
    counts = [F.size(F.filter(F.col("base")["kind"], _is(kind))).cast("long").alias(f"n_{kind}") for kind in personal_data.KINDS]
    base_sha256 = F.sha2(personal_data.listed(F.col("base")).cast("binary"), 256).alias("base_sha256")
    return rows.select("doc_id", *counts, base_sha256, personal_data.listed(F.col("found")).alias("spans"))


@query("op10_html_text")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extracted(table(spark, folder, "pages").select("page_id", "url", "html"))


@query(
    "op9_ngram_join",
    """
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT r, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
o AS (SELECT a.r AS a, b.r AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY a.r, b.r),
e AS (SELECT a, b FROM o JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
reach AS (SELECT DISTINCT a AS r, a AS t FROM e UNION SELECT reach.r, e.b FROM reach JOIN e ON reach.t = e.a),
c AS (SELECT reach.r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.t GROUP BY reach.r)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id FROM d LEFT JOIN n USING (r) LEFT JOIN c USING (r)
""",
)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op7_suffix_dedup")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.deduplicated(table(spark, folder, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


_FIRST_RULE = "CASE " + " ".join(
    f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.host + r.path}'"
    for r in sorted(url_filter.RULES, key=lambda r: -len(r.host + r.path))
) + " END"
_RULE_VERDICT = "CASE rule " + " ".join(f"WHEN '{r.host + r.path}' THEN '{r.verdict}'" for r in url_filter.RULES) + " END"


@query(
    "op12_url_filter",
    rf"""
WITH RECURSIVE u AS (SELECT page_id, html, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
r AS (SELECT *, {_FIRST_RULE} AS rule FROM u),
v AS (SELECT *, {_RULE_VERDICT} AS ruled FROM r),
sh AS (SELECT host, count(*) AS n, count(*) FILTER (ruled = 'allow') AS a, count(*) FILTER (ruled = 'block') AS b FROM v WHERE host <> '' GROUP BY host),
seed AS (SELECT host, CASE WHEN 100 * b >= {url_filter.SEED_SHARE} * n THEN 'block' WHEN 100 * a >= {url_filter.SEED_SHARE} * n THEN 'allow' END AS kind FROM sh
  WHERE 100 * b >= {url_filter.SEED_SHARE} * n OR 100 * a >= {url_filter.SEED_SHARE} * n),
l AS (SELECT DISTINCT src, dst FROM (SELECT host AS src, translate(unnest(regexp_extract_all(html, '(?i)\shref\s*=\s*["'']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''\s<>]+)', 1)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst FROM u WHERE host <> '') WHERE src <> dst),
e AS (SELECT 'allow' AS kind, src AS host, dst AS nxt FROM l UNION ALL SELECT 'block', dst, src FROM l),
g AS (SELECT *, count(*) OVER (PARTITION BY kind, host) AS degree FROM e),
w AS (SELECT 0 AS round, host, kind, ({url_filter.MASS} // count(*) OVER (PARTITION BY kind))::BIGINT AS mass FROM seed
  UNION ALL SELECT round + 1, nxt, kind, sum(part)::BIGINT FROM (SELECT w.round, g.nxt, w.kind, (w.mass * {url_filter.DAMPING}) // (100 * g.degree) AS part
    FROM w JOIN g ON g.kind = w.kind AND g.host = w.host WHERE w.round < {url_filter.ROUNDS}) WHERE part > 0 GROUP BY round, nxt, kind),
t AS (SELECT kind, sum(mass)::DOUBLE AS total FROM w GROUP BY kind),
h AS (SELECT host, coalesce(sum(mass) FILTER (kind = 'allow'), 0)::DOUBLE / coalesce((SELECT total FROM t WHERE kind = 'allow'), 1) AS trust,
  coalesce(sum(mass) FILTER (kind = 'block'), 0)::DOUBLE / coalesce((SELECT total FROM t WHERE kind = 'block'), 1) AS distrust FROM w GROUP BY host),
bad AS (SELECT host FROM h WHERE distrust >= 1e-6::DOUBLE AND distrust > trust)
SELECT page_id, v.host, path, rule, coalesce(ruled, CASE WHEN bad.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict FROM v LEFT JOIN bad ON v.host = bad.host
""",
)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judged(table(spark, folder, "pages").select("page_id", "url", "html")).select("page_id", *url_filter.ADDED)


@query(
    "op13_fill_middle",
    r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[^
]*
|[^
]+') AS ls, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
  ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT *, len(ls)::BIGINT AS n, least(h1 % (len(ls) + 1), h2 % (len(ls) + 1)) AS a, greatest(h1 % (len(ls) + 1), h2 % (len(ls) + 1)) AS b FROM u),
p AS (SELECT *, array_to_string(ls[1:a], '') AS pre, array_to_string(ls[a + 1:b], '') AS mid, array_to_string(ls[b + 1:n], '') AS suf,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM p
""",
)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    rows = fill_middle.transformed(table(spark, folder, "documents").select("doc_id", "text"))
    digests = {"output_sha256": F.col("output"), "restored_sha256": fill_middle.restored(F.col("output"), F.col("form"))}
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *[F.sha2(c.cast("binary"), 256).alias(n) for n, c in digests.items()])


@query("op11_turn_repair")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return turn_repair.report(rows, turn_repair.damaged(rows))
