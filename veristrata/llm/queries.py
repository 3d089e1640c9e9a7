"""The registered queries of the thirteen operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veristrata.llm import (
    chat, decontaminate, html, language, lm, packing, pieces, ranked, runs, simhash, suffix, topk, warc,
)
from veristrata.llm.common import held_out, table, whole_text

PIECE_MODEL = "piece_bpe_32k.model"
BYTE_MODEL = "byte_bpe_50k.json"


def piece_model_path() -> str:
    """The model file comes with an installed package, the same on every machine."""
    return _tokenizer_path(PIECE_MODEL)


def byte_model_path() -> str:
    return _tokenizer_path(BYTE_MODEL)


def _tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), held_out("doc_id", 7, 2))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held = held_out("doc_id", 3, 1)
    model = language.train(language.training_rows(documents, held))
    rows = documents.select("doc_id", held.alias("held_out"), "text")
    return language.identify(rows, model, keep=("doc_id", "held_out"))


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.report(table(spark, sf_dir, "documents"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, 5)


OP6_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 5
"""


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_decode(table(spark, sf_dir, "documents"), piece_model_path())


HARD_TURN = "\\### Assistant: </turn> ok"


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP10_SQL = r"""
WITH shingled AS (
  SELECT kind, id, row, [array_to_string(w[i : i + 4], ' ') FOR i IN range(1, len(w) - 3)] AS s FROM (
    SELECT *, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM (
      SELECT 0 AS kind, doc_id AS id, row_number() OVER () AS row, text FROM documents
      UNION ALL SELECT 1, item_id, row_number() OVER (), text FROM benchmark
    )
  )
), pieces AS (SELECT DISTINCT kind, id, row, unnest(s) AS s FROM shingled),
sizes AS (SELECT row, count(*) AS n FROM pieces WHERE kind = 1 GROUP BY row),
shared AS (
  SELECT d.id AS doc_id, d.row AS doc_row, b.id AS item_id, b.row AS row, count(*) AS common
  FROM pieces d JOIN pieces b ON d.s = b.s AND d.kind = 0 AND b.kind = 1 GROUP BY ALL
)
SELECT doc_id, item_id, n AS item_shingles, common AS shared_shingles,
  CAST(common AS DOUBLE) / n AS containment
FROM shared JOIN sizes USING (row) WHERE common >= greatest(1, ceil(0.8 * n - 1e-9))
"""


# Captures of a page: the full response, then by the page's number a revisit that agrees, one whose validator
# differs, or one before the response.
FIRST_CAPTURE, APART, DAY = 1704067200, 37, 86400


def captures(pages: DataFrame) -> DataFrame:
    """The texts of WARC records made from the pages."""
    html, url = F.coalesce(F.col("html"), F.lit("")), F.coalesce(F.col("url"), F.lit(""))
    taken = F.lit(FIRST_CAPTURE) + F.col("page_id") * APART
    tag = F.concat(F.lit('"'), F.substring(F.md5(html.cast("binary")), 1, 12), F.lit('"'))
    age = lambda n: F.concat(F.lit("max-age="), (F.pmod(F.col("page_id"), F.lit(7)) * n).cast("string"))
    name = lambda kind: F.concat(F.lit(f"<urn:{kind}:"), F.col("page_id").cast("string"), F.lit(">"))
    response = warc.record_text(
        "response", name("response"), url, F.timestamp_seconds(taken), "200 OK",
        [("Content-Type", F.lit("text/html; charset=utf-8")), ("Content-Length", F.octet_length(html)), ("ETag", tag),
         ("Cache-Control", age(60))],
        html,
    )
    turn = F.pmod(F.col("page_id"), F.lit(4))
    later = F.when(turn == 1, DAY).when(turn == 2, 2 * DAY).otherwise(-DAY)
    seen = F.when(turn == 2, F.lit('"other"')).otherwise(F.concat(F.lit("W/"), tag))
    revisit = warc.record_text(
        "revisit", name("revisit"), url, F.timestamp_seconds(taken + later),
        "304 Not Modified",
        [("ETag", seen), ("Cache-Control", age(90)), ("Content-Length", F.lit(0)), ("X-Cache", F.lit("HIT"))],
        F.lit(""),
    )
    records = F.when(turn == 0, F.array(response)).otherwise(F.array(response, revisit))
    return pages.select(F.explode(records).alias("record"))


def op8_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.resolve(warc.parse(captures(table(spark, sf_dir, "pages"))))
    lines = F.transform("fields", lambda h: F.concat(h["name"], F.lit(": "), h["value"]))
    return found.select(
        "record_id", "canonical", F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date"), "outcome", "refers_to",
        F.array_join(lines, "\n").alias("headers"), "payload_bytes", "payload_sha256",
    )


OP8_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, regexp_replace(trim(coalesce(url, '')), '#.*$', '') AS u FROM pages
), q AS (
  SELECT *, regexp_replace(u, '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM p
), k AS (
  SELECT page_id, html, 1704067200 + page_id * 37 AS taken, '"' || substr(md5(html), 1, 12) || '"' AS tag,
    page_id % 4 AS turn,
    regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), '^www\.', ''), ':(80|443)$', '')
    || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '')
    || CASE WHEN len(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'),
         lambda x: x <> '' AND NOT regexp_matches(x, '^(?i:utm_|fbclid|gclid)'))) > 0
       THEN '?' || array_to_string(list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'),
         lambda x: x <> '' AND NOT regexp_matches(x, '^(?i:utm_|fbclid|gclid)'))), '&') ELSE '' END AS canonical
  FROM q
), v AS (
  SELECT *, taken + CASE turn WHEN 1 THEN 86400 WHEN 2 THEN 172800 ELSE -86400 END AS moment,
    CASE WHEN turn = 2 THEN '"other"' ELSE tag END AS seen
  FROM k WHERE turn <> 0
), f AS (
  SELECT v.page_id, v.canonical, v.moment, v.seen, r.page_id AS rid, r.tag, r.html AS payload,
    row_number() OVER (PARTITION BY v.page_id ORDER BY r.taken DESC, '<urn:response:' || r.page_id || '>' DESC) AS place
  FROM v LEFT JOIN k r ON r.canonical = v.canonical AND r.taken < v.moment
)
SELECT '<urn:revisit:' || page_id || '>' AS record_id, canonical,
  strftime(make_timestamp(moment * 1000000), '%Y-%m-%d %H:%M:%S') AS date,
  CASE WHEN rid IS NULL THEN 'no response' WHEN seen <> tag THEN 'validators differ' ELSE 'resolved' END AS outcome,
  CASE WHEN seen = tag THEN '<urn:response:' || rid || '>' END AS refers_to,
  CASE WHEN seen = tag THEN 'cache-control: max-age=' || (page_id % 7) * 90 || chr(10) || 'content-length: '
    || strlen(payload) || chr(10) || 'content-type: text/html; charset=utf-8' || chr(10) || 'etag: W/' || seen
    || chr(10) || 'x-cache: HIT' END AS headers,
  CASE WHEN seen = tag THEN CAST(strlen(payload) AS BIGINT) END AS payload_bytes,
  CASE WHEN seen = tag THEN sha256(payload) END AS payload_sha256
FROM f WHERE place = 1
"""


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(HARD_TURN).alias("text"),
    )
    turns = rows.union(hard).withColumn("parts", chat.text_part(whole_text()))
    return chat.digest(chat.format_turns(turns))


OP9_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, length(replace(replace(text, '\', '\b'), '<', '\l'))
          + length(replace(replace(replace(role, '\', '\b'), '<', '\l'), chr(10), '\n'))
          + length('<turn>') + length('</turn>') + 2 AS shown
  FROM rows
), joined AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum(shown) AS shown
  FROM sized GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(shown AS BIGINT) AS formatted_chars
FROM joined
"""


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# Java, Python and C agree on ln to within a unit of the last place; the floor of a thousand times it hides that.
OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS ts
  FROM documents
), i AS (
  SELECT r, item_id, unnest(ts) AS t FROM (
    SELECT row_number() OVER () AS r, item_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS ts
    FROM benchmark)
), total AS (
  SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(ts)) AS BIGINT) AS terms FROM d WHERE len(ts) > 0
), p AS (
  SELECT r, doc_id, n, t, CAST(count(*) AS BIGINT) AS tf FROM (
    SELECT r, doc_id, CAST(len(ts) AS BIGINT) AS n, unnest(ts) AS t FROM d)
  WHERE t IN (SELECT t FROM i) GROUP BY ALL
), w AS (
  SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, total GROUP BY t, docs
), scored AS (
  SELECT p.r, p.doc_id, p.t,
    w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (100 - 75 + ((75 * p.n * docs) // terms)))) AS part
  FROM p JOIN w ON p.t = w.t, total
), ranked AS (
  SELECT i.r AS item, i.item_id, s.doc_id, CAST(sum(s.part) AS BIGINT) AS score,
    row_number() OVER (PARTITION BY i.r ORDER BY sum(s.part) DESC, s.doc_id NULLS LAST) AS place
  FROM i JOIN scored s ON i.t = s.t GROUP BY i.r, i.item_id, s.r, s.doc_id HAVING sum(s.part) > 0
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 10
"""


def periodic(documents: DataFrame) -> DataFrame:
    """One document in ten, by the crc32 of its doc_id, repeats a part of its words from some word on; NULL ids none."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.filter(F.split(whole_text(), r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    rows = documents.select("doc_id", whole_text().alias("text"), words.alias("w"), F.floor(h / 10).alias("g"))
    rows = rows.withColumn("n", F.size("w"))
    first = F.when(F.col("n") > 0, F.col("g") % F.col("n"))
    rows = rows.withColumn("a", first.cast("int"))
    period = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))
    rows = rows.withColumn("p", period.cast("int"))
    rest = F.col("n") - F.col("a")
    again = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int")))
    made = F.array_join(F.concat(F.slice("w", 1, F.col("a")), F.slice(again, 1, rest)), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), made).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find(periodic(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r["start"], r["period"])))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    rows = found.withColumn("longest", longest)
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("longest.start"), F.col("longest.length"),
        F.col("longest.period"),
        F.expr("longest.length * 1000 div longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.pack(table(spark, sf_dir, "documents"), byte_model_path())
    return found.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_score": op1_lm_score,
    "op2_simhash": op2_simhash,
    "op3_language_id": op3_language_id,
    "op4_html_extract": op4_html_extract,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_topk": op6_topk,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_warc_revisits": op8_warc_revisits,
    "op9_chat_format": op9_chat_format,
    "op10_decontaminate": op10_decontaminate,
    "op11_ranked_search": op11_ranked_search,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_packing": op13_packing,
}

ORACLES: dict[str, str] = {
    "op6_topk": OP6_SQL,
    "op8_warc_revisits": OP8_SQL,
    "op9_chat_format": OP9_SQL,
    "op10_decontaminate": OP10_SQL,
    "op11_ranked_search": OP11_SQL,
}
