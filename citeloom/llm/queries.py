"""The registered queries of this subpackage and their DuckDB SQL.

Each ``opN_`` query applies its operator with production parameters to whole
tables and derives the columns of its contract from the operator's result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import groupby
from operator import and_

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.llm import (
    chat_template, compact_windows, conversation_repair, curriculum, dart_minhash, decontaminate, license_scan, quality_mil, rule_ledger, token_align,
    toxicity, url_filter, warc)
from citeloom.llm.graphs import written
from citeloom.llm.labels import held_out


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def captures(pages: DataFrame) -> DataFrame:
    """Two capture records for each page: its response, and a later or earlier revisit of its url.

    Times, statuses and validators are made from checksums of the page id, so that
    every outcome occurs.
    """
    c = F.conv(F.substring(F.md5(F.coalesce(F.col("page_id").cast("string"), F.lit(""))), 1, 7), 16, 10).cast("long")
    base = pages.select("page_id", "url", F.md5("html").alias("md5"), F.octet_length("html").alias("size"), c.alias("c"),
                        F.timestamp_seconds(F.lit(1704067200) + F.col("page_id") * 37).alias("at"))
    tag = F.concat(F.lit('"'), F.substring("md5", 1, 12), F.lit('"'))
    time = F.date_format("at", "yyyy-MM-dd HH:mm:ss")

    def headers(values: dict) -> F.Column:
        pairs = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in values.items()])
        return F.map_from_entries(F.filter(pairs, lambda e: e["value"].isNotNull()))

    response = base.select(
        (F.col("page_id") * 2).alias("record_id"), "url", F.col("at").alias("captured_at"), F.lit("response").alias("kind"),
        F.when(F.col("c") % 10 == 0, 206).otherwise(200).alias("status"), F.col("md5").alias("digest"),
        headers({"content-type": F.lit("text/html"), "content-length": F.col("size"), "date": time,
                 "etag": F.when(F.col("c") % 4 != 0, tag), "last-modified": F.when(F.col("c") % 3 != 0, time)}).alias("headers"))
    hours = F.col("c") % 7 - 1
    other = F.when(F.col("c") % 5 == 0, '"other"').when(F.col("c") % 6 == 1, F.concat(F.lit("W/"), tag)).otherwise(tag)
    revisit = base.select(
        (F.col("page_id") * 2 + 1).alias("record_id"), F.concat("url", F.lit("#again")).alias("url"),
        F.timestamp_seconds(F.unix_timestamp("at") + hours * 3600).alias("captured_at"), F.lit("revisit").alias("kind"),
        F.lit(304).alias("status"), F.lit(None).cast("string").alias("digest"),
        headers({"content-length": F.lit("0"), "date": F.date_format(F.timestamp_seconds(
                     F.unix_timestamp("at") + hours * 3600), "yyyy-MM-dd HH:mm:ss"),
                 "etag": F.when(F.col("c") % 8 != 0, other), "last-modified": F.when(F.col("c") % 9 != 0, time),
                 "cache-control": F.lit("max-age=60"), "set-cookie": F.lit("a=1")}).alias("headers"))
    return response.unionByName(revisit)


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = warc.resolve_revisits(captures(_table(spark, sf_dir, "pages")))
    return resolved.select("record_id", "url_key", "ref_record_id", "outcome", "digest",
                           warc.header_lines("headers").alias("header_lines"))


#: The rules of the contract.
URL_RULES = {
    "com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block",
}


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(_table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft", "soft_weight")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.learn(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_hits", "n_words")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality_mil.score(docs, quality_mil.train(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``taken`` is read off the training sequence: the words of all copies of a document in it."""
    mixed = written(curriculum.mix(_table(spark, sf_dir, "documents")), "mixed")
    sequence = written(curriculum.training_sequence(mixed, carried=["before"]), "sequence", narrow=False)
    # Rows with words differ in their place in their source.
    row = ["source", "doc_id", "size", "before"]
    taken = sequence.groupBy(*row).agg(F.sum("n_words").alias("n_taken"))
    same = reduce(and_, [F.col(f"m.{c}").eqNullSafe(F.col(f"t.{c}")) for c in row])
    return mixed.alias("m").join(taken.alias("t"), same, "left").select(
        "m.doc_id", "m.size", "source_size", "target", F.coalesce("n_taken", F.lit(0)).cast("long").alias("taken"))


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digests of formatted conversations, from the formatted text and its loss spans only."""
    for batch in batches:
        rows = []
        for formatted, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            turns = chat_template.read_turns(formatted)
            loss = chat_template.read_loss(formatted, [(s["start"], s["stop"]) for s in spans])
            said = "".join(f"{role}\n{text}\n" for role, text in turns)
            rows.append((len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                         hashlib.sha256(loss.encode()).hexdigest(), len(formatted)))
        n, turns, chars, loss, length = zip(*rows, strict=True) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(turns, pa.string()), pa.array(chars, pa.int64()),
             pa.array(loss, pa.string()), pa.array(length, pa.int64())],
            names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = spark.createDataFrame(
        [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")],
        "conv_id long, turn long, role string, text string")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(tricky)
    formatted = chat_template.format_conversations(rows)
    return formatted.mapInArrow(
        _read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op8_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = dart_minhash.near_classes(_table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id")


def op9_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rule_ledger.apply_policy(rule_ledger.ledger(_table(spark, sf_dir, "documents")))
    base = rule_ledger.mask(rule_ledger.POLICIES["base"])
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (rows["failed"].bitwiseAND(base) != 0).alias("base_failed"), "kept")


def op10_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = compact_windows.passages(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "first_doc_id", "start_word", "stop_word")


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with rows dropped, emptied, cut, repeated or given to the user, by checksums of their place."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    k = F.crc32(F.concat_ws(":", text[0], text[1])) % 20
    rows = conversations.select("conv_id", "turn", text[2].alias("role"), text[3].alias("text"), k.alias("k")).where("k <> 0")
    copies = F.when(F.col("k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("copy", F.explode(copies)).select(
        "conv_id", "turn", F.when(F.col("k") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"))


def _conversation_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of ``role:text`` of rows ``(conv_id, role, text)`` that are in order."""
    kind = None

    def rows() -> Iterator[tuple]:
        nonlocal kind
        for batch in batches:
            kind = batch.schema.field(0).type
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    done = []
    for conv, group in groupby(rows(), key=lambda r: r[0]):
        digest, first = hashlib.sha256(), True
        for _, role, text in group:
            digest.update(f"{role}:{text}".encode() if first else f"\n{role}:{text}".encode())
            first = False
        done.append((conv, digest.hexdigest()))
        if len(done) == 20_000:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], kind), pa.array([d[1] for d in done])], names=["conv_id", "digest"])
            done = []
    if done:
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], kind), pa.array([d[1] for d in done])], names=["conv_id", "digest"])


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = damaged(conversations)
    repairs = written(conversation_repair.repair(rows), "repairs")
    kind = conversations.schema["conv_id"].dataType.simpleString()
    digests = conversation_repair.repaired(rows, repairs).select("conv_id", "role", "text").mapInArrow(
        _conversation_digests, f"conv_id {kind}, digest string")
    ids = conversations.select("conv_id").distinct()
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return (
        ids.alias("i").join(repairs.alias("r"), F.expr("i.conv_id <=> r.conv_id"), "left")
        .join(digests.alias("d"), F.expr("i.conv_id <=> d.conv_id"), "left")
        .select("i.conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256")))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(_table(spark, sf_dir, "documents"))
    return found.withColumn("base_labels", F.concat_ws(",", "base_labels")).withColumn("labels", F.concat_ws(",", "labels"))


#: The folder of the tokenizers' files, on the driver.
TOKENIZERS = "/opt/tokenizers"


def op13_token_alignment(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    pair = token_align.Pair(spark, tokenizers)
    aligned = token_align.written_alignment(_table(spark, sf_dir, "documents"), pair)
    scored = token_align.score_links(aligned, token_align.link_counts(aligned, pair), pair)
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def _url_sql() -> str:
    """Each term as a pattern with the same boundaries."""
    v = url_filter.VOCABULARY
    hit = "CAST(regexp_matches(u, '(^|[^a-z0-9]){}([^a-z0-9]|$)') AS INTEGER)"
    strict = " + ".join(hit.format(t) for t in v.strict)
    soft = " + ".join(hit.format(t) for t, _ in v.soft)
    weight = " + ".join(f"{w} * {hit.format(t)}" for t, w in v.soft)
    rules = "\n".join(
        f"WHEN (host = '{r[:r.index('/')]}' OR ends_with(host, '.{r[:r.index('/')]}')) "
        f"AND starts_with(path, '{r[r.index('/'):]}') THEN '{r}'" for r in sorted(URL_RULES, key=len, reverse=True))
    verdicts = " ".join(f"WHEN '{r}' THEN '{x}'" for r, x in URL_RULES.items())
    return f"""
WITH p AS (
  SELECT page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS u,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
t AS (SELECT *, CASE {rules} END AS rule, CAST({strict} AS INTEGER) AS n_strict, CAST({soft} AS INTEGER) AS n_soft,
             CAST({weight} AS INTEGER) AS soft_weight FROM p)
SELECT page_id, host, path, rule, n_strict, n_soft, soft_weight,
       CASE rule {verdicts} ELSE CASE WHEN n_strict > 0 OR (n_soft >= {v.min_soft} AND soft_weight >= {v.min_weight})
         THEN 'block' ELSE 'allow' END END AS verdict
FROM t"""


def _formatted_chars_sql() -> str:
    """Characters of an escaped text: itself, its backslashes, and one more for each control string."""
    more = " + ".join(f"(length({{0}}) - length(replace({{0}}, '{c}', ''))) // {len(c)}" for c in chat_template.CONTROLS)
    return "length({0}) + (length({0}) - length(replace({0}, '\\', ''))) + " + more


OP1_SQL = r"""
WITH base AS (
  SELECT page_id, url, md5(html) AS md5, strlen(html) AS size, page_id * 37 + 1704067200 AS sec, crc AS c FROM (
    SELECT *, ('0x' || substr(md5(coalesce(CAST(page_id AS VARCHAR), '')), 1, 7))::BIGINT AS crc FROM pages)),
keyed AS (
  SELECT *, regexp_replace(regexp_replace(url, '(?s)#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM base),
canon AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^[^/?]*')), '^www\.', ''), ':(80|443)$', '')
    || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS front,
    array_to_string(list_sort([x FOR x IN string_split(regexp_replace(regexp_extract(rest, '(?s)\?(.*)$', 1),
      '(^|&)(utm_[^=&]*|fbclid|gclid|ref)=[^&]*', '', 'g'), '&') IF x <> '']), '&') AS query FROM keyed),
k AS (SELECT *, front || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS key,
             '"' || substr(md5, 1, 12) || '"' AS tag FROM canon),
resp AS (SELECT key, page_id * 2 AS ref, sec, md5 AS digest, size, strftime(make_timestamp(sec * 1000000), '%Y-%m-%d %H:%M:%S') AS d,
                CASE WHEN c % 4 <> 0 THEN tag END AS etag,
                CASE WHEN c % 3 <> 0 THEN strftime(make_timestamp(sec * 1000000), '%Y-%m-%d %H:%M:%S') END AS lm
         FROM k WHERE c % 10 <> 0),
rev AS (SELECT key, page_id * 2 + 1 AS record_id, sec + (c % 7 - 1) * 3600 AS sec,
               strftime(make_timestamp((sec + (c % 7 - 1) * 3600) * 1000000), '%Y-%m-%d %H:%M:%S') AS d,
               CASE WHEN c % 8 <> 0 THEN CASE WHEN c % 5 = 0 THEN '"other"' WHEN c % 6 = 1 THEN 'W/' || tag ELSE tag END END AS etag,
               CASE WHEN c % 9 <> 0 THEN strftime(make_timestamp(sec * 1000000), '%Y-%m-%d %H:%M:%S') END AS lm FROM k),
found AS (
  SELECT r.record_id, max(struct_pack(sec := s.sec, ref := s.ref)).ref AS ref
  FROM rev r JOIN resp s ON s.key = r.key AND s.sec < r.sec GROUP BY 1),
j AS (
  SELECT r.*, f.ref, s.digest, s.size, s.etag AS s_etag, s.lm AS s_lm,
         CASE WHEN f.ref IS NULL THEN 'unresolved' ELSE coalesce(
           CASE WHEN r.etag IS NOT NULL AND s.etag IS NOT NULL THEN
             CASE WHEN regexp_replace(r.etag, '^W/', '') = regexp_replace(s.etag, '^W/', '') THEN 'resolved' ELSE 'mismatch' END END,
           CASE WHEN r.lm IS NOT NULL AND s.lm IS NOT NULL THEN
             CASE WHEN r.lm = s.lm THEN 'resolved' ELSE 'mismatch' END END, 'unchecked') END AS outcome
  FROM rev r LEFT JOIN found f USING (record_id) LEFT JOIN resp s ON s.ref = f.ref)
SELECT record_id, key AS url_key, ref AS ref_record_id, outcome,
       CASE WHEN outcome IN ('resolved', 'unchecked') THEN digest END AS digest,
       CASE WHEN outcome IN ('resolved', 'unchecked') THEN array_to_string(list_sort([x FOR x IN [
         'content-type: text/html', 'content-length: ' || size, 'date: ' || d, 'cache-control: max-age=60',
         'etag: ' || coalesce(etag, s_etag), 'last-modified: ' || coalesce(lm, s_lm)] IF x IS NOT NULL]), chr(10)) END AS header_lines
FROM j"""

OP7_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
s AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss,
         CAST(3 + sum({role} + {text} + {frame}) AS BIGINT) AS formatted_chars
  FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM s"""

OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
starts AS (SELECT item_id, w, least(len(w), 13) AS l, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS p FROM b WHERE len(w) > 0),
grams AS (SELECT DISTINCT item_id, l, array_to_string(w[p:p + l - 1], ' ') AS g FROM starts),
lengths AS (SELECT DISTINCT l FROM grams),
frm AS (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS p FROM d, lengths WHERE len(w) >= l),
win AS (SELECT doc_id, p, l, array_to_string(w[p:p + l - 1], ' ') AS g FROM frm),
hit AS (SELECT DISTINCT x.doc_id, x.p, x.l, y.item_id FROM win x JOIN grams y ON x.g = y.g AND x.l = y.l),
covered AS (SELECT DISTINCT doc_id, unnest(range(p, p + l)) AS q FROM hit),
n AS (SELECT doc_id, count(*) AS n_hit FROM covered GROUP BY 1),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN i USING (doc_id)"""

OP11_SQL = r"""
WITH RECURSIVE
crc_table AS (SELECT [list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
                      FOR x IN range(256)] AS t),
o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS place FROM conversations),
k AS (SELECT o.*, xor(list_reduce(list_concat([4294967295::BIGINT], [CAST(ascii(x) AS BIGINT) FOR x IN string_split(place, '')]),
                                  lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 20 AS k FROM o, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy FROM k WHERE k <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
             md5(length(role) || ':' || role || ':' || text), copy) AS n,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said FROM damaged),
judged AS (
  SELECT *, said = '' AS blank, said <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS duplicate,
         left(role, 1) AS x, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS before FROM numbered),
r AS (SELECT *, blank OR duplicate AS gone, NOT blank AND NOT duplicate AND right(said, 1) NOT IN ('.', '!', '?') AS truncated FROM judged),
facts AS (
  SELECT conv_id, max(n) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || x NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY 1),
follows(p, q) AS (VALUES ('', 's'), ('', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')),
inserted(p, q, cost, audit) AS (VALUES ('', '', 0, ''), ('s', 's', 0, ''), ('u', 'u', 0, ''), ('a', 'a', 0, ''),
  ('', 'u', 3, 'I'), ('', 'a', 6, 'II'), ('s', 'u', 3, 'I'), ('s', 'a', 6, 'II'), ('u', 'a', 3, 'I'), ('a', 'u', 3, 'I')),
steps AS (
  SELECT conv_id, n, p, p AS q, 4 AS cost, 'D' AS audit FROM r, (VALUES (''), ('s'), ('u'), ('a')) s(p)
  UNION ALL SELECT conv_id, n, p, q, CASE WHEN truncated THEN 3 ELSE 0 END, 'K' FROM r JOIN follows ON q = x WHERE NOT gone
  UNION ALL SELECT conv_id, n, p, q, CASE WHEN truncated THEN 6 ELSE 3 END, 'R' FROM r, follows WHERE q <> 's' AND NOT gone),
closed AS (
  SELECT conv_id, n, s.p, i.q, min({'cost': s.cost + i.cost, 'audit': s.audit || i.audit}) AS e
  FROM steps s JOIN inserted i ON i.p = s.q GROUP BY ALL),
best AS (
  SELECT conv_id, 0::BIGINT AS n, i.q, {'cost': i.cost, 'audit': i.audit} AS e FROM facts, inserted i WHERE i.p = ''
  UNION ALL
  SELECT b.conv_id, b.n + 1, c.q, min({'cost': b.e.cost + c.e.cost, 'audit': b.e.audit || c.e.audit})
  FROM best b JOIN closed c ON c.conv_id IS NOT DISTINCT FROM b.conv_id AND c.n = b.n + 1 AND c.p = b.q GROUP BY b.conv_id, b.n, c.q),
won AS (
  SELECT b.conv_id, min(b.e) AS e FROM best b JOIN facts f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.n = b.n
  WHERE b.q IN ('', 'a') GROUP BY 1),
letters AS (
  SELECT conv_id, i, substr(e.audit, i, 1) AS edit, i - (length(substr(e.audit, 1, i)) - length(replace(substr(e.audit, 1, i), 'I', ''))) AS n,
         length(replace(substr(e.audit, 1, i), 'D', '')) - 1 AS place, length(replace(e.audit, 'D', '')) AS size
  FROM (SELECT conv_id, e, unnest(range(1, length(e.audit) + 1)) AS i FROM won)),
said AS (
  SELECT l.conv_id, string_agg(CASE WHEN edit = 'K' THEN r.role WHEN (place - size % 2) % 2 = 0 THEN 'user' ELSE 'assistant' END
           || ':' || CASE WHEN edit = 'I' THEN '' ELSE r.text END, chr(10) ORDER BY i) AS t
  FROM letters l LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.n = l.n AND edit <> 'I' WHERE edit <> 'D' GROUP BY 1)
SELECT i.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(w.e.cost, 0) AS BIGINT) AS cost,
       coalesce(w.e.audit, '') AS audit, sha256(coalesce(s.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i
LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN won w ON w.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN said s ON s.conv_id IS NOT DISTINCT FROM i.conv_id"""

_MIX_TARGETS = r"""
sizes AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
          FROM {documents}),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY 1),
ranked AS (SELECT *, ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight FROM totals),
ratios AS (SELECT *, 3 * source_size AS cap, (3 * source_size) / weight AS ratio FROM ranked),
levels AS (
  SELECT *, row_number() OVER o AS place,
         (sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ratios WINDOW o AS (ORDER BY ratio, source ASC NULLS LAST)),
chosen AS (SELECT arg_min(level, place) AS level FROM levels WHERE level <= ratio),
targets AS (
  SELECT l.source, l.source_size, least(l.cap::DOUBLE, coalesce(c.level, 0) * l.weight) AS target
  FROM levels l LEFT JOIN chosen c ON true)"""

_MIX_ROWS = r""",
placed AS (
  SELECT s.*, t.source_size, t.target, ('0x' || substr(md5('0|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || size), 1, 15))::BIGINT AS place,
         greatest(ceil(count(*) OVER (PARTITION BY s.source) / 1024.0), 1)::BIGINT AS n_buckets
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
laid AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY place % n_buckets, place, doc_id, size
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         round(target)::BIGINT AS wanted, CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS passes
  FROM placed)
SELECT doc_id, size, source_size, target,
       CAST(size * passes + greatest(least(wanted - passes * source_size - before, size), 0) AS BIGINT) AS taken
FROM laid"""

OP9_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM d),
win AS (SELECT doc_id, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS g
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM w WHERE len(w) >= 3)),
twice AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
r AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM twice) GROUP BY 1),
m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM w LEFT JOIN r USING (doc_id)),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR n_symbols * 100 > n_words * 40 OR n_dup_lines * 100 > n_lines * 60
            OR (n_words > 0 AND (word_chars > greatest(n_words, 1) * 25 OR word_chars < greatest(n_words, 1) * 2))) AS kept
FROM v"""

QUERIES = {
    "op1_warc_revisits": op1_warc_revisits,
    "op2_url_filter": op2_url_filter,
    "op3_toxicity": op3_toxicity,
    "op4_decontaminate": op4_decontaminate,
    "op5_quality": op5_quality,
    "op6_mix_sources": op6_mix_sources,
    "op7_chat_format": op7_chat_format,
    "op8_dart_minhash": op8_dart_minhash,
    "op9_rule_ledger": op9_rule_ledger,
    "op10_compact_windows": op10_compact_windows,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_license_scan": op12_license_scan,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE_SQL = {
    "op1_warc_revisits": OP1_SQL,
    "op2_url_filter": _url_sql(),
    "op7_chat_format": OP7_SQL.format(
        role=_formatted_chars_sql().format("role"), text=_formatted_chars_sql().format("text"),
        frame=len("<|im_start|><|im_sep|><|im_end|>\n")),
    "op4_decontaminate": OP4_SQL,
    "op6_mix_sources": "WITH " + _MIX_TARGETS.replace("{documents}", "documents") + _MIX_ROWS,
    "op9_rule_ledger": OP9_SQL,
    "op11_conversation_repair": OP11_SQL,
}
