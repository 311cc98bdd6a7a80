"""The operators bound to the driver's tables, with SQL where SQL can express them.

A query derives the columns of its contract from what the operator returns.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundweave.sources.workspace import cut

from . import (
    bytebpe,
    chat,
    divergence,
    exact,
    interaction,
    language,
    licenses,
    packing,
    quality,
    qualitynet,
    simhash,
    tokenfile,
    toxicity,
)
from .common import fold, table


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    trap = F.lit("\\### Assistant: </turn> ok")
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        trap.alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    out = cut(chat.formatted(turns.unionByName(more)), "chat")
    back = out.select(
        "conv_id",
        "valid",
        "complete",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("segments")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", lines), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
        "valid",
        "complete",
    )


# The machine's moves as text: a conversation is valid if its roles, in order, match.
OP1_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, length(role) + length(text)
      + length(regexp_replace(role || text, '[^\\]', '', 'g'))
      + (length(text) - length(replace(text, '</turn>', ''))) // 7
      + length(array_to_string(regexp_extract_all(text, '#{3,}'), ''))
      - 2 * len(regexp_extract_all(text, '#{3,}'))
      + (length(role) - length(replace(role, '</turn>', ''))) // 7
      + length(array_to_string(regexp_extract_all(role, '#{3,}'), ''))
      - 2 * len(regexp_extract_all(role, '#{3,}'))
      + (length(role) - length(replace(role, ':', '')))
      + length('### : </turn>') + 1 AS chars
  FROM turns
), whole AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS body,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    string_agg(role, ' ' ORDER BY turn NULLS FIRST, role, text) AS roles,
    sum(chars) AS formatted_chars
  FROM sized GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(body) AS turns_sha256, length(loss) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars,
  regexp_full_match(roles, '(system|(system )?user( assistant user)*( assistant)?)') AS valid,
  regexp_full_match(roles, '(system )?user assistant( user assistant)*') AS complete
FROM whole
"""


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # Stored, as packing reads the lengths twice and the tokenizer is the costly part.
    path = public_tokenizers.path("word_bpe_49k.json")
    lengths = cut(tokenfile.sizes(docs, path), "lengths")
    return packing.packed(lengths, F.col("n_ids"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    held = fold(F.col("doc_id"), 5) == 0
    model = toxicity.learn(docs.filter(~held), labels.filter(~held))
    scored, names = toxicity.score(docs.select("doc_id", "text", "lang"), model)
    return scored.select(
        "doc_id", held.alias("held_out"), *[F.col(c).alias(n) for n, c in names.items()]
    )


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded, ids = bytebpe.encode(docs, path, public_tokenizers.PATTERN)
    decoded, raw = bytebpe.decode(encoded, path, public_tokenizers.PATTERN, ids)
    return decoded.select(
        "doc_id",
        (F.length(ids) / 4).cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(raw, 256).alias("decoded_sha256"),
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    rated, names = quality.rules(docs.select("doc_id", "text"), labels)
    return rated.select("doc_id", *[F.col(c).alias(n) for n, c in names.items()])


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = tokenfile.folder_for(spark)
    ledger = tokenfile.write(docs, folder, public_tokenizers.path("word_bpe_49k.json"), end_id=2)

    def crc(ids):
        return (zlib.crc32(ids.astype("<u4").tobytes()),)

    back = tokenfile.read(ledger, folder, crc, "ids_crc32 bigint")
    return back.select("doc_id", "start", F.col("n_ids").alias("n_tokens"), "ids_crc32")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs, licenses.learn(docs))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.dedup(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS body
  FROM documents
), ranked AS (
  SELECT doc_id, sha256(body) AS text_sha256,
    first_value(doc_id) OVER best AS keep_id,
    count(*) OVER (PARTITION BY body) AS group_size,
    row_number() OVER best = 1 AS kept
  FROM rows
  WINDOW best AS (PARTITION BY body ORDER BY points DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ranked
"""


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = fold(F.col("doc_id"), 3) == 1
    model = language.learn(docs.filter(~held))
    found, names = language.identify(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", held.alias("held_out"), *[F.col(c).alias(n) for n, c in names.items()]
    )


def op11_filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    counted = interaction.verdicts(docs, labels, interaction.text_filters(F.col("text")))
    return interaction.audit(counted, "ABCDE")


OP11_SQL = r"""
WITH known AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
    max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), read AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), judged AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(words) < 200 THEN 1 ELSE 0 END AS a,
    CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 1 ELSE 0 END AS b,
    CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 1 ELSE 0 END AS c,
    CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 1 ELSE 0 END AS d,
    CASE WHEN read.doc_id > min(read.doc_id) OVER (PARTITION BY text) THEN 1 ELSE 0 END AS e
  FROM read LEFT JOIN known USING (doc_id)
), masks AS (
  SELECT part, good, toxic, a + 2 * b + 4 * c + 8 * d + 16 * e AS mask, count(*) AS n
  FROM judged GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
  SELECT p.letter || q.letter || r.letter || s.letter || t.letter AS filter_order,
    [p.bit, q.bit, r.bit, s.bit, t.bit] AS bits
  FROM letters p, letters q, letters r, letters s, letters t
  WHERE p.bit + q.bit + r.bit + s.bit + t.bit = 31
    AND (p.bit | q.bit | r.bit | s.bit | t.bit) = 31
), steps AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0) AS earlier
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), counted AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (earlier + bit) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & bit > 0 AND mask & earlier = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit > 0 AND mask & earlier > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & bit > 0 AND mask & earlier = 0 AND good = 1 THEN n ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & bit > 0 AND mask & earlier = 0 AND toxic = 1 THEN n ELSE 0 END) AS toxic_lost
  FROM masks CROSS JOIN (SELECT filter_order, step, bit, CAST(earlier AS BIGINT) AS earlier FROM steps)
  GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    held = fold(F.col("doc_id"), 3) == 1
    model = qualitynet.learn(docs.filter(~held), labels.filter(~held))
    scored, names = qualitynet.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", held.alias("held_out"), *[F.col(c).alias(n) for n, c in names.items()]
    )


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), found AS (
  SELECT d, lang, source, unnest(terms) AS item FROM docs
), kept AS (
  SELECT lang, item FROM found GROUP BY lang, item HAVING count(DISTINCT d) >= 3
), counted AS (
  SELECT lang, source, item, count(*) AS n FROM found JOIN kept USING (lang, item) GROUP BY ALL
), sized AS (
  SELECT g.lang, g.source, coalesce(v.size, 0)::HUGEINT AS size, coalesce(c.total, 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang, source FROM docs) g
  LEFT JOIN (SELECT lang, count(*) AS size FROM kept GROUP BY lang) v USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counted GROUP BY ALL) c USING (lang, source)
), shares AS (
  SELECT s.lang, s.source, k.item, coalesce(c.n, 0) AS n,
    (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (s.total + s.size)) AS p
  FROM sized s JOIN kept k USING (lang) LEFT JOIN counted c USING (lang, source, item)
), whole AS (
  SELECT c.lang, c.item, (1 + (1000000000::HUGEINT * (c.n + 1)) // (t.total + t.size)) AS q
  FROM (SELECT lang, item, sum(n)::HUGEINT AS n FROM counted GROUP BY ALL) c
  JOIN (SELECT lang, sum(total)::HUGEINT AS total, any_value(size) AS size FROM sized GROUP BY lang) t USING (lang)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0) AS value
  FROM sized a JOIN sized b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS other, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.item = y.item AND x.source <> y.source
    GROUP BY ALL
  ) f ON f.lang = a.lang AND f.source = a.source AND f.other = b.source
), stand AS (
  SELECT lang, source, item, ((p - q) * (p - q)) // q AS value
  FROM shares JOIN whole USING (lang, item) WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value,
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank
  FROM pairs
  UNION ALL
  SELECT lang, source, 'term' AS part, item, value,
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank
  FROM stand QUALIFY rank <= 200
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_chat_format,
            op2_best_fit_packing,
            op3_toxicity,
            op4_byte_bpe,
            op5_quality_rules,
            op6_token_files,
            op7_license_scan,
            op8_exact_dedup,
            op9_simhash,
            op10_language_id,
            op11_filter_interaction,
            op12_quality_classifier,
            op13_source_divergence,
        )
    }


def oracles() -> dict[str, str]:
    return {
        "op1_chat_format": OP1_SQL,
        "op8_exact_dedup": OP8_SQL,
        "op11_filter_interaction": OP11_SQL,
        "op13_source_divergence": OP13_SQL,
    }
