"""Registered queries of the corpus operators and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, embeddings, exact_dedup, fim, language, licenses, lines, merkle, minhash, mixing, packing, scoring, secrets
from tidemark.llm._tables import read_table


def vocabulary(name: str) -> str:
    """Where the public tokenizer files lie; every machine of the cluster has them installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(read_table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup_report(read_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.scan(read_table(spark, sf_dir, "documents")))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op7_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return scoring.score(docs, F.pmod(language.crc_of(docs["doc_id"]), F.lit(10)) == 0)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree: source, language, a directory for each thousand ids."""
    docs = read_table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 1000), F.concat(F.col("doc_id"), F.lit(".txt")))
    return licenses.scan(docs, path)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.pmod(language.crc_of(F.col("doc_id")), F.lit(4)) == 2
    model = language.train(docs.filter(~held_out))
    found = language.predict(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_report(read_table(spark, sf_dir, "documents"))


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts are made of control strings."""
    said = read_table(spark, sf_dir, "conversations")
    odd = spark.range(0, 2, 1, 1).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text")
    )
    return chat.read_back(chat.format_chats(said.select(*odd.columns).unionByName(odd)))


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.report(fim.fill_in_middle(read_table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embeddings": op1_embeddings,
    "op2_lines": op2_lines,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_mixing": op4_mixing,
    "op5_secrets": op5_secrets,
    "op6_minhash": op6_minhash,
    "op7_scoring": op7_scoring,
    "op8_packing": op8_packing,
    "op9_licenses": op9_licenses,
    "op10_language": op10_language,
    "op11_merkle": op11_merkle,
    "op12_chat": op12_chat,
    "op13_fim": op13_fim,
}

ORACLES: dict[str, str] = {
    "op3_exact_dedup": """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents
), g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g ON d.norm = g.norm
""",
    "op4_mixing": r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS h
  FROM documents
), per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
placed AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place FROM per
), weighed AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM placed
), dried AS (
  SELECT *, CAST(2 * source_size AS DOUBLE) / weight AS dry, 1.5 * CAST(sum(source_size) OVER () AS DOUBLE) AS budget FROM weighed
), filled AS (
  SELECT *, (budget - CAST(coalesce(sum(2 * source_size) OVER w, 0) AS DOUBLE)) / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS DOUBLE) AS v
  FROM dried WINDOW w AS (ORDER BY dry, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), ended AS (SELECT v AS ends FROM filled WHERE v <= dry ORDER BY dry, place LIMIT 1),
targets AS (
  SELECT f.*, least(CAST(2 * source_size AS DOUBLE), weight * ended.ends) AS target FROM filled f, ended
), queued AS (
  SELECT d.doc_id, d.size, d.h, t.place, t.weight, t.source_size, t.target, t.budget,
         CAST(sum(d.size) OVER (PARTITION BY t.place ORDER BY d.h, d.doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), copies AS (
  SELECT q.*, e.epoch, CAST(e.epoch * source_size + upto AS DOUBLE) / weight AS finish FROM queued q, (VALUES (0), (1)) e(epoch)
), ranked AS (
  SELECT *, sum(size) OVER (ORDER BY finish, place, epoch, h, doc_id ROWS UNBOUNDED PRECEDING) AS run FROM copies
)
SELECT doc_id, size, source_size, target, CAST(sum(CASE WHEN run <= floor(budget) THEN size ELSE 0 END) AS BIGINT) AS taken
FROM ranked GROUP BY doc_id, size, source_size, target
""",
    "op11_merkle": """
WITH RECURSIVE crcs AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), d AS (
  SELECT doc_id, source, lang, n_chars, text,
         doc_id IS NOT NULL AND xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 5 = 0 AS touched
  FROM documents, crcs
), parts AS (
  SELECT doc_id, source, touched,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS before,
         text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM d
), hashed AS (
  SELECT doc_id, source, sha256(before || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(before || CASE WHEN touched THEN coalesce(strlen(low) || ':' || low, '-') ELSE coalesce(strlen(text) || ':' || text, '-') END) AS seen
  FROM parts
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY source) AS n FROM hashed
), up AS (
  SELECT coalesce('+' || source, '') AS tree, 0 AS level, place, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT tree, level + 1, place // 16, (max(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY place)) FROM up WHERE n > 1 GROUP BY tree, level, place // 16
), subroots AS (
  SELECT tree, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n, digest FROM up WHERE n = 1
), over AS (
  SELECT 0 AS level, place, n, digest FROM subroots
  UNION ALL
  SELECT level + 1, place // 16, (max(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY place)) FROM over WHERE n > 1 GROUP BY level, place // 16
), steps AS (
  SELECT a.tree, a.level, a.place, coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (WHERE b.place < a.place), '') AS before, coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (WHERE b.place > a.place), '') AS after
  FROM up a JOIN up b ON a.tree = b.tree AND a.level = b.level AND a.place // 16 = b.place // 16 WHERE a.n > 1 GROUP BY a.tree, a.level, a.place
), top_steps AS (
  SELECT a.level, a.place, coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (WHERE b.place < a.place), '') AS before, coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (WHERE b.place > a.place), '') AS after
  FROM over a JOIN over b ON a.level = b.level AND a.place // 16 = b.place // 16 WHERE a.n > 1 GROUP BY a.level, a.place
), walk AS (
  SELECT doc_id, leaf, coalesce('+' || source, '') AS tree, 0 AS level, place AS first, place, n, seen AS fold, '' AS proof FROM leaves
  UNION ALL
  SELECT w.doc_id, w.leaf, w.tree, w.level + 1, w.first, w.place // 16, (w.n + 15) // 16, sha256(s.before || w.fold || s.after), w.proof || s.before || s.after
  FROM walk w JOIN steps s ON w.tree = s.tree AND w.level = s.level AND w.place = s.place
), walk_top AS (
  SELECT w.doc_id, w.leaf, w.tree, w.first, s.digest AS subroot, 0 AS level, s.place, s.n, w.fold, w.proof FROM walk w JOIN subroots s ON w.tree = s.tree WHERE w.n = 1
  UNION ALL
  SELECT w.doc_id, w.leaf, w.tree, w.first, w.subroot, w.level + 1, w.place // 16, (w.n + 15) // 16, sha256(s.before || w.fold || s.after), w.proof || s.before || s.after
  FROM walk_top w JOIN top_steps s ON w.level = s.level AND w.place = s.place
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = root AS verified
FROM walk_top, (SELECT digest AS root FROM over WHERE n = 1) WHERE n = 1
""",
    "op12_chat": r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(text) + (length(text) - length(replace(text, '\', '')))
    - (length(text) - length(replace(text, '[/INST]', ''))) // 7 * 5 - (length(text) - length(replace(text, '[/ROLE]', ''))) // 7 * 5
    - (length(text) - length(replace(text, '[INST]', ''))) // 6 * 4 - (length(text) - length(replace(text, '[/SYS]', ''))) // 6 * 4
    - (length(text) - length(replace(text, '[ROLE]', ''))) // 6 * 4 - (length(text) - length(replace(text, '[SYS]', ''))) // 5 * 3
    - (length(text) - length(replace(text, '</s>', ''))) // 4 * 2 - (length(text) - length(replace(text, '<s>', ''))) // 3
    + CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE 17 + length(role) END AS chars
  FROM said
), places AS (
  SELECT *, row_number() OVER w - 1 AS place, lag(role, 1, 'start') OVER w AS before, lead(role) OVER w AS after FROM sized WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), judged AS (
  SELECT *, CASE WHEN (before, role) NOT IN (('start', 'system'), ('start', 'user'), ('system', 'user'), ('user', 'assistant'), ('assistant', 'user')) THEN place WHEN after IS NULL AND role = 'system' THEN place + 1 END AS wrong FROM places
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars, min(wrong) IS NULL AS valid, min(wrong) AS fault
FROM judged GROUP BY conv_id
""",
    "op13_fim": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), drawn AS (
  SELECT *, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM d
), ranked AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS low, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS high,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), cut AS (
  SELECT *, array_to_string(units[1:low], '') AS prefix, array_to_string(units[low + 1:high], '') AS middle, array_to_string(units[high + 1:], '') AS suffix FROM ranked
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
""",
}
