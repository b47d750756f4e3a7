"""The operators over whole tables, with production parameters, and equivalent SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, lexical, license_scan, line_dedup, lm_scoring, merkle, mixing, nearest, ngram_join, sharding, suffix_dedup, toxicity
from .common import lower_ascii, table

SHARDS = 24
SEED = 11


def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return ngram_join.jaccard_components(docs).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.line_dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return lm_scoring.score_texts(docs, crc_share(10) != 0).select(
        F.col("id").alias("doc_id"), (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return sharding.shard_by_bytes(docs, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(table(spark, folder, "documents"), seed=SEED)


def op6_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return nearest.nearest_neighbours(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def crc_share(n: int):
    """crc32 of the id as text, modulo ``n``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(docs.where(crc_share(5) != 0), table(spark, folder, "labels"))
    scored = toxicity.toxicity_scores(docs, model)
    return scored.select("doc_id", (crc_share(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    read = chat.read_back(chat.format_conversations(turns.unionByName(extra)))
    whole = read.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("window", "turns", "answers"))).alias("ws"), F.sum("chars").alias("formatted_chars"))
    lines = F.transform(F.flatten(F.transform("ws", lambda w: w["turns"])), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    whole = whole.select("conv_id", "formatted_chars", lines.alias("lines"),
                         F.array_join(F.flatten(F.transform("ws", lambda w: w["answers"])), "").alias("answers"))
    return whole.select(
        "conv_id", F.size("lines").cast("long").alias("n_turns"), F.sha2(F.array_join("lines", ""), 256).alias("turns_sha256"),
        F.char_length("answers").cast("long").alias("loss_chars"), F.sha2("answers", 256).alias("loss_sha256"), "formatted_chars")


def op11_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    scanned = license_scan.scan_licenses(table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", "licenses.*")
    return scanned.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
                          F.array_join("labels", ",").alias("labels"), "score")


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    tampered = merkle.leaf_hash(*[lower_ascii(F.col(c)) if c == "text" else F.col(c) for c in merkle.COLUMNS])
    manifest = merkle.build_manifest(table(spark, folder, "documents"), F.when(crc_share(5) == 0, tampered))
    return merkle.prove(manifest).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES = {f.__name__: f for f in (op1_ngram_join, op2_line_dedup, op3_lm_scoring, op4_sharding, op5_mixing, op6_nearest_neighbours, op7_toxicity, op8_decontamination, op9_suffix_dedup, op10_chat_formatting,
                                  op11_license_scan, op12_lexical_search, op13_merkle_manifest)}

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _grams(source: str, key: str) -> str:
    """Distinct five-word runs (or the whole of fewer words) of a table, as text."""
    return f"""
    SELECT DISTINCT {key}, CASE WHEN n >= 5 THEN array_to_string(w[i : i + 4], ' ') ELSE array_to_string(w, ' ') END AS gram
    FROM (SELECT {key}, w, n, unnest(range(1, greatest(n - 4, 1) + 1)) AS i
          FROM (SELECT {key}, w, len(w) AS n
                FROM (SELECT {key}, list_filter(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
                      FROM {source})) WHERE n > 0)"""


def _leaf(text: str) -> str:
    """A row as the Merkle leaf's input."""
    return " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || ({c})::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text))


#: The terms of a text, lower-cased.
_TERMS = "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
#: The nodes above a list of nodes.
_MERGED = "list_transform(range(0, (len(nodes) + 15) // 16), lambda k: sha256(array_to_string(nodes[k * 16 + 1 : k * 16 + 16], '')))"
def _crc(text: str) -> str:
    """crc32 of a text's UTF-8 bytes: each byte is mixed in, eight shifts (-1) follow."""
    shifts = ", ".join(["-1"] * 8)
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(regexp_extract_all(hex(encode({text})), '..'), "
            f"lambda x: [('0x' || x)::BIGINT, {shifts}]))), "
            "lambda c, o: CASE WHEN o >= 0 THEN xor(c, o) ELSE xor(c >> 1, (c & 1) * 3988292384) END))")


_CRC = _crc("doc_id::VARCHAR")


def _phrases() -> str:
    """The licence rules as rows (num, template, place, words, label, base)."""
    rules = license_scan.rules_of(license_scan.BASE, license_scan.TEMPLATES)
    return ", ".join(f"({n}, {p.template}, {p.at}, {list(p.words)}, '{rules.labels[p.template]}', {rules.base[p.template]})"
                     for n, p in enumerate(rules.phrases))


ORACLES = {
    "op2_line_dedup": f"""
WITH lines AS (
  SELECT doc_id, pos, line, {_LOWER.format(f"trim(line, {_BLANKS})")} AS k
  FROM (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
shared AS (SELECT k, min(doc_id) AS keeper FROM lines WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT l.*, (s.k IS NOT NULL AND l.doc_id > s.keeper) AS gone FROM lines l LEFT JOIN shared s ON l.k = s.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op4_sharding": f"""
WITH sized AS (SELECT doc_id, coalesce(strlen(text), 0) + 8 AS size, {_crc("coalesce(text, '')")} AS text_crc32 FROM documents),
placed AS (SELECT *, sum(size) OVER w - size AS start, sum(size) OVER () AS total FROM sized
           WINDOW w AS (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING)),
cut AS (SELECT *, (start * {SHARDS} // total)::INT AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY start) - 1 AS slot, NULL::INT AS grown_shard FROM cut""",
    "op5_mixing": f"""
WITH RECURSIVE rates AS (
  SELECT source_key, 1.0::DOUBLE / (sum(1.0::DOUBLE) OVER ()) * (sum(n) OVER ())::DOUBLE / n AS repetition_rate
  FROM (SELECT coalesce(source, '') AS source_key, count(*) AS n FROM documents GROUP BY 1)),
parts AS (SELECT *, greatest(ceil(repetition_rate / 64.0), 1)::INT AS draws, repetition_rate / greatest(ceil(repetition_rate / 64.0), 1) AS mean FROM rates),
cdf(source_key, mean, k, p, c) AS (
  SELECT source_key, mean, 0, exp(-mean), exp(-mean) FROM parts
  UNION ALL
  SELECT source_key, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM cdf WHERE k < mean + 12 * sqrt(mean) + 20),
keyed AS (SELECT d.*, '{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || p.source_key AS key, p.source_key, repetition_rate, draws
          FROM documents d JOIN parts p ON coalesce(d.source, '') = p.source_key),
drawn AS (SELECT key, source_key, ('0x' || substr(md5(key || ':' || j), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u
          FROM (SELECT DISTINCT key, source_key, unnest(range(1, draws + 1)) AS j FROM keyed)),
numbers AS (SELECT d.key, count(*) FILTER (c.c <= d.u) AS n_copies FROM drawn d JOIN cdf c ON d.source_key = c.source_key GROUP BY d.key)
SELECT doc_id, text, lang, source, n_chars, repetition_rate, n_copies::INT AS n_copies, copy::INT AS copy, md5('order:' || key || ':' || copy) AS shuffle_key
FROM (SELECT k.*, n_copies, unnest(range(1, n_copies + 1)) AS copy FROM keyed k JOIN numbers n ON k.key = n.key)""",
    "op8_decontamination": f"""
WITH d AS ({_grams("documents", "doc_id")}), b AS ({_grams("benchmark", "item_id")}),
sizes AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id)
SELECT doc_id, item_id, n_shared, n_item
FROM (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN b ON d.gram = b.gram GROUP BY doc_id, item_id) JOIN sizes USING (item_id)
WHERE 100 * n_shared >= 80 * n_item""",
    "op10_chat_formatting": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
p AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
         '<|turn|>' || url_encode(role) || chr(10) || replace(replace(text, '\', '\b'), '<', '\l') || '<|end|>' AS piece FROM t),
q AS (SELECT *, (n = 1 AND role = 'system') AS leads, length(piece) AS len,
             CASE WHEN n = 1 AND role = 'system' THEN 0 ELSE (strlen(piece) + 3) // 4 END AS tokens FROM p),
r AS (SELECT *, sum(tokens) OVER (PARTITION BY conv_id ORDER BY n) AS fin FROM q),
s AS (SELECT *, fin - tokens AS start, floor((fin - tokens) / 512)::BIGINT * 2 + (floor((fin - 1) / 512) > floor((fin - tokens) / 512))::INT AS win FROM r),
opened AS (
  SELECT * FROM (SELECT conv_id, start, win, coalesce(lag(win) OVER (PARTITION BY conv_id ORDER BY n), -2) AS before FROM s WHERE NOT leads) WHERE win <> before),
repeated AS (
  SELECT s.conv_id, sum(s.len) AS chars FROM s JOIN opened o ON o.conv_id IS NOT DISTINCT FROM s.conv_id
   AND o.start BETWEEN s.start + 1 AND s.start + 128 AND o.win <> s.win WHERE NOT s.leads GROUP BY s.conv_id),
headed AS (
  SELECT s.conv_id, s.len * (greatest(count(o.win), 1) - 1) AS chars FROM s LEFT JOIN opened o ON o.conv_id IS NOT DISTINCT FROM s.conv_id
  WHERE s.leads GROUP BY s.conv_id, s.len),
whole AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY n) AS lines, sum(len) AS chars,
         coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '') AS answers FROM s GROUP BY conv_id)
SELECT w.conv_id, n_turns, sha256(lines) AS turns_sha256, length(answers) AS loss_chars, sha256(answers) AS loss_sha256,
       (w.chars + coalesce(a.chars, 0) + coalesce(h.chars, 0))::BIGINT AS formatted_chars
FROM whole w LEFT JOIN repeated a ON a.conv_id IS NOT DISTINCT FROM w.conv_id LEFT JOIN headed h ON h.conv_id IS NOT DISTINCT FROM w.conv_id""",
    "op11_license_scan": f"""
WITH phrases AS (SELECT *, count(*) OVER w AS n_phrases, min(num) OVER w AS first_num, sum(len(words)) OVER w AS n_key
                 FROM (VALUES {_phrases()}) v(num, template, place, words, label, base) WINDOW w AS (PARTITION BY template)),
d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
places AS (
  SELECT doc_id, num, template, start, len(words) AS size, floor((start - place) / {license_scan.SLACK}) AS cell, label, base, n_phrases, first_num, n_key
  FROM (SELECT *, unnest(range(0, len(w) - len(words) + 1)) AS start FROM d JOIN phrases
        ON contains(' ' || array_to_string(w, ' ') || ' ', ' ' || array_to_string(words, ' ') || ' '))
  WHERE w[start + 1 : start + len(words)] = words),
met AS (
  SELECT f.doc_id, f.label, f.base FROM places f JOIN places o ON o.doc_id = f.doc_id AND o.template = f.template AND abs(o.cell - f.cell) <= 1
  WHERE f.num = f.first_num GROUP BY f.doc_id, f.template, f.cell, f.label, f.base, f.n_phrases HAVING count(DISTINCT o.num) = f.n_phrases),
labelled AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM met GROUP BY doc_id),
shares AS (SELECT doc_id, max(share) AS score FROM (
  SELECT doc_id, sum(size) / max(n_key)::DOUBLE AS share FROM (SELECT DISTINCT doc_id, template, num, size, n_key FROM places) GROUP BY doc_id, template) GROUP BY doc_id),
own AS (SELECT doc_id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word FROM places WHERE base GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM d LEFT JOIN labelled USING (doc_id) LEFT JOIN shares USING (doc_id) LEFT JOIN own USING (doc_id)""",
    "op12_lexical_search": f"""
WITH terms AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
postings AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term),
lengths AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS all_terms FROM lengths),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM postings, whole GROUP BY term, docs),
items AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
scored AS (
  SELECT i.item_id, p.doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // all_terms))))::BIGINT AS score
  FROM items i JOIN postings p USING (term) JOIN weights USING (term) JOIN lengths l ON l.doc_id = p.doc_id, whole GROUP BY i.item_id, p.doc_id)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 10""",
    "op13_merkle_manifest": f"""
WITH RECURSIVE rows_ AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, sha256({_leaf("text")}) AS leaf,
         CASE WHEN {_CRC} % 5 = 0 THEN sha256({_leaf(_LOWER.format("text"))}) END AS claimed FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM rows_),
levels(tree, level, nodes) AS (
  SELECT tree, 0, list(leaf ORDER BY pos) FROM placed GROUP BY tree
  UNION ALL SELECT tree, level + 1, {_MERGED} FROM levels WHERE len(nodes) > 1),
subroots AS (SELECT tree, nodes[1] AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos FROM levels WHERE len(nodes) = 1),
top(level, nodes) AS (
  SELECT 0, list(subroot ORDER BY pos) FROM subroots
  UNION ALL SELECT level + 1, {_MERGED} FROM top WHERE len(nodes) > 1),
steps AS (
  SELECT p.doc_id, p.tree, p.pos, 0 AS part, l.level, l.nodes, (p.pos // (16 ** l.level)::BIGINT) AS i
  FROM placed p JOIN levels l ON l.tree = p.tree AND len(l.nodes) > 1
  UNION ALL SELECT p.doc_id, p.tree, p.pos, 1, t.level, t.nodes, (s.pos // (16 ** t.level)::BIGINT)
  FROM placed p JOIN subroots s ON s.tree = p.tree JOIN top t ON len(t.nodes) > 1),
sides AS (
  SELECT tree, pos, part, level, array_to_string(nodes[i // 16 * 16 + 1 : i], '') AS l, array_to_string(nodes[i + 2 : i // 16 * 16 + 16], '') AS r FROM steps),
witnesses AS (
  SELECT tree, pos, list(l || '|' || r ORDER BY part, level) AS w, string_agg(l || r, '' ORDER BY part, level) AS siblings FROM sides GROUP BY tree, pos),
folded AS (
  SELECT p.doc_id, p.leaf, s.subroot, (SELECT nodes[1] FROM top WHERE len(nodes) = 1) AS root, sha256(coalesce(siblings, '')) AS proof_sha256,
         list_reduce(list_prepend(coalesce(claimed, leaf), coalesce(w, [])), lambda x, y: sha256(split_part(y, '|', 1) || x || split_part(y, '|', 2))) AS folded_root
  FROM placed p JOIN subroots s ON s.tree = p.tree LEFT JOIN witnesses v ON v.tree = p.tree AND v.pos = p.pos)
SELECT *, folded_root = root AS verified FROM folded""",
}
