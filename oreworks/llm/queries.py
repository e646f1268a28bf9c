"""One query per operator, over whole tables, returning its operator's full result."""

from __future__ import annotations

import string

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreworks.llm import bpe, chat, language, lm, merkle, neardup, packing, secret_scan, simhash, sketch, spelling, suffix, topk
from oreworks.llm.shipping import ship
from oreworks.llm.storage import cut

CAPACITY = 4096
END_ID = 1
SHARED_BYTES = 256  # some fifty words


def table(spark: SparkSession, folder: str, name: str, **options) -> DataFrame:
    ship(spark, **options)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_secret_scan(spark, folder):
    docs = table(spark, folder, "documents")
    found = secret_scan.scan(docs, secret_scan.train(docs))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = secret_scan.joined
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op2_language_id(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = language.remainder("doc_id", 4) == 2
    profiles = language.learn(docs.where(~held_out))
    named = language.predict(docs, profiles)
    return named.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_byte_bpe(spark, folder):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.digests(bpe.decode(encoded, ranks, public_tokenizers.PATTERN))


def op4_suffix_dedup(spark, folder):
    found = suffix.removals(table(spark, folder, "documents").select("doc_id", "text"), keep_first=False, shorter=SHARED_BYTES)
    return suffix.reported(found).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), F.col("shortened").alias("text"), "n_shared")


def op5_best_fit_packing(spark, folder):
    pieces = packing.token_pieces(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), CAPACITY, END_ID)
    return packing.pack(pieces, CAPACITY)


def op6_chat_formatting(spark, folder):
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    says = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-7).cast("long"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(says))
    done = chat.formatted(chat.gather(rows.union(more)))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(chat.loss_texts(F.col("turns")), "")
    return done.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_lm_scoring(spark, folder):
    return lm.score(table(spark, folder, "documents"), language.remainder("doc_id", 7) == 2)


def op8_near_duplicates(spark, folder):
    found = neardup.near_duplicates(table(spark, folder, "documents"), length=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op9_top_k_search(spark, folder):
    vectors = topk.quantized(table(spark, folder, "embeddings"), 256, "vec_id", "embedding")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, 5)


def op10_fingerprints(spark, folder):
    done = sketch.compared(sketch.with_next(table(spark, folder, "documents", batch_bytes=sketch.BATCH_BYTES)))
    return done.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op11_simhash(spark, folder):
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op12_merkle_manifest(spark, folder):
    docs = table(spark, folder, "documents")
    fields = lambda text: merkle.leaf(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], text)
    text = F.col("text").cast("string")
    small = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    presented = F.when(tampered, fields(small)).otherwise(fields(text))
    leaves = docs.select(merkle.tree_name(F.col("lang")).alias("tree"), "doc_id", fields(text).alias("digest"), presented.alias("presented"))
    found = merkle.proved(leaves, ["doc_id"])
    end = merkle.folded(F.col("proof"), F.col("presented"))
    found = found.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", F.sha2(merkle.sibling_text(F.col("proof")), 256).alias("proof_sha256"), end.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_spelling_variants(spark, folder):
    words = cut(spelling.vocabulary(table(spark, folder, "documents")))
    return spelling.variants(words)


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_language_id,
        op3_byte_bpe,
        op4_suffix_dedup,
        op5_best_fit_packing,
        op6_chat_formatting,
        op7_lm_scoring,
        op8_near_duplicates,
        op9_top_k_search,
        op10_fingerprints,
        op11_simhash,
        op12_merkle_manifest,
        op13_spelling_variants,
    )
}
_ESCAPED = "replace(replace(replace(replace({0}, '~', '~0'), '<', '~1'), '[', '~2'), ']', '~3')"
_LEAF = " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", "{0}"))

#: The learned models, tokenizers, sketches and iterative joins have no form that SQL runs on whole
#: tables; tests hold them against brute force.
SQL = {
    "op6_chat_formatting": f"""WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
whole AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text)
             FILTER (role = 'assistant'), '') AS loss,
    bool_or(regexp_matches(role || ' ' || text, '</?s>|\\[/?INST\\]|<</?SYS>>')
            OR contains(role, ']' || chr(10))) AS escaped,
    sum(2 * length(role) + length(text) + 14) AS plain_size,
    sum(2 * length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}) + 14) + 2
      AS escaped_size
  FROM said GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256,
       CAST(CASE WHEN escaped THEN escaped_size ELSE plain_size END AS BIGINT) AS formatted_chars
FROM whole""",
    "op12_merkle_manifest": f"""WITH RECURSIVE
small AS (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
  xor(list_reduce(list_transform(range(length(doc_id::VARCHAR)), lambda i: ascii(substr(doc_id::VARCHAR, i + 1, 1))::BIGINT),
    lambda c, b: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)),
    4294967295::BIGINT), 4294967295) % 3 = 0 AS tampered
  FROM documents),
leaves AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256({_LEAF.format("text")}) AS leaf,
  CASE WHEN tampered THEN sha256({_LEAF.format("lowered")}) ELSE sha256({_LEAF.format("text")}) END AS presented
  FROM small),
nodes(lvl, tree, pos, digest, n) AS (
  SELECT 0, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1, leaf,
         count(*) OVER (PARTITION BY tree) FROM leaves
  UNION ALL
  SELECT lvl + 1, tree, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (n + 7) // 8
  FROM nodes WHERE n > 1 GROUP BY lvl, tree, pos // 8, n),
subroots AS (SELECT tree, digest AS subroot, lvl AS height FROM nodes WHERE n = 1),
tops(lvl, pos, digest, n) AS (
  SELECT 0, row_number() OVER (ORDER BY tree) - 1, subroot, count(*) OVER () FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (n + 7) // 8
  FROM tops WHERE n > 1 GROUP BY lvl, pos // 8, n),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS pos,
  dense_rank() OVER (ORDER BY tree) - 1 AS top_pos FROM leaves),
steps AS (
  SELECT p.doc_id, lvl AS step, n.pos AS place, n.digest, p.pos // CAST(pow(8, lvl) AS BIGINT) AS own
  FROM placed p JOIN nodes n ON n.tree = p.tree AND n.n > 1
   AND n.pos // 8 = p.pos // CAST(pow(8, lvl + 1) AS BIGINT)
  UNION ALL
  SELECT p.doc_id, height + lvl, n.pos, n.digest, top_pos // CAST(pow(8, lvl) AS BIGINT)
  FROM placed p JOIN subroots USING (tree) JOIN tops n ON n.n > 1
   AND n.pos // 8 = p.top_pos // CAST(pow(8, lvl + 1) AS BIGINT)),
sides AS (SELECT doc_id, step, coalesce(string_agg(digest, '' ORDER BY place) FILTER (place < own), '') AS l,
  coalesce(string_agg(digest, '' ORDER BY place) FILTER (place > own), '') AS r FROM steps GROUP BY ALL),
fold(doc_id, step, digest) AS (
  SELECT doc_id, 0, presented FROM leaves
  UNION ALL
  SELECT f.doc_id, f.step + 1, sha256(l || digest || r) FROM fold f JOIN sides s ON f.doc_id = s.doc_id AND f.step = s.step),
ends AS (SELECT doc_id, max_by(digest, step) AS folded_root FROM fold GROUP BY doc_id),
texts AS (SELECT doc_id, string_agg(l || r, '' ORDER BY step) AS siblings FROM sides GROUP BY doc_id),
root AS (SELECT digest AS root FROM tops WHERE n = 1)
SELECT p.doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256, folded_root,
       folded_root = root AS verified
FROM placed p JOIN subroots USING (tree) JOIN ends USING (doc_id) LEFT JOIN texts USING (doc_id), root""",
    "op13_spelling_variants": r"""WITH RECURSIVE
spelled AS (SELECT coalesce(doc_id::VARCHAR, '') AS id,
    translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
runs AS (SELECT id, run, count(*) AS times, hex(encode(id || ':' || run)) AS code FROM spelled WHERE length(run) >= 5 GROUP BY ALL),
hashed AS (SELECT run, times, xor(list_reduce(
    list_transform(range(length(code) // 2), lambda i: ('0x' || substr(code, 2 * i + 1, 2))::BIGINT),
    lambda c, b: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)),
    4294967295::BIGINT), 4294967295) AS h FROM runs),
words AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
         CAST(sum(times) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(times) >= 3),
less AS (SELECT word, n, unnest(range(length(word))) AS i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM words),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT l.word, w.word, w.n FROM less l JOIN words w ON l.rest = w.word
  UNION SELECT w.word, l.word, l.n FROM less l JOIN words w ON l.rest = w.word),
best AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form,
    CASE WHEN near_n >= 2 * n THEN near_n END AS form_n FROM words LEFT JOIN best USING (word)),
follow(word, now, step) AS (
  SELECT word, word, 0 FROM words
  UNION ALL
  SELECT w.word, f.form, step + 1 FROM follow w JOIN forms f ON f.word = w.now WHERE f.form IS NOT NULL)
SELECT word, form, (SELECT max_by(now, step) FROM follow f WHERE f.word = forms.word) AS root, n, n_near, form_n FROM forms""",
    "op9_top_k_search": """WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(x::DOUBLE * 256) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND vec_id IS NOT NULL),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
         AS rank, vec_id, score
FROM scored QUALIFY rank <= 5""",
}
