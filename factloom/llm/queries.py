"""The registered query of each operator, with its contract's columns."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import bpe, chat, decontaminate, embeddup, fim, langid, lm, merkle, neardup, quality, secrets, tokencount, toxicity
from factloom.llm.common import fold, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, ~fold(4, 2))
    return toxicity.score(docs.select("doc_id", "text"), model, 0.3).select("doc_id", fold(4, 2).alias("held_out"), "score", "predicted")


def tokenizer_path(name: str) -> str:
    """Where the public tokenizers' files are: FACTLOOM_TOKENIZERS, or the installed package of them."""
    if folder := os.environ.get("FACTLOOM_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, ~fold(5, 0))
    return langid.predict(docs.select("doc_id", "text"), model).select("doc_id", fold(5, 0).alias("held_out"), "lang_pred", "score")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = tokencount.Pieces.from_sentencepiece(tokenizer_path("piece_bpe_32k.model"))
    return tokencount.token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), pieces).drop("text")


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm.score(table(spark, sf_dir, "documents"), ~fold(7, 2))
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = chat.perspectives(table(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda m: F.concat_ws("-", m["start"].cast("string"), m["end"].cast("string")))
    return made.withColumn("mask", F.array_join(spans, ","))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def token_digests(df: DataFrame) -> DataFrame:
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return df.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_digests(bpe.encode(docs, tokenizer_path("word_bpe_49k.json"), decoded=True).drop("text"))


def op9_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels, ~fold(3, 1))
    return quality.score(docs.select("doc_id", "text"), model, 0.5).select("doc_id", fold(3, 1).alias("held_out"), "score", "predicted")


def op11_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = secrets.KINDS[:3]
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    digest = F.sha2(listed(F.filter("spans", lambda s: s["kind"].isin(*base))), 256)
    return found.select("doc_id", *map(count, base), digest.alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = {c: F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")}
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    told = F.when((F.crc32(F.col("doc_id").cast("string")) % 7 == 0) & F.col("n_chars").isNotNull(), merkle.leaf_hash(*(fields | {"n_chars": more}).values()))
    made = merkle.manifest(docs.withColumn("told", told), merkle.leaf_hash(*fields.values()), keep=("doc_id", "told"))
    root = merkle.folded(F.coalesce("told", "leaf"), F.col("path"))
    out = made.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), root.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    restored = fim.restore(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_embedding_neardup": op2_embedding_neardup,
    "op3_language_id": op3_language_id,
    "op4_token_counts": op4_token_counts,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_chat_perspectives": op6_chat_perspectives,
    "op7_decontamination": op7_decontamination,
    "op8_bpe": op8_bpe,
    "op9_minhash_neardup": op9_minhash_neardup,
    "op10_quality": op10_quality,
    "op11_secret_scans": op11_secret_scans,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_fill_in_middle": op13_fill_in_middle,
}


def _secrets_sql() -> str:
    """op11: matches and gaps by kind, running sums, and the interval join as a plain condition."""
    quoted = {k: "'" + p.replace("'", "''") + "'" for k, p in secrets.PATTERNS.items()}
    holds = {
        "assign": f"length(regexp_extract(m, {quoted['assign']}, 2)) >= 8",
        "client": f"length(regexp_extract(m, {quoted['client']}, 2)) >= 3",
        "secret": "length(m) <= 128 AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[0-9]')",
    }
    each = " UNION ALL ".join(
        f"SELECT rid, k, i, gap, size, {holds.get(k, 'true')} AS holds FROM (SELECT rid, {n} AS k, generate_subscripts(ms, 1) AS i, unnest(ms) AS m, length(m) AS size, length(unnest(gs[:len(ms)])) AS gap"
        f" FROM (SELECT rid, regexp_extract_all(t, {quoted[k]}) AS ms, string_split_regex(t, {quoted[k]}) AS gs FROM d))"
        for n, k in enumerate(secrets.KINDS)
    )
    name = "['" + "', '".join(secrets.KINDS) + "'][k + 1]"
    base = "b.k IN (0, 1, 2)"
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
e AS ({each}),
p AS MATERIALIZED (SELECT rid, k, CAST(hi - size AS BIGINT) AS lo, CAST(hi AS BIGINT) AS hi FROM (SELECT *, sum(gap + size) OVER (PARTITION BY rid, k ORDER BY i) AS hi FROM e) WHERE holds),
w AS (SELECT a.rid, a.k, a.lo, a.hi, bool_or(b.k IN (1, 3)) AS ident, bool_or(b.k IN (0, 2, 4)) AS secret, bool_or({base} AND b.lo < a.hi AND b.hi > a.lo) AS inside
  FROM p a JOIN p b ON a.rid = b.rid AND b.lo <= a.hi + 256 AND b.hi >= a.lo - 256 WHERE a.k > 2 GROUP BY ALL),
s AS (SELECT rid, k, lo, hi FROM p WHERE k < 3 UNION ALL SELECT rid, k, lo, hi FROM w WHERE NOT inside AND CASE k WHEN 3 THEN secret WHEN 4 THEN ident ELSE secret AND ident END),
r AS (SELECT rid, count(*) FILTER (k = 0) AS n0, count(*) FILTER (k = 1) AS n1, count(*) FILTER (k = 2) AS n2,
  string_agg({name} || ':' || lo || ':' || hi, ',' ORDER BY lo, k) FILTER (k < 3) AS base, string_agg({name} || ':' || lo || ':' || hi, ',' ORDER BY lo, k) AS spans FROM s GROUP BY rid)
SELECT doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN r USING (rid)
"""


def _manifest_sql() -> str:
    """op12: the levels of all trees by recursion, then each leaf's walk up through its language's tree and the top one."""
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda n: "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", n, "text"))) + ")"
    rise = "SELECT g, level + 1, pos // 2, CAST((size + 1) // 2 AS BIGINT), sha256(string_agg(h, '' ORDER BY pos)) FROM {0} WHERE size > 1 GROUP BY g, level, pos // 2, size"
    walk = (
        "SELECT c.rid, c.g, c.level + 1, c.pos // 2, (c.size + 1) // 2, c.proof || coalesce(s.h, ''), CASE WHEN s.h IS NULL THEN sha256(c.fold) WHEN c.pos % 2 = 1 THEN sha256(s.h || c.fold) ELSE sha256(c.fold || s.h) END"
        " FROM {0} c LEFT JOIN {1} s ON s.g IS NOT DISTINCT FROM c.g AND s.level = c.level AND s.pos = xor(c.pos, 1) WHERE c.size > 1"
    )
    return f"""
WITH RECURSIVE l AS MATERIALIZED (SELECT rid, doc_id, lang AS g, leaf, told, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS size FROM (
  SELECT row_number() OVER () AS rid, doc_id, lang, {leaf("n_chars")} AS leaf,
    CASE WHEN n_chars IS NOT NULL AND crc32 % 7 = 0 THEN {leaf("(CAST(n_chars AS HUGEINT) + 1)")} ELSE {leaf("n_chars")} END AS told FROM (SELECT *, {_CRC32} AS crc32 FROM documents))),
t AS (SELECT g, 0 AS level, pos, size, leaf AS h FROM l UNION ALL {rise.format("t")}),
r AS MATERIALIZED (SELECT g, h AS subroot, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS pos, count(*) OVER () AS size FROM t WHERE size = 1),
u AS (SELECT 0 AS g, 0 AS level, pos, size, subroot AS h FROM r UNION ALL {rise.format("u")}),
tt AS MATERIALIZED (SELECT * FROM t), uu AS MATERIALIZED (SELECT * FROM u),
w AS (SELECT rid, g, 0 AS level, pos, size, '' AS proof, told AS fold FROM l UNION ALL {walk.format("w", "tt")}),
x AS (SELECT w.rid, 0 AS g, 0 AS level, r.pos, r.size, w.proof, w.fold FROM w JOIN r ON r.g IS NOT DISTINCT FROM w.g WHERE w.size = 1 UNION ALL {walk.format("x", "uu")})
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = root AS verified
FROM l JOIN (SELECT rid, proof, fold FROM x WHERE size = 1) USING (rid) JOIN r ON r.g IS NOT DISTINCT FROM l.g, (SELECT h AS root FROM u WHERE size = 1)
"""


# CRC-32 bit by bit, of a decimal number's digits: DuckDB has no function for it.
_CRC32 = (
    "xor(CAST(4294967295 AS BIGINT), list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)), lambda s, c: list_reduce([CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0],"
    " lambda v, b: CASE WHEN v & 1 = 1 THEN xor(v >> 1, CAST(3988292384 AS BIGINT)) ELSE v >> 1 END, xor(s, c)), CAST(4294967295 AS BIGINT)))"
)


def _middle_sql() -> str:
    """op13: units as lists, their lengths summed up to each cut."""
    draw = lambda k: f"CAST('0x' || substr(h, {8 * k + 1}, 8) AS BIGINT)"
    upto = lambda c: f"CAST(coalesce(list_sum(list_transform(u[:{c}], lambda x: length(x))), 0) AS BIGINT)"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
e AS (SELECT *, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u, len(u) AS n, {draw(0)} % (n + 1) AS x, {draw(1)} % (n + 1) AS y,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {draw(2)} % 100 >= 50 THEN 'plain' WHEN {draw(3)} % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM d),
f AS (SELECT *, {upto("least(x, y)")} AS a, {upto("greatest(x, y)")} AS b FROM e),
g AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(p || m || s) AS restored_sha256 FROM g
"""


#: DuckDB SQL for those queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op6_chat_perspectives": """
WITH r AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
s AS (SELECT DISTINCT conv_id AS of_id, role AS speaker FROM r WHERE role <> 'system'),
m AS (
  SELECT conv_id, speaker, coalesce(CAST(floor(turn / 256) AS BIGINT), -1) AS part, turn, role, text, role = speaker AS own,
         CASE WHEN role = speaker THEN '<|assistant|>' WHEN role = 'system' THEN '<|system|>' ELSE '<|user name=' || role || '|>' END || chr(10) AS head
  FROM r JOIN s ON conv_id IS NOT DISTINCT FROM of_id),
n AS (
  SELECT *, head || text || '<|end|>' || chr(10) AS piece,
         sum(length(head || text) + 8) OVER (PARTITION BY conv_id, speaker, part ORDER BY turn NULLS FIRST, role, text) AS upto
  FROM m)
SELECT conv_id, speaker, part, count(*) AS n_turns,
       string_agg(piece, '' ORDER BY turn NULLS FIRST, role, text) AS rendered,
       coalesce(string_agg(CASE WHEN own THEN CAST(upto - length(text) - 8 AS BIGINT) || '-' || CAST(upto - 1 AS BIGINT) END, ',' ORDER BY turn NULLS FIRST, role, text), '') AS mask
FROM n GROUP BY conv_id, speaker, part
""",
    "op11_secret_scans": _secrets_sql(),
    "op12_merkle_manifest": _manifest_sql(),
    "op13_fill_in_middle": _middle_sql(),
}
