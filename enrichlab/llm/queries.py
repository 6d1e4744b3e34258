"""The registered queries of this folder: each applies one operator, with its production
parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from enrichlab.llm.bpe import encode_and_decode
from enrichlab.llm.chat_format import PART_TYPE, format_chats, read_back
from enrichlab.llm.common import crc_bucket, read
from enrichlab.llm.decontaminate import find_leaks
from enrichlab.llm.fingerprints import compare_with_edited
from enrichlab.llm.importance import resample
from enrichlab.llm.language_id import identify, learn
from enrichlab.llm.manifest import build_manifest, fold, leaf_digest, prove, siblings
from enrichlab.llm.minhash_dedup import near_duplicate_classes
from enrichlab.llm.passage_dedup import repeated_passages
from enrichlab.llm.quality_classifier import score, train
from enrichlab.llm.quality_rules import measure_quality
from enrichlab.llm.secret_scan import BASE_KINDS, scan_secrets
from enrichlab.llm.token_counts import count_tokens

TOKEN_LIMIT = 2048


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(read(spark, sf_dir, "documents"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


#: The contract's extra conversation.
EXTRA_TURNS = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.createDataFrame(EXTRA_TURNS, "conv_id long, turn long, role string, text string"))
    part = F.array(F.struct(F.lit("text").alias("type"), F.col("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("units")))
    return read_back(format_chats(turns.withColumn("parts", part.cast(PART_TYPE))))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure_quality(read(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = encode_and_decode(read(spark, sf_dir, "documents"))
    return done.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(read(spark, sf_dir, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *map(count, BASE_KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = crc_bucket("doc_id", 3) == 1
    found = identify(docs, learn(docs, ~held_out))
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous")


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(read(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = crc_bucket("doc_id", 4) == 2
    scored = score(docs, train(docs, read(spark, sf_dir, "labels"), ~held_out))
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(read(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


#: What a leaf of the manifest commits to, in this order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def op12_dataset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    shorter = [F.replace("text", F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in LEAF_COLUMNS]
    tampered = (crc_bucket("doc_id", 2) == 0) & F.col("text").contains("\n")
    found = F.when(tampered, leaf_digest(shorter)).otherwise(leaf_digest([F.col(c) for c in LEAF_COLUMNS]))
    proofs = prove(build_manifest(docs, columns=LEAF_COLUMNS, carry={"found": found}))
    folded = fold(F.col("found"), F.col("steps"))
    return proofs.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("steps")), 256).alias("proof_sha256"), folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = compare_with_edited(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next", F.size("changed").cast("long").alias("n_changed"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_chat_format": op2_chat_format,
    "op3_quality_rules": op3_quality_rules,
    "op4_bpe": op4_bpe,
    "op5_secret_scan": op5_secret_scan,
    "op6_decontamination": op6_decontamination,
    "op7_language_id": op7_language_id,
    "op8_minhash_dedup": op8_minhash_dedup,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_dataset_manifest": op12_dataset_manifest,
    "op13_document_fingerprints": op13_document_fingerprints,
}

#: Control strings whose first character gets a backslash, as a pattern without look-ahead.
_CONTROL_SQL = r"\\|<\||</?s>|\[/?INST\]|</?SYS>"

ORACLE: dict[str, str] = {
    "op2_chat_format": rf"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL
            SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
        )
        SELECT conv_id,
               count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(23 + length(role) + length(text)
                        + len(regexp_extract_all(role, '{_CONTROL_SQL}'))
                        + len(regexp_extract_all(text, '{_CONTROL_SQL}'))) AS BIGINT) AS formatted_chars
        FROM turns GROUP BY conv_id
    """,
    "op11_importance_resampling": r"""
        WITH steps AS (
            SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS tab
        ), texts AS (
            SELECT 'd' AS kind, doc_id AS id, row_number() OVER () AS k, text FROM documents
            UNION ALL SELECT 'b', NULL, row_number() OVER (), text FROM benchmark
        ), worded AS (
            SELECT kind, id, k, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
        ), runs AS (
            SELECT kind, id, k, len(w) AS n_words,
                   list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]), list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS f
            FROM worded
        ), features AS (SELECT kind, id, k, unnest(f) AS f FROM runs),
        hexed AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM features)),
        hashed AS (
            SELECT f, xor(list_reduce(list_transform(range(1, len(h), 2), lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT)),
                                      lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
            FROM hexed, steps
        ), found AS (SELECT kind, id, k, bucket FROM features JOIN hashed USING (f)),
        counts AS (SELECT bucket, count(*) FILTER (kind = 'd') AS s, count(*) FILTER (kind = 'b') AS t FROM found GROUP BY bucket),
        gains AS (
            SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE))) AS BIGINT) AS gain FROM counts
        ), weights AS (SELECT k, sum(gain) AS weight FROM found JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY k),
        scored AS (
            SELECT id AS doc_id, n_words, len(f) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
                   CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
            FROM runs LEFT JOIN weights USING (k) WHERE kind = 'd'
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n_words >= 20) OVER () AS n FROM scored
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 5 * n // 100 THEN place END AS rank FROM ranked
    """,
    "op12_dataset_manifest": r"""
        WITH RECURSIVE steps AS (
            SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS tab
        ), rows AS (
            SELECT *, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
                                  lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295) & 1 AS odd,
                   concat(coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                          coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head
            FROM documents, steps
        ), leaves AS (
            SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   -- the final complement flips the last bit: an even checksum is odd here
                   CASE WHEN odd = 1 THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-'))
                        ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS other
            FROM rows
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos FROM leaves
        ), up AS (
            SELECT source, 0 AS lvl, pos, leaf AS h, count(*) OVER (PARTITION BY source) AS n FROM placed
            UNION ALL
            SELECT source, lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM up WHERE n > 1 GROUP BY source, lvl, pos // 3, n
        ), subroots AS (
            SELECT source, h AS subroot, lvl AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1
        ), top AS (
            SELECT 0 AS lvl, pos, subroot AS h, n FROM subroots
            UNION ALL
            SELECT lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM top WHERE n > 1 GROUP BY lvl, pos // 3, n
        ), every AS (
            -- all nodes, a document's own levels first
            SELECT source, lvl, pos, h, n, false AS upper FROM up UNION ALL SELECT NULL, lvl, pos, h, n, true FROM top
        ), way AS (
            SELECT doc_id, p.source, leaf, other, subroot, p.pos AS low, s.pos AS high, 0 AS lvl, CAST(p.n AS BIGINT) AS n, false AS upper, '' AS proof, other AS folded
            FROM (SELECT placed.*, count(*) OVER (PARTITION BY source) AS n FROM placed) p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source
            UNION ALL
            SELECT doc_id, w.source, leaf, other, subroot, CASE WHEN upper OR n = 1 THEN low ELSE low // 3 END, CASE WHEN upper THEN high // 3 ELSE high END,
                   CASE WHEN n = 1 THEN 0 ELSE lvl + 1 END, CASE WHEN n = 1 THEN (SELECT count(*) FROM subroots) ELSE (n + 2) // 3 END, upper OR n = 1,
                   proof || coalesce(l, '') || coalesce(r, ''),
                   CASE WHEN n = 1 THEN folded ELSE sha256(coalesce(l, '') || folded || coalesce(r, '')) END
            FROM (
                SELECT w.*, (SELECT string_agg(h, '' ORDER BY pos) FROM every e WHERE w.n > 1 AND e.upper = w.upper AND (w.upper OR e.source IS NOT DISTINCT FROM w.source) AND e.lvl = w.lvl AND e.pos // 3 = w.at // 3 AND e.pos < w.at) AS l,
                       (SELECT string_agg(h, '' ORDER BY pos) FROM every e WHERE w.n > 1 AND e.upper = w.upper AND (w.upper OR e.source IS NOT DISTINCT FROM w.source) AND e.lvl = w.lvl AND e.pos // 3 = w.at // 3 AND e.pos > w.at) AS r
                FROM (SELECT *, CASE WHEN upper THEN high ELSE low END AS at FROM way WHERE NOT (upper AND n = 1)) w
            ) w
        )
        SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
        FROM way, (SELECT h AS root FROM top WHERE n = 1) WHERE upper AND n = 1
    """,
    "op13_document_fingerprints": r"""
        WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        beside AS (
            SELECT doc_id, text, coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS next FROM texts
        ), edits AS (
            SELECT doc_id, text, next, substring(text, 1, length(text) - length(text) // 3) || substring(next, 1, length(text) // 3) AS edited FROM beside
        ), every AS (SELECT text FROM texts UNION SELECT edited FROM edits),
        trees AS (
            SELECT text, list_transform(string_split(text, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)),
                lambda p: list_transform(regexp_extract_all(p, '[^.,;:!?|]{1,48}[.,;:!?|]*|[.,;:!?|]+'), lambda x: sha256(x)))) AS tree FROM every
        ), nodes AS (
            SELECT text, tree, list_transform(tree, lambda s: list_transform(s, lambda p: sha256('p:' || list_aggregate(p, 'string_agg', '')))) AS paragraphs,
                   list_distinct(list_transform(flatten(flatten(tree)), lambda h: substr(h, 1, 8))) AS marks
            FROM (SELECT text, list_transform(tree, lambda s: list_transform(s, lambda p: CASE WHEN len(p) = 0 THEN [''] ELSE p END)) AS tree FROM trees)
        ), prints AS (
            SELECT text, list_filter(marks, lambda m: m <> '') AS marks, paragraphs,
                   sha256('r:' || list_aggregate(list_transform(paragraphs, lambda s: sha256('s:' || list_aggregate(s, 'string_agg', ''))), 'string_agg', '')) || ':'
                   || list_aggregate(list_transform(tree, lambda s: list_aggregate(list_transform(s, lambda p: list_aggregate(list_transform(p, lambda h: substr(h, 1, 8)), 'string_agg', '')), 'string_agg', ';')), 'string_agg', '|') AS fingerprint
            FROM nodes
        )
        SELECT e.doc_id, length(e.text) AS n_chars, sha256(e.edited) AS edited_sha256, a.fingerprint, b.fingerprint AS edited_fingerprint,
               CASE WHEN len(a.marks) + len(b.marks) = 0 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * len(list_intersect(a.marks, b.marks)) / (len(a.marks) + len(b.marks)) END AS near_edited,
               CASE WHEN len(a.marks) + len(c.marks) = 0 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * len(list_intersect(a.marks, c.marks)) / (len(a.marks) + len(c.marks)) END AS near_next,
               CAST(len(list_filter(flatten(b.paragraphs), lambda h: NOT list_contains(flatten(a.paragraphs), h))) AS BIGINT) AS n_changed
        FROM edits e JOIN prints a ON e.text = a.text JOIN prints b ON e.edited = b.text JOIN prints c ON e.next = c.text
    """,
}
