"""One query per operator, applied with production parameters to its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import chat, fill_in_middle, language_id, licenses, line_crf, minhash, mixing, packing, quality_rules, runs
from panelspark.llm import secrets, sentence_pieces, topk
from panelspark.llm.common import id_bucket, indices, let, table, words

QUALITY_AT = 0.3  # score from which a document counts as good


def documents(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", *more)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_rules.quality_rules(documents(spark, sf_dir))
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return scored.select(*first, "quality", *[f"vote_{r.name}" for r in quality_rules.RULES])


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(documents(spark, sf_dir))

    def count(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind, *_ in secrets.FIXED_KINDS]
    digest = F.sha2(secrets.spans_text(F.col("base_spans")), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), secrets.spans_text(F.col("spans")).alias("spans"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "lang")
    found = language_id.identify(docs, id_bucket(F.col("doc_id"), 4) != 2)
    held_out = F.coalesce(id_bucket(F.col("doc_id"), 4) == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = chat.rotate(table(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("mask", lambda m: F.concat_ws(":", m["start"], m["end"])), ",")
    return parts.withColumn("mask", spans)


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), size=4, percent=80)


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(documents(spark, sf_dir))
    joined = {n: F.array_join(f"{n}_array", ",").alias(n) for n in ("base_labels", "labels")}
    places = F.array_join(F.transform("detections", lambda d: F.concat_ws(":", d["label"], d["start"], d["end"])), ",")
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", *joined.values(), "score", places.alias("detections"))


def op8_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), table(spark, sf_dir, "labels")
    fold = id_bucket(F.col("doc_id"), 5)
    model = line_crf.train(docs, labels, fold != 0)
    scored = line_crf.score_documents(docs, model)
    held_out = F.coalesce(fold == 0, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= QUALITY_AT).cast("int").alias("predicted"))


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(documents(spark, sf_dir))
    crc = F.crc32("ids").alias("ids_crc32")
    return pieces.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset")


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """``docs`` as the contract of op11 reads them: where crc32(doc_id) % 10 is 0, the words from ``a`` on repeat the next ``p``."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / F.lit(10)).cast("long")

    def repeat(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
        return let(
            F.struct(a.alias("a"), p.alias("p")),
            lambda t: F.array_join(
                F.transform(indices(n), lambda i: F.get(w, F.when(i < t["a"], i).otherwise(t["a"] + (i - t["a"]) % t["p"]).cast("int"))), " "
            ),
        )

    tail = let(words(F.col("text")), lambda w: F.when(F.size(w) > 0, repeat(w)).otherwise(F.lit("")))
    return docs.withColumn("text", F.when(h % 10 == 0, tail).otherwise(F.col("text")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(with_repeated_tails(documents(spark, sf_dir)))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = [F.col(f"strongest.{n}").alias(n) for n in ("start", "length", "period")]
    milli = F.expr("strongest.length * 1000 div strongest.period").alias("exponent_milli")
    digests = [F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")]
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), *best, milli, *digests)


def op12_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = sentence_pieces.decode(sentence_pieces.encode(documents(spark, sf_dir)))
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle.fill_in_middle(documents(spark, sf_dir))
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    digests = [F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256")]
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_secret_scan": op2_secret_scan,
    "op3_language_id": op3_language_id,
    "op4_chat_rotation": op4_chat_rotation,
    "op5_minhash_dedup": op5_minhash_dedup,
    "op6_exact_top_k": op6_exact_top_k,
    "op7_license_scan": op7_license_scan,
    "op8_line_quality": op8_line_quality,
    "op9_pack": op9_pack,
    "op10_mix_sources": op10_mix_sources,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_sentence_pieces": op12_sentence_pieces,
    "op13_fill_in_middle": op13_fill_in_middle,
}

# SQL of the operators that it can express: the whole definition, not the operator's way to the result.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

ORACLE_SQL: dict[str, str] = {
    "op4_chat_rotation": f"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '{chat.UNKNOWN}') AS speaker, coalesce(text, '') AS words FROM conversations
),
participants AS (SELECT DISTINCT conv_id, speaker AS participant FROM said),
lines AS (
    SELECT p.conv_id, participant, floor(turn / {chat.PART}.0) AS block, speaker = participant AS own, words,
           CASE WHEN speaker = participant THEN '<|assistant|>' ELSE '<|user name=' || speaker || '|>' END || chr(10) AS opening,
           row_number() OVER (PARTITION BY p.conv_id, participant ORDER BY turn NULLS LAST, speaker, words) AS k
    FROM participants p JOIN said s ON p.conv_id IS NOT DISTINCT FROM s.conv_id
),
placed AS (
    SELECT *, coalesce(sum(length(opening) + length(words) + 8) OVER (
        PARTITION BY conv_id, participant ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
    FROM lines
),
within AS (SELECT *, pos - min(pos) OVER (PARTITION BY conv_id, participant, block) + length(opening) AS s FROM placed)
SELECT conv_id, participant,
       CAST(row_number() OVER (PARTITION BY conv_id, participant ORDER BY block NULLS LAST) - 1 AS BIGINT) AS part,
       CAST(min(pos) AS BIGINT) AS start,
       string_agg(opening || words || '<|end|>' || chr(10), '' ORDER BY k) AS text,
       coalesce(string_agg(CAST(s AS BIGINT) || ':' || CAST(s + length(words) + 7 AS BIGINT), ',' ORDER BY k) FILTER (own), '') AS mask,
       count(*) AS n_messages, count(*) FILTER (own) AS n_trained
FROM within GROUP BY conv_id, participant, block
""",
    "op5_minhash_dedup": f"""
WITH RECURSIVE words AS (
    SELECT doc_id, {_WORDS.format(text=f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} AS w FROM documents
),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3])) END AS s
    FROM words
),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
members AS (SELECT doc_id, unnest(s) AS x FROM sets),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM members a JOIN members b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
    SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * k >= 80 * (x.n + y.n - k)
),
reach AS (
    SELECT doc_id, doc_id AS r FROM sizes
    UNION
    SELECT reach.doc_id, b FROM reach JOIN links ON reach.r = links.a
)
SELECT doc_id, n AS n_shingles, min(r) AS component_id, doc_id = min(r) AS kept FROM reach JOIN sizes USING (doc_id) GROUP BY doc_id, n
""",
    "op6_exact_top_k": f"""
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor({topk.SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scores QUALIFY rank <= {topk.K}
""",
    "op10_mix_sources": f"""
WITH sized AS (
    SELECT doc_id, source, CAST(len({_WORDS.format(text="coalesce(text, '')")}) AS BIGINT) AS size FROM documents
),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
    SELECT *, 3 * source_size AS most, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM sums
),
-- Sources in the order in which a rising water level reaches their caps; the level is that of the first not reached.
ordered AS (
    SELECT *, row_number() OVER caps AS k,
           (SELECT sum(source_size) FROM sums) - coalesce(sum(most) OVER (caps ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
           sum(weight) OVER (caps ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
    FROM weighed WINDOW caps AS (ORDER BY CAST(most AS DOUBLE) / weight, source NULLS LAST)
),
level AS (
    SELECT rest, weights, k FROM ordered WHERE NOT most < CAST(rest AS DOUBLE) / CAST(weights AS DOUBLE) * weight ORDER BY k LIMIT 1
),
targets AS (
    SELECT source, source_size, CASE WHEN o.k < l.k THEN CAST(most AS DOUBLE)
        ELSE least(CAST(l.rest AS DOUBLE) * weight / CAST(l.weights AS DOUBLE), CAST(most AS DOUBLE)) END AS target
    FROM ordered o, level l
),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM targets)
SELECT doc_id, size, source_size, target,
       size * (CAST(floor(rate) AS BIGINT) + CASE WHEN CAST('0x' || substr(md5('{mixing.SEED}:' || coalesce(s.source, '') || ':'
           || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / 4503599627370496.0 < rate - floor(rate) THEN 1 ELSE 0 END) AS taken
FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source
""",
    "op13_fill_in_middle": f"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
           list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(sha256('{fill_in_middle.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), i, 8) AS BIGINT)) AS h
    FROM documents
),
formed AS (
    SELECT *, CAST(len(units) AS BIGINT) AS n,
           CASE WHEN text = '' OR h[3] % 100 >= {fill_in_middle.RATE} OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
               THEN 'plain' WHEN h[4] % 100 < {fill_in_middle.SPM_RATE} THEN 'spm' ELSE 'psm' END AS form
    FROM cut
),
parts AS (
    SELECT doc_id, text, n, form,
           array_to_string(units[1:least(h[1] % (n + 1), h[2] % (n + 1))], '') AS prefix,
           array_to_string(units[least(h[1] % (n + 1), h[2] % (n + 1)) + 1:greatest(h[1] % (n + 1), h[2] % (n + 1))], '') AS middle,
           array_to_string(units[greatest(h[1] % (n + 1), h[2] % (n + 1)) + 1:n], '') AS suffix
    FROM formed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
""",
}
