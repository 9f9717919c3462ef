"""The training-data queries and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landspark.llm import decontamination, exact_dedup, html_extraction, importance, language_id, license_scan, merkle, mixing, piece_encoding, quality, sharding, simhash, token_output
from landspark.llm.common import new_path, table
from landspark.llm.ngrams import held_out


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return html_extraction.extract(table(spark, sf_dir, "pages"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of 150 % of all words takes of every document."""
    return mixing.taken(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents by a model of the labelled ones that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = quality.QualityModel.fit(docs.filter(~held_out()), table(spark, sf_dir, "labels"), "quality")
    out = model.predict(docs)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents by a model of those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = language_id.LanguageModel.fit(docs.filter(~held_out()))
    out = model.predict(docs.select("doc_id", "text"))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of all documents."""
    return license_scan.label(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes, by 4,096 virtual slots."""
    out = sharding.shard(table(spark, sf_dir, "documents"), 24, sharding.SlotMap(spark, new_path(spark, "slot-map")))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of all documents by 64-bit fingerprints of 4-word shingles, 4 bits apart at most."""
    out = simhash.near_groups(table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a passage of 0.8 or more similarity to a benchmark item."""
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in three batches by id, each against the digests of those before; the index is dropped at the end."""
    docs = table(spark, sf_dir, "documents")
    index = exact_dedup.DigestIndex(spark, new_path(spark, "digest-index"), exact_dedup.buckets_for(docs.count()))
    try:
        return exact_dedup.deduplicate(docs, index, "documents", batches=3)
    finally:
        index.drop()


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids in Arrow files, read back."""
    path = new_path(spark, "tokens")
    index = token_output.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return token_output.read_tokens(index, path)


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded to ids of pieces, with begin and end, and decoded again."""
    out = piece_encoding.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), decoded=True)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, proofs and roots of all documents by language; a third of them are tampered with and fail to verify."""
    docs = table(spark, sf_dir, "documents")
    own = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, merkle.leaf_digest([*own[:-1], lower]))
    rows = docs.select("doc_id", "lang", merkle.leaf_digest(own).alias("leaf"), tampered.alias("tampered"))
    manifest = merkle.Manifest.build(rows, "lang", "doc_id")
    proofs = manifest.prove().join(manifest.trees.select("tree", "subroot"), "tree")
    path, root = F.col("path"), F.lit(manifest.root).cast("string")
    out = proofs.select("doc_id", "leaf", "subroot", root.alias("root"), merkle.sha(merkle.siblings(path)).alias("proof_sha256"), merkle.folded(F.coalesce("tampered", "leaf"), path).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draws a tenth of the documents of 20 words or more, by weight towards the benchmark texts."""
    out = importance.Resampler().resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_mixing": op2_mixing,
    "op3_quality": op3_quality,
    "op4_language_id": op4_language_id,
    "op5_license_scan": op5_license_scan,
    "op6_sharding": op6_sharding,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_token_output": op10_token_output,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_importance": op13_importance,
}


def _op5_sql() -> str:
    known = ", ".join(f"({k}, '{label}', {c}, {words}, {need}, {musts}, {over}::VARCHAR[], {pairs})" for k, label, c, words, need, musts, over, pairs in license_scan.templates(0.8))
    classes = ", ".join(f"({c}, {size}, {step})" for c in license_scan.CLASSES for size, step in [license_scan.block_size(c)])
    phrases = ", ".join(f"({k}, '{p}', '{label}')" for k, (p, label) in enumerate(license_scan.PHRASES.items()))
    word = license_scan.WORD
    return rf'''
        WITH d AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        w AS (SELECT doc_id, t, regexp_extract_all(t, '{word}') AS ws FROM d),
        phrases(k, phrase, label) AS (VALUES {phrases}),
        spots AS (
            SELECT doc_id, label, unnest(list_filter(range(0, len(ws)), lambda i: ws[i + 1 : i + len(string_split(phrase, ' '))] = string_split(phrase, ' '))) AS place
            FROM w, phrases),
        base AS (
            SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS labels
            FROM spots GROUP BY doc_id),
        known(template, label, class, own, need, musts, over, pairs) AS (VALUES {known}),
        classes(class, size, step) AS (VALUES {classes}),
        follow AS (SELECT doc_id, ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) AS ps FROM w),
        may AS (SELECT DISTINCT doc_id, class FROM w, known WHERE list_has_all(ws, musts)),
        starts AS (
            SELECT doc_id, ws, ps, class, size, step, unnest(range(0, greatest(len(ws), 1), step)) AS block
            FROM follow JOIN may USING (doc_id) JOIN classes USING (class)),
        parts AS (
            SELECT doc_id, class, block, list_distinct(ws[block + 1 : block + size]) AS p, ps[greatest(block, 1) : block + size - 1] AS pp
            FROM starts WHERE NOT list_has_any(ps[greatest(block - step, 1) : block + size - 1], {license_scan.denials()})),
        hits AS (
            SELECT doc_id, class, block, template, label, over, len(list_intersect(p, own)) / len(own) AS containment
            FROM parts JOIN known USING (class)
            WHERE len(list_intersect(p, own)) >= need AND list_has_all(p, musts)
              AND len(list_intersect(pp, pairs)) >= {license_scan.PAIRS} * len(pairs)),
        found AS (
            SELECT doc_id, list(DISTINCT label) AS labels, max(containment) AS score
            FROM hits a WHERE NOT EXISTS (FROM hits b WHERE a.doc_id = b.doc_id AND a.class = b.class AND a.block = b.block AND list_contains(a.over, b.label)) GROUP BY doc_id)
        SELECT doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
               coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
               coalesce(array_to_string(list_sort(list_distinct(list_concat(base.labels, found.labels))), ','), '') AS labels,
               CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(score, 0) END::DOUBLE AS score
        FROM w LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id)'''


#: The table of CRC-32, by its rule, and the checksum of a list of bytes.
_CRC_TABLE = """crc_table AS (
            SELECT list(list_reduce(range(0, 8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k) ORDER BY k) AS steps FROM range(0, 256) t(k))"""
_CRC = "xor(list_reduce({}, lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


def _op12_sql(levels: int = 8, top_levels: int = 4) -> str:
    """Levels are written out: enough for 8 ** 8 documents of a language and 8 ** 4 languages."""

    def tree(name: str, group: str, n: int) -> str:
        """``{name}_k``: level k; ``{name}_kids_k``: the children of each node of level k + 1."""
        out = ""
        for k in range(n):
            out += f""",
        {name}_kids_{k} AS (
            SELECT {group}, place // 8 AS up, list(digest ORDER BY place) AS kids
            FROM (SELECT *, count(*) OVER (PARTITION BY {group}) AS n FROM {name}_{k}) WHERE n > 1 GROUP BY {group}, place // 8),
        {name}_{k + 1} AS (SELECT {group}, up AS place, sha256(array_to_string(kids, '')) AS digest FROM {name}_kids_{k})"""
        tops = " UNION ALL ".join(f"SELECT {group}, max(digest) AS digest FROM {name}_{k} GROUP BY {group} HAVING count(*) = 1" for k in range(n + 1))
        return f"{out},\n        {name}_top AS ({tops})"

    def fold(name: str, group: str, place: str, k: int, before: str, after: str) -> str:
        own = f"({place} // {8**k} % 8)"
        left, right = f"array_to_string(kids[1 : {own}], '')", f"array_to_string(kids[{own} + 2 :], '')"
        return f""",
        {after} AS (
            SELECT a.* REPLACE (CASE WHEN kids IS NULL THEN proof ELSE proof || {left} || {right} END AS proof,
                                CASE WHEN kids IS NULL THEN folded ELSE sha256({left} || folded || {right}) END AS folded)
            FROM {before} a LEFT JOIN {name}_kids_{k} b ON a.{group} IS NOT DISTINCT FROM b.{group} AND a.{place} // {8 ** (k + 1)} = b.up)"""

    def leaf(text: str) -> str:
        values = [c if c == text else f"{c}::VARCHAR" for c in ("doc_id", "source", "lang", "n_chars", text)]
        return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    digits = "list_transform(string_split(doc_id::VARCHAR, ''), lambda c: unicode(c)::BIGINT)"
    sql = f"""
        WITH {_CRC_TABLE},
        rows AS (
            SELECT doc_id, lang, {leaf("text")} AS leaf, CASE WHEN {_CRC.format(digits)} % 3 = 0 THEN {leaf(lower)} END AS tampered
            FROM documents, crc_table),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank FROM rows),
        own_0 AS (SELECT lang, rank AS place, leaf AS digest FROM ranked)"""
    sql += tree("own", "lang", levels)
    sql += """,
        langs AS (SELECT 1 AS one, lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM own_top),
        all_0 AS (SELECT one, place, digest FROM langs)"""
    sql += tree("all", "one", top_levels)
    sql += """,
        path_0 AS (
            SELECT doc_id, r.lang, leaf, rank, 1 AS one, place, digest AS subroot, '' AS proof, coalesce(tampered, leaf) AS folded
            FROM ranked r JOIN langs l ON r.lang IS NOT DISTINCT FROM l.lang)"""
    for k in range(levels + top_levels):
        sql += fold("own", "lang", "rank", k, f"path_{k}", f"path_{k + 1}") if k < levels else fold("all", "one", "place", k - levels, f"path_{k}", f"path_{k + 1}")
    return sql + f"""
        SELECT doc_id, leaf, subroot, t.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = t.digest AS verified
        FROM path_{levels + top_levels}, all_top t"""


def _op13_sql() -> str:
    return rf"""
        WITH {_CRC_TABLE},
        words AS (
            SELECT 0 AS side, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents
            UNION ALL
            SELECT 1, NULL, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
        known AS (
            SELECT word, list_transform(range(1, len(h), 2), lambda i: ('0x' || h[i : i + 1])::BIGINT) AS bytes
            FROM (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM words))),
        hashed AS (
            SELECT word, {_CRC.format('bytes')} % 10000 AS bucket FROM known, crc_table),
        counts AS (SELECT bucket, count(*) FILTER (side = 0)::DOUBLE AS s, count(*) FILTER (side = 1)::DOUBLE AS t FROM words JOIN hashed USING (word) GROUP BY bucket),
        totals AS (SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM counts),
        gains AS (SELECT bucket, floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000))))::BIGINT AS gain FROM counts, totals),
        weights AS (SELECT doc_id, count(*) AS n, sum(gain)::BIGINT AS w FROM words JOIN hashed USING (word) JOIN gains USING (bucket) WHERE side = 0 GROUP BY doc_id),
        scored AS (
            SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(w, 0) AS weight,
                   coalesce(w, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
            FROM documents LEFT JOIN weights USING (doc_id)),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS nth, count(*) OVER (PARTITION BY n_features >= 20) AS n FROM scored)
        SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND nth <= n * 10 // 100 THEN nth END AS rank FROM ranked"""


ORACLE_SQL = {
    "op5_license_scan": _op5_sql(),
    "op12_merkle_manifest": _op12_sql(),
    "op13_importance": _op13_sql(),
    "op9_exact_dedup": r"""
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, text_sha256
        FROM (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
        WINDOW g AS (PARTITION BY text_sha256)""",
}
