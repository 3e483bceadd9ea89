"""The registered queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from punctata.llm import audio, bpe, decontamination, infill, mixing, quality, resampling, sharding, simhash, suffixes, token_counts, token_store, vectors


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.token_digests(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), end_id=0)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir), (5, 2, 1), epochs=3).select("doc_id", "size", "source_size", "target", "taken")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.score(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), threshold=0.3)


def op4_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio.media_digests(audio.store_media(documents(spark, sf_dir)))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removal_digests(documents(spark, sf_dir))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"), limit=4096)


def op7_similar_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.similar_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), threshold=0.9)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(documents(spark, sf_dir), width=3, bits=2)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(documents(spark, sf_dir), vocabulary("word_bpe_49k.json"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir), shards=8)


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.importance_ranks(documents(spark, sf_dir), benchmark(spark, sf_dir), width=1, buckets=10_000, percent=10, least=20, seed=2024)


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.infill_digests(documents(spark, sf_dir), infill.Plan(percent=50, spm_percent=80, seed=42))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(documents(spark, sf_dir), benchmark(spark, sf_dir), window=10)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_token_store, op2_mixing, op3_quality, op4_audio, op5_suffix_dedup, op6_token_counts, op7_similar_vectors, op8_simhash, op9_bpe, op10_sharding, op11_resampling, op12_infill, op13_decontamination, pipeline)
    return {f.__name__: f for f in found}


#: Cosines of all pairs and a recursive closure: fit for small tables only.
_SIMILAR = """
WITH RECURSIVE u AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL),
g AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS n FROM u WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(v, v) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a, g b WHERE a.vec_id <> b.vec_id AND list_dot_product(a.v, b.v) / (a.n * b.n) >= 0.9),
r AS (SELECT vec_id AS id, vec_id AS c FROM embeddings UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.id),
k AS (SELECT id, min(c) AS component_id FROM r GROUP BY id), n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, component_id, e.vec_id = component_id AS kept FROM embeddings e JOIN k ON k.id = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""


_WORDS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_HEX = "CAST('0x' || substr({h}, {i}, 8) AS UBIGINT)"

#: CRC-32 of a word's bytes by a table that is made from its polynomial.
_RESAMPLED = f"""
WITH RECURSIVE c(i, k, v) AS (SELECT i, 0, CAST(i AS BIGINT) FROM range(256) r(i) UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM c WHERE k < 8),
t AS (SELECT list(v ORDER BY i) AS t FROM c WHERE k = 8),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents), b AS (SELECT unnest({_WORDS}) AS w FROM benchmark),
dw AS (SELECT r, unnest(w) AS w FROM d), s AS (SELECT w, count(*) AS s FROM dw GROUP BY w), g AS (SELECT w, count(*) AS t FROM b GROUP BY w),
v AS (SELECT w, coalesce(s, 0) AS s, coalesce(t, 0) AS t, hex(encode(w)) AS x FROM s FULL JOIN g USING (w)),
k AS (SELECT w, s, v.t, xor(list_reduce(list_transform(range(0, len(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT)), lambda a, y: xor(a >> 8, t.t[xor(a & 255, y) + 1]), 4294967295), 4294967295) % 10000 AS bucket FROM v, t),
n AS (SELECT bucket, sum(s) AS s, sum(t) AS t FROM k GROUP BY bucket), z AS (SELECT (SELECT count(*) FROM dw) AS s, (SELECT count(*) FROM b) AS t),
e AS (SELECT bucket, CAST(floor(1000 * ln(CAST(n.t + 1 AS DOUBLE) * CAST(z.s + 10000 AS DOUBLE) / (CAST(n.s + 1 AS DOUBLE) * CAST(z.t + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM n, z),
m AS (SELECT r, CAST(floor(CAST(sum(gain) AS BIGINT) / count(*)) AS BIGINT) AS weight FROM dw JOIN k USING (w) JOIN e USING (bucket) GROUP BY r),
h AS (SELECT r, doc_id, len(w) AS n, coalesce(weight, 0) AS weight, {_HEX.format(h="sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), ''))", i=1)} AS h FROM d LEFT JOIN m USING (r)),
o AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5e0) / 4294967296e0))) AS BIGINT) AS score FROM h),
q AS (SELECT *, row_number() OVER (PARTITION BY n >= 20 ORDER BY score DESC, doc_id NULLS LAST, n) AS nth, count(*) OVER (PARTITION BY n >= 20) AS whole FROM o)
SELECT doc_id, n AS n_features, weight, score, CASE WHEN n >= 20 AND nth <= 10 * whole // 100 THEN nth END AS rank FROM q
"""

_INFILLED = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
g AS (SELECT *, len(u) AS n, {_HEX.format(h="h", i=1)} % (len(u) + 1) AS a, {_HEX.format(h="h", i=9)} % (len(u) + 1) AS b, {_HEX.format(h="h", i=17)} % 100 AS c, {_HEX.format(h="h", i=25)} % 100 AS e FROM d),
f AS (SELECT *, CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR c >= 50 THEN 'plain' WHEN e < 80 THEN 'spm' ELSE 'psm' END AS form,
  array_to_string(u[1 : least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1 : greatest(a, b)], '') AS m, array_to_string(u[greatest(a, b) + 1 : n], '') AS s FROM g)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(x) AS restored_sha256 FROM f
"""

_CONTAMINATED = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
j AS (SELECT DISTINCT item, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda k: array_to_string(w[k : k + 9], ' '))) AS win FROM i WHERE len(w) > 0),
l AS (SELECT DISTINCT n FROM j), x AS (SELECT DISTINCT win, n FROM j),
p AS (SELECT r, k, n, array_to_string(w[k : k + n - 1], ' ') AS win FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, l WHERE len(w) >= n)),
o AS (SELECT r, k, n, win FROM p JOIN x USING (win, n)),
c AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS place FROM o) GROUP BY r),
m AS (SELECT r, list(DISTINCT item ORDER BY item) AS items FROM o JOIN j USING (win, n) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0) AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN m USING (r)
"""


def oracle_sql() -> dict[str, str]:
    """The others have no SQL form: DuckDB has neither XXH64 nor the tokenizers, and no trees."""
    return {"op7_similar_vectors": _SIMILAR, "op11_resampling": _RESAMPLED, "op12_infill": _INFILLED, "op13_decontamination": _CONTAMINATED}
