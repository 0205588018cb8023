"""The registered queries of this subpackage, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mostrador.llm import bpe, centroids, fingerprint, jaccard, langid, lmscore, packing, quality, resampling, simhash, substring, toxicity, urlfilter
from mostrador.llm.common import SPACE_CLASS, documents, id_remainder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.train(docs.where(id_remainder("doc_id", 5) != 0))
    judged = langid.predict(docs, model, keep=["doc_id"])
    return judged.select("doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.train(docs.where(id_remainder("doc_id", 3) != 1), labels(spark, sf_dir))
    judged = toxicity.score(docs, model, keep=["doc_id"])
    return judged.select("doc_id", (id_remainder("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


@query
def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring.deduplicate(documents(spark, sf_dir).select("doc_id", "text"))
    words = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), SPACE_CLASS + "+", " "))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(words, 256).alias("kept_sha256"))


ORACLES["op10_substring"] = r"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, place, md5(array_to_string(w[place:place + 49], ' ')) AS h
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS place FROM docs WHERE len(w) >= 50)
), firsts AS (
    SELECT h, min(doc_id) AS first_id FROM windows GROUP BY h
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(place, place + 50)) AS word FROM windows JOIN firsts USING (h) WHERE first_id < doc_id
), lists AS (
    SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
), words AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM docs
), kept AS (
    SELECT words.doc_id, string_agg(words.word, ' ' ORDER BY words.place) AS kept
    FROM words ANTI JOIN gone ON words.doc_id = gone.doc_id AND words.place = gone.word GROUP BY words.doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN lists USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    judged = urlfilter.judge(pages, urlfilter.SITES + urlfilter.PATTERNS)
    return judged.select("page_id", "host", "path", "rule", "verdict", "pattern")


_SITE_CASES = "\n".join(
    f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}') THEN '{h}{p}'"
    for h, p in (("www.example.com", "/en/"), ("example.com", "/en/"), ("net", "/es/"), ("net", "/fr/"), ("com", "/"))
)
_PATTERN_CASES = "\n".join(
    f"WHEN regexp_matches(lower(host || path), '(^|[^a-z0-9]){rule.name.replace('-', '[^a-z0-9]')}([^a-z0-9]|$)') THEN '{rule.name}'"
    for rule in sorted(urlfilter.PATTERNS, key=lambda r: (-len(r.name), r.name))
)
ORACLES["op7_url_filter"] = f"""
WITH parts AS (
    SELECT page_id, lower(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's')) AS host,
           regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
    FROM pages
), ruled AS (
    SELECT *, CASE {_SITE_CASES} END AS rule FROM parts
), judged AS (
    SELECT *, CASE WHEN rule IS NULL THEN CASE {_PATTERN_CASES} END END AS pattern FROM ruled
)
SELECT page_id, host, path, rule, pattern,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL OR pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(documents(spark, sf_dir), labels(spark, sf_dir).select("doc_id", "quality"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rules"
    )


@query
def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprint.compare_edits(documents(spark, sf_dir))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint.shown(F.col("fingerprint")).alias("fingerprint"),
        fingerprint.shown(F.col("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next",
    )


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode(documents(spark, sf_dir), path, public_tokenizers.PATTERN, keep=["doc_id"])
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return bpe.decode(coded, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query
def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return lmscore.train_and_score(docs, keep=["doc_id"])


@query
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = centroids.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _centroid_sql() -> str:
    parts = [
        """kept AS MATERIALIZED (
    SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
)""",
        f"""c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
    FROM (SELECT sha256('{centroids.SEED}:' || vec_id) AS h, v FROM kept ORDER BY h, v LIMIT {centroids.CLUSTERS})
)""",
    ]
    for r in range(centroids.ROUNDS + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
    SELECT n, min(near) AS near FROM (
        SELECT k.n, {{'d': list_sum(list_transform(list_zip(k.v, m.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT, 'c': m.c}} AS near
        FROM kept k CROSS JOIN c{r} m
    ) GROUP BY n
)""")
        if r < centroids.ROUNDS:
            parts.append(f"""c{r + 1} AS MATERIALIZED (
    SELECT o.c, coalesce(x.v, o.v) AS v FROM c{r} o LEFT JOIN (
        SELECT c, list(mean ORDER BY i) AS v FROM (
            SELECT c, i, (s - ((s % size) + size) % size) // size AS mean FROM (
                SELECT a.near.c AS c, i, sum(v[i])::BIGINT AS s, count(*) AS size
                FROM a{r} a JOIN kept USING (n), range(1, 65) t(i) GROUP BY a.near.c, i
            )
        ) GROUP BY c
    ) x USING (c)
)""")
    last = centroids.ROUNDS
    return "WITH " + ", ".join(parts) + f"""
SELECT vec_id, near.c::INTEGER AS cluster, near.d AS distance, (sum(near.d) OVER (PARTITION BY near.c))::BIGINT AS cluster_inertia,
       (sum(near.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM a{last} JOIN kept USING (n) JOIN c{last} m ON m.c = near.c
"""


ORACLES["op13_centroids"] = _centroid_sql()


@query
def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return resampling.resample(documents(spark, sf_dir).select("doc_id", "text"), target)


def _crc_sql(text: str) -> str:
    """The CRC-32 of a text, byte by byte."""
    table = [zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)]  # differences from the zero byte's: linear in the byte
    digits = f"hex(encode({text}))"
    octets = f"list_transform(range(0, length({digits}) // 2), lambda i: ('0x' || substr({digits}, 2 * i::INTEGER + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, b: xor(c >> 8, ({table}::BIGINT[])[xor(c & 255, b) + 1])), 4294967295)"


_FEATURES = r"""
    SELECT {id} AS id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f
    FROM (SELECT {id}, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {table})
"""
ORACLES["op12_resampling"] = f"""
WITH own AS MATERIALIZED ({_FEATURES.format(id="doc_id", table="documents")}),
aimed AS MATERIALIZED ({_FEATURES.format(id="item_id", table="benchmark")}),
buckets AS MATERIALIZED (
    SELECT f, {_crc_sql("f")} % {resampling.BUCKETS} AS bucket FROM (SELECT f FROM own UNION SELECT f FROM aimed)
), s AS (SELECT bucket, count(*) AS s FROM own JOIN buckets USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM aimed JOIN buckets USING (f) GROUP BY bucket),
totals AS (SELECT (SELECT count(*) FROM own) AS all_s, (SELECT count(*) FROM aimed) AS all_t),
gains AS MATERIALIZED (
    SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (all_s + {resampling.BUCKETS})::DOUBLE
           / ((s + 1)::DOUBLE * (all_t + {resampling.BUCKETS})::DOUBLE)))::BIGINT AS gain
    FROM s LEFT JOIN t USING (bucket), totals
), weights AS (
    SELECT id, count(*) AS n, ((sum(gain) - ((sum(gain) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS weight
    FROM own JOIN buckets USING (f) JOIN gains USING (bucket) GROUP BY id
), scored AS (
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
           (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('{resampling.SEED}:' || doc_id), 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
    FROM documents LEFT JOIN weights ON doc_id = id
), ranks AS (
    -- n features come from (n + 1) / 2 words
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
    FROM scored WHERE (n_features + 1) // 2 >= {resampling.LEAST_WORDS}
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {resampling.PERCENT} * n // 100 THEN place END AS rank
FROM scored LEFT JOIN ranks USING (doc_id)
"""


@query
def op11_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "n_shingles", "component_id")


ORACLES["op11_jaccard"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS MATERIALIZED (
    SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
                                                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s
    FROM words
), classes AS MATERIALIZED (
    SELECT min(doc_id) AS class_id, md5(array_to_string(s, '  ')) AS h, any_value(s) AS s, any_value(len(s)) AS n FROM sets WHERE len(s) > 0 GROUP BY md5(array_to_string(s, '  '))
), grams AS MATERIALIZED (SELECT class_id, n, unnest(s) AS g FROM classes
), alike AS MATERIALIZED (
    SELECT a.class_id AS x, b.class_id AS y FROM grams a JOIN grams b ON a.g = b.g AND a.class_id < b.class_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
    GROUP BY a.class_id, b.class_id HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))
), edges AS (SELECT x, y FROM alike UNION ALL SELECT y, x FROM alike
), reach AS (
    SELECT class_id AS x, class_id AS y FROM classes UNION SELECT r.x, e.y FROM reach r JOIN edges e ON e.x = r.y
), named AS (SELECT h, least_id FROM classes JOIN (SELECT x, min(y) AS least_id FROM reach GROUP BY x) ON x = class_id)
SELECT doc_id, len(s)::BIGINT AS n_shingles, CASE WHEN len(s) = 0 THEN doc_id ELSE least_id END AS component_id
FROM sets LEFT JOIN named ON h = md5(array_to_string(s, '  '))
"""
