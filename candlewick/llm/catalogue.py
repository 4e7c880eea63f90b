"""The operators' queries over the given tables, with SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewick.llm import alignment, bpe, centroids, decontaminate, html, identity, pii, quality, secrets, simhash, substrings, tokens, vectors
from candlewick.llm.common import read_table
from candlewick.plans.catalogue.registry import Build, Query

QUERIES: dict[str, Query] = {}

#: The tokenizer file; a parameter of the operators. It is never copied.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Key of the surrogates. A real corpus takes a secret of its own.
SURROGATE_KEY = b"candlewick sample key"


def query(name: str, sql: str | None = None):
    def register(build: Build) -> Build:
        QUERIES[name] = Query(name, build, sql)
        return build

    return register


@query("op1_surrogates")
def surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.with_surrogates(docs, SURROGATE_KEY).select("doc_id", "n_entities", "text")


_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION_SQL = f"""
WITH item AS (SELECT item_id, {_PLAIN.format("text")} AS words FROM benchmark),
passage AS (
  SELECT DISTINCT item_id, array_to_string(words[i:i + least(len(words), 10) - 1], ' ') AS passage, least(len(words), 10) AS k
  FROM (SELECT *, unnest(range(1, greatest(len(words) - 10, 0) + 2)) AS i FROM item WHERE len(words) > 0)),
doc AS (SELECT doc_id, {_PLAIN.format("text")} AS words FROM documents),
place AS (
  SELECT doc_id, k, unnest(range(1, len(words) - k + 2)) AS i, words
  FROM doc, (SELECT DISTINCT k FROM passage) WHERE len(words) >= k),
found AS (
  SELECT doc_id, i, place.k AS k, item_id FROM place JOIN passage
  ON place.k = passage.k AND array_to_string(words[i:i + place.k - 1], ' ') = passage),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS place FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""


@query("op2_decontamination", DECONTAMINATION_SQL)
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_passages(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        F.col("words").alias("n_words"),
        decontaminate.hit_words().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


@query("op3_main_text")
def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html.extracted(pages)
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


@query("op4_bpe")
def byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, TOKENIZER, outputs=("n_tokens", "ids_sha256", "decoded_sha256"))
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op5_quality")
def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = quality.learn(docs, read_table(spark, sf_dir, "labels"))
    return quality.scored(docs, machine).select(
        "doc_id", quality.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query("op6_token_counts")
def piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokens.token_counts(docs, TOKENIZER).select("doc_id", "n_tokens")


REPEATS_SQL = r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 19], ' ')) AS h
  FROM (SELECT *, unnest(range(1, len(words) - 18)) AS i FROM doc WHERE len(words) >= 20)),
earliest AS (SELECT h, min(row(doc_id, i)) AS first_at FROM win GROUP BY h HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS place FROM win JOIN earliest USING (h) WHERE row(doc_id, i) > first_at),
word AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM doc),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)"""


@query("op7_repeats", REPEATS_SQL)
def repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    left = substrings.without_repeats(docs)
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op8_simhash")
def simhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(docs)
    return found.select("doc_id", F.lpad(F.lower(F.hex("simhash")), 16, "0").alias("fingerprint"), "component_id")


VECTORS_SQL = """
WITH RECURSIVE vec AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM vec a JOIN vec b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT reach.vec_id, link.b FROM reach JOIN link ON reach.other = link.a),
least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
degree AS (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN degree USING (vec_id) JOIN least USING (vec_id)"""


@query("op9_vectors", VECTORS_SQL)
def vector_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query("op10_secrets")
def secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(kind) for kind in ("assign", "access", "hex")],
        F.sha2(secrets.span_text("base"), 256).alias("base_sha256"),
        secrets.span_text("secrets").alias("spans"),
    )


_LOWERED = _LOWER.format("text")

IDENTITY_SQL = f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM (SELECT doc_id, {_LOWERED} AS text FROM documents) WINDOW same AS (PARTITION BY text)"""


@query("op13_exact_copies", IDENTITY_SQL)
def exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.exact_groups(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def _clustering_sql(clusters: int = 40, rounds: int = 5) -> str:
    """Assignment and move, written out once per round."""
    near = "SELECT vec_id, v, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT vec_id, v, c, list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM vec, c{k}) GROUP BY ALL"
    parts = [
        """vec AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)""",
        f"c0 AS (SELECT row_number() OVER (ORDER BY h) - 1 AS c, v AS m FROM (SELECT v, sha256('2:' || vec_id) AS h FROM vec ORDER BY h LIMIT {clusters}))",
    ]
    for k in range(rounds):
        parts.append(f"a{k} AS ({near.format(k=k)})")
        parts.append(f"s{k} AS (SELECT c, j, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM a{k}) GROUP BY c, j)")
        parts.append(f"m{k} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS m FROM s{k} GROUP BY c)")
        parts.append(f"c{k + 1} AS (SELECT c, coalesce(m{k}.m, c{k}.m) AS m FROM c{k} LEFT JOIN m{k} USING (c))")
    parts.append(f"last AS ({near.format(k=rounds)})")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM last JOIN c{rounds} USING (c)"""


@query("op12_clusters", _clustering_sql())
def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query("op11_alignment")
def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(read_table(spark, sf_dir, "documents").select("doc_id", "text"), TOKENIZER, PIECES)[0]
