"""Registered queries of the corpus operators, with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coffer.llm import bpe, decontaminate, htmltext, jaccard, lexical, periodic, quality, sharding, simhash, suffixes, urlfilter, voronoi, wavelet
from coffer.llm.shared import Scratch, let, ship

#: (verdict, host, path)
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.sort_array(F.transform("items", lambda x: x.cast("string"))), ",")
    n_hit = decontaminate.covered_words(F.col("spans"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = f"{Scratch(spark, 'shards').root}/maps"
    placed = sharding.sharded(table(spark, sf_dir, "documents"), shards=40, maps=maps)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        F.col("version").alias("map_version"),
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = urlfilter.rule_table(spark, URL_RULES)
    return urlfilter.judged(table(spark, sf_dir, "pages"), rules).drop("url")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = htmltext.extract(table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def op5_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = voronoi.integer_vectors(table(spark, sf_dir, "embeddings"))
    return voronoi.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def op6_token_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{Scratch(spark, 'tokens').root}/ids"
    wavelet.write_shards(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return wavelet.documents_of(wavelet.read_shards(spark, folder))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe.encode(table(spark, sf_dir, "documents"), ranks, pattern)
    return bpe.decode(encoded, ranks, pattern).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scores = quality.scored(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    good = F.when(F.col("score") >= quality.THRESHOLD, 1).otherwise(0)
    return scores.select("doc_id", quality.held_out().alias("held_out"), "score", good.alias("predicted"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda s, x: s + x)
    return suffixes.without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3)
    return found.withColumn("fingerprint", simhash.as_hex("fingerprint"))


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text; in one document of ten, the words from a place on repeat the first few of them."""
    h = F.crc32(F.col("doc_id").cast("string"))

    def planted(words):
        n, g = F.size(words).cast("long"), F.floor(h / 10)
        a = g % n
        p = F.lit(1).cast("long") + F.floor((n - a) / (F.lit(3) + g % 8))
        place = let(F.struct(a.alias("a"), p.alias("p")), lambda x: F.transform(
            words, lambda w, i: F.when(i < x["a"], w).otherwise(F.get(words, (x["a"] + (i - x["a"]) % x["p"]).cast("int")))
        ))
        return F.when(n > 0, F.array_join(place, " ")).otherwise("")

    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return docs.select("doc_id", F.when(h % 10 == 0, let(words, planted)).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapsed(_with_planted_runs(table(spark, sf_dir, "documents")))
    # Runs come by start and period, so the first of equal exponents stays.
    better = lambda b, r: b["length"].isNull() | (r["length"] * b["period"] > b["length"] * r["period"])
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    best = F.aggregate("runs", none, lambda b, r: F.when(better(b, r), r).otherwise(b))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_sharding": op2_sharding,
    "op3_url_filter": op3_url_filter,
    "op4_html_text": op4_html_text,
    "op5_voronoi_knn": op5_voronoi_knn,
    "op6_token_matrix": op6_token_matrix,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_quality": op9_quality,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_simhash": op11_simhash,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_lexical_search": op13_lexical_search,
}

ORACLES: dict[str, str] = {
    "op1_decontamination": r"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ), items AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
        ), spots AS (
            SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM items WHERE len(w) > 0
        ), known AS (
            SELECT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM spots
        ), sizes AS (SELECT DISTINCT n FROM known
        ), places AS (
            SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, sizes WHERE len(w) >= n
        ), met AS (
            SELECT p.doc_id, p.i, p.n, k.item_id
            FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM places) p JOIN known k ON p.n = k.n AND p.g = k.g
        ), hit AS (
            SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM met) GROUP BY doc_id
        ), named AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM met) GROUP BY doc_id
        )
        SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM words w LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
    "op5_voronoi_knn": """
        WITH v AS (
            SELECT vec_id, [floor(256 * x::DOUBLE) for x in embedding] AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) = len([x for x in embedding if isfinite(x)])
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
        )
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
        FROM scored QUALIFY rank <= 5
    """,
    "op7_jaccard_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS w FROM documents
        ), sets AS (
            SELECT doc_id, list_sort(list_distinct([md5_number_lower(array_to_string(w[i:i + 4], ' ')) for i in range(1, greatest(1, len(w) - 4) + 1)])) AS s
            FROM words WHERE len(w) > 0
        ), named AS (SELECT doc_id, s, md5(array_to_string(s, ' ')) AS k FROM sets
        ), alike AS (SELECT min(doc_id) AS doc, k, any_value(s) AS s, any_value(len(s)) AS n FROM named GROUP BY k
        ), grams AS (SELECT doc, n, unnest(s) AS g FROM alike
        ), pairs AS (
            SELECT a.doc AS x, b.doc AS y FROM grams a JOIN grams b ON a.g = b.g AND a.doc < b.doc AND 4 * a.n >= 3 * b.n AND 4 * b.n >= 3 * a.n
            GROUP BY a.doc, b.doc, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
        ), links AS (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs
        ), reached(doc, other) AS (
            SELECT doc, doc FROM alike
            UNION SELECT r.doc, l.y FROM reached r JOIN links l ON l.x = r.other
        ), components AS (SELECT doc, min(other) AS least FROM reached GROUP BY doc
        ), members AS (SELECT s.doc_id, a.n, c.least FROM named s JOIN alike a USING (k) JOIN components c USING (doc))
        SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(least, w.doc_id) AS component_id
        FROM words w LEFT JOIN members USING (doc_id)
    """,
    "op12_periodic_runs": r"""
        WITH rows AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                   list_reduce(list_concat([4294967295], [ord(c) for c in string_split(doc_id::VARCHAR, '')]), lambda s, b:
                       list_reduce(list_concat([xor(s, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, z:
                           xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))) AS c FROM documents
        ), hashed AS (SELECT r, doc_id, w, len(w) AS n, xor(c, 4294967295) AS h FROM rows
        ), shaped AS (
            SELECT *, (h // 10) % greatest(n, 1) AS a, 1 + (n - (h // 10) % greatest(n, 1)) // (3 + (h // 10) % 8) AS p FROM hashed
        ), placed AS (
            SELECT r, n, i, w[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END] AS word
            FROM (SELECT *, unnest(range(n)) AS i FROM shaped)
        ), agreed AS (
            SELECT x.r, x.i, y.i - x.i AS q FROM placed x JOIN placed y ON x.r = y.r AND x.word = y.word
            WHERE y.i > x.i AND 4 * (y.i - x.i) <= x.n
        ), stretches AS (
            SELECT r, q, min(i) AS s, count(*) + q AS l
            FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS g FROM agreed) GROUP BY r, q, g
            HAVING count(*) + q >= greatest(6, 4 * q)
        ), runs AS (SELECT r, s, l, min(q) AS q FROM stretches GROUP BY r, s, l
        ), listed AS (
            SELECT r, count(*) AS k, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS t FROM runs GROUP BY r
        ), best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY r ORDER BY l / q DESC, s, q) = 1
        ), kept AS (
            SELECT r, string_agg(word, ' ' ORDER BY i) AS t
            FROM placed ANTI JOIN (SELECT r, unnest(range(s + q, s + l)) AS i FROM runs) USING (r, i) GROUP BY r
        )
        SELECT d.doc_id, coalesce(k, 0)::BIGINT AS n_runs, s::BIGINT AS start, l::BIGINT AS length, q::BIGINT AS period,
               (1000 * l // q)::BIGINT AS exponent_milli, sha256(coalesce(listed.t, '')) AS runs_sha256,
               sha256(coalesce(kept.t, '')) AS collapsed_sha256
        FROM hashed d LEFT JOIN listed USING (r) LEFT JOIN best USING (r) LEFT JOIN kept USING (r)
    """,
    "op13_lexical_search": r"""
        WITH rows AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
        ), docs AS (SELECT r, doc_id, w, len(w)::BIGINT AS n FROM rows WHERE len(w) > 0
        ), sizes AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM docs
        ), counts AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM docs) GROUP BY r, term
        ), asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
        ), weights AS (
            SELECT term, floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight
            FROM counts, sizes GROUP BY term, docs
        ), scored AS (
            SELECT a.item_id, d.doc_id, d.r,
                   sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
            FROM asked a JOIN weights USING (term) JOIN counts USING (term) JOIN docs d USING (r), sizes
            GROUP BY a.item_id, d.doc_id, d.r
        )
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
        FROM scored WHERE score > 0 QUALIFY rank <= 10
    """,
}
