"""One query per operator over the whole tables, with the results that the contracts name, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.llm import alignment, collocations, decontamination, mixing, quality_cnn, sanitise, setsketch, sharding, simhash, target_ratio, tokens, url_filter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    index = url_filter.write_index(url_filter.unwanted(pages), "entry")
    return url_filter.filter_urls(pages, index).drop("listed")


def op2_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    net = quality_cnn.train(documents, table(spark, sf_dir, "labels"))
    scored = quality_cnn.score(documents.select("doc_id", "text"), net, ["doc_id"], 0.3)
    return scored.select("doc_id", quality_cnn.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed, _ = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.shard(table(spark, sf_dir, "documents"))
    return shards.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.decontaminate(documents, table(spark, sf_dir, "benchmark"), columns=["doc_id"])
    joined = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(joined, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), vocabulary())


def op7_target_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    scored = target_ratio.score(documents, target_ratio.fit(documents, trusted))
    return target_ratio.judge(scored, target_ratio.threshold(scored, trusted))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary()
    folder, manifest = tokens.write_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), path, end_id=2)
    return tokens.read_tokens(spark, folder, manifest, tokens.id_type(path, 2))


def op10_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sanitise.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["rank"] < len(sanitise.BASE))
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    number = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[number(k) for k in sanitise.BASE], F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.phrases(table(spark, sf_dir, "documents").select("lang", "text"))


def op12_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.align_documents(documents, vocabulary(), vocabulary("piece_bpe_32k.model")).withColumn("doc_id", F.col("doc_id").cast("long"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_url_filter, op2_quality_cnn, op3_mix, op4_kd_shards, op5_decontaminate, op6_token_counts, op7_target_ratio, op8_simhash, op9_token_files, op10_sanitise, op11_collocations, op12_setsketch, op13_align_tokens, pipeline)}

ORACLE_SQL = {
    "op1_url_filter": r"""
        WITH parts AS (SELECT page_id,
                translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
            sites(h) AS (SELECT s || '.example.' || d FROM (VALUES ('adult-x'), ('ads-track'), ('casino-win'), ('cheap-pills'), ('free-bets'), ('spam-farm')) AS a(s), (VALUES ('com'), ('net'), ('org')) AS b(d)),
            listed AS (SELECT DISTINCT host AS bad FROM parts JOIN sites ON host = h OR ends_with(host, '.' || h)),
            rules(kind, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
            fits AS (SELECT page_id, host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(kind, length(h || p)) AS kind
                FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY ALL)
        SELECT page_id, host, path, rule, coalesce(kind, CASE WHEN bad IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict FROM fits LEFT JOIN listed ON host = bad""",
    "op5_decontaminate": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
            b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
            wins AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + 9], ' ') AS win FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
            lens AS (SELECT DISTINCT n FROM wins),
            places AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS win FROM d, lens, unnest(range(1, len(w) - n + 2)) AS t(i)),
            hits AS (SELECT doc_id, item_id, i, p.n FROM places p JOIN wins USING (win)),
            covered AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(0, n)) AS t(k) GROUP BY doc_id),
            items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_collocations": r"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang,
                unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
            f AS (SELECT lang, m, array_to_string(g, ' ') AS phrase, any_value(g) AS g, count(*) AS c FROM (SELECT lang, m, w[i : i + m - 1] AS g FROM p, (VALUES (1), (2), (3)) AS s(m), unnest(range(1, len(w) - m + 2)) AS t(i)) GROUP BY ALL),
            totals AS (SELECT lang, sum(c) AS n FROM f WHERE m = 1 GROUP BY lang),
            found AS (SELECT * FROM f WHERE m > 1 AND c >= 10),
            cuts AS (SELECT x.lang, x.phrase, x.m, x.g, x.c AS a, k, array_to_string(x.g[1 : k], ' ') AS lp, array_to_string(x.g[k + 1 :], ' ') AS rp FROM found x, (VALUES (1), (2)) AS s(k) WHERE k < x.m),
            scored AS (SELECT cuts.*, l.c AS l, r.c AS r, CAST(1000000::HUGEINT * a * a // (l.c::HUGEINT * r.c) AS BIGINT) AS score FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = lp JOIN f r ON r.lang = cuts.lang AND r.phrase = rp),
            lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
            longer AS (SELECT lang, array_to_string(g[i : i + 1], ' ') AS phrase, max(c) AS most FROM found, unnest([1, 2]) AS t(i) WHERE m = 3 GROUP BY ALL)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
        FROM lowest LEFT JOIN longer USING (lang, phrase) JOIN totals USING (lang) WHERE m = 3 OR most IS NULL OR 100 * most < 50 * a QUALIFY rank <= 2000""",
    "op12_setsketch": r"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
            sets AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0),
            sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
            pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets a JOIN sets b USING (s) GROUP BY ALL),
            links AS (SELECT x, y FROM pairs JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id WHERE 100 * c >= 85 * (p.n + q.n - c)),
            reached AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x),
            lowest AS (SELECT x AS doc_id, min(y) AS low FROM reached GROUP BY x)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(low, doc_id) AS component_id, doc_id = coalesce(low, doc_id) AS kept FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest USING (doc_id)""",
}
