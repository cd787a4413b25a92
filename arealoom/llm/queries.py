"""The registered queries of the subpackage: ``(spark, folder of tables) -> DataFrame``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arealoom.llm import bpe, decontaminate, langid, oddsketch, ordinal, pieces, pivots, rendezvous, runs, substrings, suffixes, toxicity, whitening

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_digest(column) -> Column:
    return F.sha2(column, 256)


@query(
    r"""
    WITH words AS (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
    ), places AS (
      SELECT doc_id, i, list_extract(w, i) AS word, array_to_string(list_slice(w, i, i + 19), ' ') AS phrase, i + 19 <= len(w) AS whole
      FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words)
    ), later AS (
      SELECT doc_id, i FROM places WHERE whole QUALIFY row_number() OVER (PARTITION BY phrase ORDER BY doc_id, i) > 1
    ), removed AS (
      SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later
    ), kept AS (
      SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM places ANTI JOIN removed USING (doc_id, i) GROUP BY doc_id
    )
    SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
    FROM words LEFT JOIN kept USING (doc_id)
    """
)
def op3_difference_cover_substrings(spark: SparkSession, folder: str) -> DataFrame:
    """Words in 20-word windows that also start earlier go."""
    removed = substrings.remove(table(spark, folder, "documents"))
    return removed.select("doc_id", "n_words", "n_removed", text_digest("kept_text").alias("kept_sha256"))


@query(
    r"""
    WITH texts AS (
      SELECT 0 AS side, doc_id AS id, coalesce(text, '') AS text FROM documents
      UNION ALL SELECT 1, item_id, coalesce(text, '') FROM benchmark
    ), words AS (
      SELECT side, id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
    ), item_windows AS (
      SELECT DISTINCT id AS item_id, size, array_to_string(list_slice(w, spot, spot + size - 1), ' ') AS phrase FROM (
        SELECT id, w, least(13, len(w)) AS size, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS spot
        FROM words WHERE side = 1 AND len(w) > 0)
    ), places AS (
      SELECT id AS doc_id, spot, size, array_to_string(list_slice(w, spot, spot + size - 1), ' ') AS phrase FROM (
        SELECT id, w, size, unnest(range(1, len(w) - size + 2)) AS spot
        FROM words, (SELECT DISTINCT size FROM item_windows) WHERE side = 0)
    ), hits AS (
      SELECT DISTINCT doc_id, spot, size, item_id FROM places JOIN item_windows USING (size, phrase)
    ), covered AS (
      SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(spot, spot + size)) FROM hits) GROUP BY doc_id
    ), named AS (
      SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
    )
    SELECT id AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
      sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM words LEFT JOIN covered ON covered.doc_id = id LEFT JOIN named ON named.doc_id = id WHERE side = 0
    """
)
def op4_prefix_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of the documents in 13-word windows of the benchmark."""
    marked = decontaminate.mark(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        text_digest(F.concat_ws(",", "items")).alias("items_sha256"),
        decontaminate.contaminated(5).alias("contaminated"),
    )


@query(
    """
    WITH crc AS (
      SELECT list(c ORDER BY i) AS steps FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) AS r(i))
    ), texts AS (
      SELECT doc_id, hex(coalesce(text, '')) AS h, strlen(coalesce(text, '')) AS n FROM documents
    ), sums AS (
      SELECT doc_id, n + 1 AS size, xor(list_reduce(list_prepend(4294967295, list_transform(range(n),
        lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)), lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
      FROM texts, crc
    ), scored AS (
      SELECT doc_id, shard, ('0x' || substr(md5(doc_id || '/' || shard), 1, 13))::BIGINT AS score FROM documents, range(9) AS r(shard)
    ), placed AS (
      SELECT doc_id, arg_max(shard, score) FILTER (shard < 8) AS shard, arg_max(shard, score) AS grown FROM scored GROUP BY doc_id
    )
    SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
      row_number() OVER (PARTITION BY shard ORDER BY substr(md5(doc_id::VARCHAR), 1, 3), doc_id) - 1 AS slot, grown::INTEGER AS grown_shard
    FROM sums JOIN placed USING (doc_id)
    """
)
def op6_rendezvous_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Law ``key``: eight shards of equal weight, and where a ninth would take the row."""
    eight, nine = ({shard: 1.0 for shard in range(n)} for n in (8, 9))
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    numbered = rendezvous.number(rendezvous.assign(rows, "doc_id", eight), "doc_id")
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", rendezvous.shard_of(F.col("doc_id"), nine).alias("grown_shard")
    )


@query()
def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids by the public 50k ranks and back to bytes."""
    vocab = bpe.load_vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = bpe.round_trip(table(spark, folder, "documents").select("doc_id", "text"), vocab, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        text_digest("ids").alias("ids_sha256"),
        text_digest("decoded").alias("decoded_sha256"),
    )


@query(
    r"""
    WITH texts AS (
      SELECT doc_id, hex(coalesce(text, '')) AS h, strlen(coalesce(text, '')) AS n FROM documents
    ), places AS MATERIALIZED (
      SELECT doc_id, i, substr(h, 2 * i + 1, 2) AS pair, CASE WHEN i + 100 <= n THEN md5_number(substr(h, 2 * i + 1, 200)) END AS phrase
      FROM (SELECT doc_id, h, n, unnest(range(0, n)) AS i FROM texts)
    ), later AS (
      SELECT doc_id, i FROM places JOIN (SELECT phrase, min(doc_id * 1000000000 + i) AS first_at FROM places WHERE phrase IS NOT NULL
        GROUP BY phrase HAVING count(*) > 1) USING (phrase) WHERE doc_id * 1000000000 + i > first_at
    ), removed AS (
      SELECT DISTINCT doc_id, unnest(range(i, i + 100)) AS i FROM later
    ), spans AS (
      SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE previous IS NULL OR previous < i - 1) AS n_spans
      FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS previous FROM removed) GROUP BY doc_id
    ), kept AS (
      SELECT doc_id, string_agg(pair, '' ORDER BY i) AS h FROM places ANTI JOIN removed USING (doc_id, i) GROUP BY doc_id
    )
    SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
      sha256(unhex(coalesce(kept.h, ''))) AS kept_sha256
    FROM texts LEFT JOIN spans USING (doc_id) LEFT JOIN kept USING (doc_id)
    """
)
def op9_suffix_array_substrings(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes in 100-byte strings that also start earlier go."""
    removed = suffixes.remove(table(spark, folder, "documents"))
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", text_digest("kept").alias("kept_sha256"))


@query(
    r"""
    WITH RECURSIVE words AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents
    ), shingles AS (
      SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS shingle
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, least(len(w), 1) + 1))) AS i FROM words)
    ), sizes AS (
      SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
    ), common AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b USING (shingle)
      WHERE a.doc_id < b.doc_id GROUP BY ALL
    ), links AS (
      SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common.n >= 80 * (x.n + y.n - common.n)
    ), both_ways AS (
      SELECT a, b FROM links UNION ALL SELECT b, a FROM links
    ), reach AS (
      SELECT doc_id, doc_id AS other FROM documents
      UNION SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON reach.other = both_ways.a
    )
    SELECT doc_id, coalesce(any_value(sizes.n), 0)::BIGINT AS n_shingles, min(other) AS component_id, min(other) = doc_id AS kept
    FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
    """
)
def op10_odd_sketch_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents that share 80 % of their 4-word shingles."""
    return oddsketch.near_duplicates(table(spark, folder, "documents"))


@query()
def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Languages learnt outside the held-out fifth, predicted everywhere."""
    docs = table(spark, folder, "documents")
    model = langid.fit(docs.select("doc_id", "text", "lang").filter(~langid.held_out(F.col("doc_id"))))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")


@query(
    """
    WITH vectors AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
      SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
      FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
    )
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
    FROM scored QUALIFY rank <= 10
    """
)
def op2_pivot_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """Ten best rows for every hundredth vector."""
    return pivots.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query()
def op1_toxicity_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Junk, then toxicity given junk, for every document; learnt from the labelled ones."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", (1 - F.col("quality")).alias("junk"), "toxic")
    chain = toxicity.fit(labels, docs, ["junk", "toxic"])
    found = toxicity.predict(docs, chain)
    return found.select("doc_id", "p_junk", "is_junk", "p_toxic", "is_toxic")


def quality_grade() -> Column:
    """Null where quality, or with quality the toxic flag, is null."""
    good, toxic = F.col("quality") == 1, F.col("toxic")
    return F.when(F.col("quality") == 0, 0).when(good & (toxic == 1), 1).when(good & (toxic == 0), 2)


@query()
def op8_ordinal_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Grades: 0 of no quality, 1 toxic, 2 neither; texts of grade 2 are selected. Labels that do not
    tell the grade are not learnt from."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rated = table(spark, folder, "labels").select("doc_id", quality_grade().alias("grade"))
    model = ordinal.fit(rated, docs, levels=3, wanted=2)
    return ordinal.predict(docs, model).select("doc_id", "expected_grade", "p_wanted", "selected")


@query()
def op11_polynomial_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every usable vector on the eight leading components; one row for each component."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(vectors, components=8)
    found = whitening.whiten(vectors, model)
    share = F.array(*[F.lit(x) for x in (model.shares if model else [])]).cast("array<double>")
    rows = found.select("vec_id", "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"), F.posexplode("whitened").alias("place", "whitened"))
    return rows.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        "n",
        "deviation",
        "whitened",
        F.get(share, F.col("place")).alias("explained"),
        F.lit(model.error if model else None).cast("double").alias("identity_error"),
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The rule of the table of operator 12: in every tenth document by ``h = crc32(doc_id)`` the words
    from place a on repeat the p words that stand there."""
    planted = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    planted = planted.select("doc_id", "text", words.alias("words"), F.expr("h div 10 AS g")).withColumn("n", F.size("words").cast("long"))
    planted = planted.withColumn("a", F.expr("if(n > 0, g % n, null)")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    place = F.expr("transform(sequence(0L, n - 1), i -> element_at(words, cast(if(i >= a, a + (i - a) % p, i) AS int) + 1))")
    return planted.select("doc_id", F.when(F.col("n") > 0, F.array_join(place, " ")).otherwise(F.col("text")).alias("text"))


@query()
def op12_grammar_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words of every document, and its text without their repeats."""
    found = runs.periodic_runs(with_planted_runs(table(spark, folder, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"strongest.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        text_digest(F.array_join(lines, "")).alias("runs_sha256"),
        text_digest("collapsed").alias("collapsed_sha256"),
    )


@query()
def op13_prefix_table_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every whole text by the public piece model, and the text they decode to."""
    model = pieces.load_model(public_tokenizers.path("piece_bpe_32k.model"))
    coded = pieces.round_trip(table(spark, folder, "documents").select("doc_id", "text"), model)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        text_digest(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        text_digest("decoded").alias("decoded_sha256"),
    )
