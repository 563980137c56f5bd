"""The registered queries of this package: name -> (callable, DuckDB SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm import (
    bpe,
    chat_format,
    embedding_dedup,
    exact_dedup,
    langid,
    line_dedup,
    minhash,
    mixing,
    toxicity,
    url_filter,
    vector_codes,
    warc,
    whitening,
)
from ledgerline.session import settled, ship_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sha256(text) -> F.Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


PLANTED = "\\### Assistant: </turn> ok"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = F.lit(PLANTED)
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        text.alias("text"),
    )
    done = chat_format.format_conversations(rows.unionByName(planted))
    read = done.select(
        "conv_id",
        "formatted",
        chat_format.turns_of(F.col("formatted")).alias("turns"),
        chat_format.learned_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    written = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        _sha256(written).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        _sha256(F.col("loss")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP1_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), marked AS (
  SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after,
    length(replace(replace(replace(text, '\', '\\'), '#', '\#'), '</turn>', '<\/turn>')) AS safe,
    length(replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '</turn>', '<\/turn>'), ':', '\c')) AS head,
    row_number() OVER w AS k
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(safe + 7
    + CASE WHEN before IS DISTINCT FROM role THEN head + 6 ELSE 0 END
    + CASE WHEN after IS DISTINCT FROM role THEN 1 ELSE 0 END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


OP2_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 75 * (x.n + y.n - k)
), reach(node, seen) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.seen FROM reach r JOIN links l ON l.a = r.node
), least AS (SELECT node, min(seen) AS c FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c AS component_id, c = d.doc_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN least ON least.node = d.doc_id
"""


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    model = langid.fit(docs.where(~held_out))
    told = langid.identified(docs.select("doc_id", "text"), model)
    return told.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected"
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    told = toxicity.scored(docs, model)
    return told.select("doc_id", "severity", "grade", "toxic", (~F.col("toxic")).alias("kept"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_copies(_table(spark, sf_dir, "documents").select("doc_id", "text"))


OP5_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    plan = mixing.plan_mix(docs)
    return plan.select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.size("shards") * F.col("size")).cast("long").alias("taken"),
        "shards",
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    index = warc.write_archives(pages)
    # what the bytes read back say, not what their headers say
    content = F.when(F.col("record_type") == "response", F.col("payload"))
    read = settled(
        warc.read_records(index).select(
            "page_id",
            "record_type",
            "refers_to",
            F.octet_length(content).cast("long").alias("bytes"),
            F.when(F.col("record_type") == "response", F.col("digest")).alias("payload_digest"),
        )
    )
    # a revisit's payload is that of the response it names; only those few responses are looked up
    again = read.where("record_type = 'revisit'").drop("bytes", "payload_digest")
    named = settled(
        read.where("record_type = 'response'")
        .join(again.select(F.col("refers_to").alias("page_id")).distinct(), "page_id", "left_semi")
        .groupBy(F.col("page_id").alias("refers_to"))
        .agg(F.max("bytes").alias("bytes"), F.max("payload_digest").alias("payload_digest"))
    )
    columns = ["page_id", F.col("bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"]
    revisits = again.join(named.hint("merge"), "refers_to", "left").select(columns)
    return read.where("record_type = 'response'").select(columns).unionByName(revisits)


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return embedding_dedup.near_vectors(vectors)


OP8_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach(node, seen) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.seen FROM reach r JOIN links l ON l.a = r.node
), least AS (SELECT node, min(seen) AS c FROM reach GROUP BY node
), n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, c AS component_id, c = vec_id AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id JOIN least ON node = vec_id
"""


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_groups(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.encoded_and_decoded(docs, ranks, public_tokenizers.PATTERN)
    ids = F.array_join(F.col("token_ids").cast("array<string>"), ",")
    return both.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        _sha256(ids).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = url_filter.rules("block net/", "allow example.net/en/", "block example.com/de/", "allow org/fr/")
    return url_filter.judged(_table(spark, sf_dir, "pages").select("page_id", "url", "html"), listed)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    codes, books = vector_codes.coded(vectors)
    digits = F.transform("code", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0"))
    return vector_codes.label_errors(codes).select(
        "vec_id",
        F.array_join(digits, "").alias("code"),
        "error",
        "label_error",
        F.lit(vector_codes.codebooks_sha256(books)).alias("codebooks_sha256"),
    )


def _op12_sql() -> str:
    """Lloyd's rounds unrolled."""
    nearest = """a{k} AS MATERIALIZED (
  SELECT vec_id, label, part, p, min(struct_pack(d := d, e := entry)) AS near FROM (
    SELECT vec_id, label, v.part, p, entry,
      list_sum(list_transform(range(1, len(p) + 1), lambda i: (p[i] - b[i]) * (p[i] - b[i])))::BIGINT AS d
    FROM v JOIN c{k} USING (part)
  ) GROUP BY ALL
)"""
    moved = """c{n} AS MATERIALIZED (
  SELECT part, entry, coalesce(m.b, c.b) AS b FROM c{k} c LEFT JOIN (
    SELECT part, entry, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS b FROM (
      SELECT part, near.e AS entry, i, sum(p[i])::HUGEINT AS s, count(*) AS n FROM a{k}, range(1, 9) AS t(i)
      GROUP BY ALL
    ) GROUP BY ALL
  ) m USING (part, entry)
)"""
    steps = []
    for k in range(vector_codes.ROUNDS + 1):
        steps.append(nearest.format(k=k))
        if k < vector_codes.ROUNDS:
            steps.append(moved.format(k=k, n=k + 1))
    last = vector_codes.ROUNDS
    return """
WITH x AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda y: floor(4096 * y::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR isnan(y) OR isinf(y))) = 0
), v AS MATERIALIZED (
  SELECT vec_id, label, part, x[8 * part + 1 : 8 * part + 8] AS p FROM x, range(0, 8) AS t(part)
), c0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, p AS b FROM v
  QUALIFY entry < 16
), %s, ended AS (
  SELECT vec_id, label, string_agg(printf('%%02x', near.e), '' ORDER BY part) AS code, sum(near.d)::BIGINT AS error
  FROM a%d GROUP BY vec_id, label
), books AS (
  SELECT sha256(string_agg(array_to_string(b, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c%d
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM ended, books
""" % (", ".join(steps), last, last)


OP12_SQL = _op12_sql()


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    done = whitening.whitened(vectors)
    both = F.arrays_zip("whitened", "explained")
    return done.select("vec_id", "n", "deviation", "identity_error", F.posexplode(both).alias("at", "c")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        "deviation",
        F.col("c.whitened").alias("whitened"),
        F.col("c.explained").alias("explained"),
        "identity_error",
    )


QUERIES = {
    "op1_chat_format": (op1_chat_format, OP1_SQL),
    "op2_minhash_dedup": (op2_minhash_dedup, OP2_SQL),
    "op3_language_id": (op3_language_id, None),
    "op4_toxicity": (op4_toxicity, None),
    "op5_exact_dedup": (op5_exact_dedup, OP5_SQL),
    "op6_mix_sources": (op6_mix_sources, None),
    "op7_warc": (op7_warc, None),
    "op8_embedding_dedup": (op8_embedding_dedup, OP8_SQL),
    "op9_line_dedup": (op9_line_dedup, None),
    "op10_byte_bpe": (op10_byte_bpe, None),
    "op11_url_filter": (op11_url_filter, None),
    "op12_vector_codes": (op12_vector_codes, OP12_SQL),
    "op13_whitening": (op13_whitening, None),
}
