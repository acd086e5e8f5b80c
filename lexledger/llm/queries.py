"""The registered query of each operator: its whole intended table, with production parameters."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexledger.llm import codes, embeddings, fingerprints, htmltext, language, lexical, minhash, mixing, packing, quality, sharding, suffixes, toxicity
from lexledger.llm.common import shared_dir, table


def op1_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated byte strings removed from all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.repeated_bytes(docs).drop("spans")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents by co-trained views."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs.select("doc_id", "text", "source", "lang", "n_chars"), model).select("doc_id", "score", "text_score", "metadata_score", "keep")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in length buckets and token-budget batches."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents by category."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"))).drop("text")


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings by cosine."""
    return embeddings.similar(table(spark, sf_dir, "embeddings"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(~F.coalesce(language.held_out(), F.lit(False))))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(language.held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of every page."""
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints.edit_report(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One epoch's characters, redistributed over the sources."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best documents of all for every benchmark item."""
    return lexical.search(lexical.index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all embeddings."""
    return codes.compress(table(spark, sf_dir, "embeddings"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards of nearly equal bytes; the slot map is stored as its first version."""
    out, slot_map = sharding.assign(table(spark, sf_dir, "documents"))
    sharding.save_map(spark, f"{shared_dir(spark)}/slot-map-{uuid.uuid4().hex}", slot_map)
    return out


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffixes, op2_quality, op3_packing, op4_toxicity, op5_minhash, op6_embeddings, op7_language_id, op8_html, op9_fingerprints, op10_mixing, op11_lexical_search, op12_vector_codes, op13_sharding,
    )
}

#: The mixture: rates from characters per source, the Poisson distribution function summed term by term.
OP10_SQL = """
WITH s AS (
  SELECT source, sum(length(coalesce(text, ''))::DOUBLE) AS chars FROM documents GROUP BY source
), r AS (
  SELECT source, CASE WHEN chars = 0 THEN 1.0 ELSE sum(chars) OVER () * pow(chars, 0.5) / sum(pow(chars, 0.5)) OVER () / chars END AS rate FROM s
), k AS (
  SELECT source, rate, unnest(generate_series(0, ceil(rate + 12 * sqrt(rate) + 20)::BIGINT)) AS i FROM r
), c AS (
  SELECT source, sum(exp(-rate + i * ln(rate) - lgamma(i + 1))) OVER (PARTITION BY source ORDER BY i) AS cdf FROM k
), d AS (
  SELECT *, coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS key FROM documents
), u AS (
  SELECT *, ('0x' || substr(md5('mix-1:1:' || key), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM d
), cdfs AS (
  SELECT source, list(cdf) AS cdfs FROM c GROUP BY source
), n AS (
  SELECT u.*, len(list_filter(cdfs, lambda x: x <= u)) AS n FROM u JOIN cdfs ON u.source IS NOT DISTINCT FROM cdfs.source
), e AS (
  SELECT *, unnest(generate_series(1, n)) AS copy FROM n
)
SELECT doc_id, text, lang, source, n_chars, copy::INT AS copy,
       ('0x' || substr(md5('mix-1:place:' || key || ':' || copy::VARCHAR), 1, 15))::BIGINT AS shuffle_key
FROM e
"""

#: Packing: token counts, the optimal bounds by a recursion over the number of buckets (of equal cost: fewer buckets,
#: then the smaller bound), and batches inside shards.
OP3_SQL = f"""
WITH RECURSIVE t AS (
  SELECT doc_id, coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS key, len(regexp_extract_all(coalesce(text, ''), '{packing.TOKEN}')) AS n FROM documents
), e AS (
  SELECT doc_id, key, n, unnest(generate_series(0, greatest(ceil(n / {packing.MAX_LEN}.0)::BIGINT - 1, 0))) AS piece FROM t
), p AS (
  SELECT doc_id, piece, piece * {packing.MAX_LEN} AS start, least({packing.MAX_LEN}, n - piece * {packing.MAX_LEN}) AS n_tokens,
         ('0x' || substr(md5(key || ':' || piece::VARCHAR), 1, 15))::BIGINT AS place FROM e
), h AS (
  SELECT n_tokens AS length, count(*) AS c FROM p GROUP BY n_tokens
), g AS (
  SELECT length, row_number() OVER (ORDER BY length) AS i, (sum(c) OVER (ORDER BY length))::BIGINT AS upto FROM h
), d AS (
  SELECT 1 AS k, i, length, upto, length * upto AS cost, [length] AS bounds FROM g
  UNION ALL
  SELECT k, i, length, upto, best // 4096, bounds FROM (
    SELECT d.k + 1 AS k, g.i, g.length, g.upto,
           min(CASE WHEN d.i = g.i THEN d.cost * 4096 ELSE (d.cost + g.length * (g.upto - d.upto)) * 4096 + d.i END) AS best,
           arg_min(CASE WHEN d.i = g.i THEN d.bounds ELSE list_append(d.bounds, g.length) END,
                   CASE WHEN d.i = g.i THEN d.cost * 4096 ELSE (d.cost + g.length * (g.upto - d.upto)) * 4096 + d.i END) AS bounds
    FROM d JOIN g ON d.i <= g.i WHERE d.k < {packing.BUCKETS} GROUP BY ALL)
), b AS (
  SELECT unnest(bounds) AS bucket FROM d WHERE k = {packing.BUCKETS} AND i = (SELECT max(i) FROM g)
), x AS (
  SELECT p.*, (SELECT min(bucket) FROM b WHERE bucket >= n_tokens) AS bucket FROM p
), r AS (
  SELECT bucket, greatest(1, {packing.TOKEN_BUDGET} // greatest(bucket, 1)) AS room, count(*) AS c FROM x GROUP BY bucket
), s AS (
  SELECT bucket, room, greatest(1, (c // room) // greatest(1, least(greatest({packing.SHARD_BATCHES}, least({packing.MOST_BATCHES}, (c // room) // {packing.SHARDS})), {packing.SHARD_PIECES} // room))) AS shards FROM r
), n AS (
  SELECT x.*, room, place % shards AS shard, row_number() OVER (PARTITION BY x.bucket, place % shards ORDER BY place, doc_id, piece, n_tokens) - 1 AS pos FROM x JOIN s USING (bucket)
)
SELECT doc_id, piece::INT AS piece, start::INT AS start, n_tokens::INT AS n_tokens, bucket::INT AS bucket, (bucket - n_tokens)::INT AS padding,
       concat_ws('-', bucket, shard, pos // room) AS batch_id, (pos % room)::INT AS slot FROM n
"""

#: Search: every document is scored for every item that shares a term with it.
OP11_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), d AS (
  SELECT row, doc_id, len(w)::BIGINT AS n FROM words WHERE len(w) > 0
), g AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM d
), p AS (
  SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(w) AS term FROM words) GROUP BY ALL
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, g GROUP BY term, docs
), s AS (
  SELECT item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // terms)))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN p USING (term) JOIN d USING (row), g GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 50
"""


def _op12_sql() -> str:
    """Product codes: in each round every part is compared with every entry, component by component."""
    steps = [
        f"""v AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label, list_transform(embedding, lambda x: floor({codes.SCALE} * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), x AS (
  SELECT row, (i - 1) // (n // {codes.PARTS}) AS part, (i - 1) % (n // {codes.PARTS}) AS pos, e[i] AS x FROM (SELECT row, e, len(e) AS n, unnest(generate_series(1, len(e))) AS i FROM v)
), b0 AS (
  SELECT part, row - 1 AS entry, pos, x AS y FROM x WHERE row <= {codes.ENTRIES}
)"""
    ]
    for k in range(codes.ROUNDS + 1):
        steps.append(f"""a{k} AS (
  SELECT row, part, min(d * {codes.ENTRIES} + entry) % {codes.ENTRIES} AS entry, min(d * {codes.ENTRIES} + entry) // {codes.ENTRIES} AS d
  FROM (SELECT row, part, entry, sum((x - y) * (x - y))::BIGINT AS d FROM x JOIN b{k} USING (part, pos) GROUP BY ALL) GROUP BY ALL
)""")
        if k < codes.ROUNDS:
            steps.append(f"""b{k + 1} AS (
  SELECT part, entry, pos, coalesce(m, y) AS y FROM b{k} LEFT JOIN (
    SELECT part, entry, pos, (sum(x) - (sum(x) % count(*) + count(*)) % count(*)) // count(*) AS m FROM x JOIN a{k} USING (row, part) GROUP BY ALL) USING (part, entry, pos)
)""")
    last = codes.ROUNDS
    return f"""WITH {", ".join(steps)}, h AS (
  SELECT sha256(string_agg(y::BIGINT::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM b{last}
), c AS (
  SELECT row, string_agg(lpad(to_hex(entry::BIGINT), 2, '0'), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{last} GROUP BY row
)
SELECT vec_id, lower(code) AS code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM v JOIN c USING (row), h"""


#: Sharding: the slots, the largest first, go to the shard with the fewest bytes, one recursion step a slot; checksums
#: are worked out byte by byte.
OP13_SQL = f"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM (SELECT unnest(generate_series(0, 255))::BIGINT AS b))
), d AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
         ('0x' || substr(md5('{sharding.SEED}:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 15))::BIGINT % {sharding.SLOTS} AS v,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(generate_series(1, strlen(coalesce(text, ''))), lambda i: ('0x' || substr(h, 2 * i - 1, 2))::BIGINT)),
             lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) AS text_crc32
  FROM (SELECT *, hex(encode(coalesce(text, ''))) AS h FROM documents), crc
), s AS (
  SELECT v, coalesce(b, 0) AS b, row_number() OVER (ORDER BY coalesce(b, 0) DESC, v) AS r FROM (SELECT unnest(generate_series(0, {sharding.SLOTS - 1})) AS v) LEFT JOIN (SELECT v, sum(size)::BIGINT AS b FROM d GROUP BY v) USING (v)
), m AS (
  SELECT 0::BIGINT AS r, NULL::BIGINT AS v, NULL::BIGINT AS shard, list_transform(generate_series(1, {sharding.SHARDS}), lambda i: 0::BIGINT) AS held
  UNION ALL
  SELECT s.r, s.v, list_position(held, list_min(held))::BIGINT, list_transform(held, lambda h, i: CASE WHEN i = list_position(held, list_min(held)) THEN h + b * 8192 + 1 ELSE h END) FROM m JOIN s ON s.r = m.r + 1
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, (shard - 1)::INT AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY d.v, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, NULL::INT AS grown_shard, d.v::INT AS virtual_slot
FROM d JOIN m ON m.v = d.v
"""

ORACLES: dict[str, str] = {"op3_packing": OP3_SQL, "op10_mixing": OP10_SQL, "op11_lexical_search": OP11_SQL, "op12_vector_codes": _op12_sql(), "op13_sharding": OP13_SQL}
