"""The registered queries of this folder, with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from constella.llm.common import cut, id_crc, shared_dir, table


SEQUENCE_LENGTHS = (512, 1024, 2048, 4096, 8192)


#: Stands for a secret that a deployment passes in; the same key gives the same surrogates.
SURROGATE_KEY = "constella"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back."""
    from constella.llm.warc import read_warc, write_warc

    manifest = write_warc(table(spark, sf_dir, "pages"), shared_dir(spark, "warc"), min_revisit_bytes=0)
    return read_warc(manifest).select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                                      "refers_to")


OP1_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS x FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY x) AS top FROM d)
SELECT page_id, payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (((('0x' || substr(x, ((i // 4) * 5 + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT, 1)
           for i in range(0, 32)], '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM m
"""


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written as Arrow files and read back: place, length and checksum."""
    from constella.llm.token_files import read_documents, write_token_files

    manifest = write_token_files(table(spark, sf_dir, "documents"), shared_dir(spark, "tokens"),
                                 vocabulary("byte_bpe_50k.json"), end_id=0)
    return read_documents(manifest).withColumnRenamed("key", "doc_id")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that aren't held out."""
    from constella.llm.langid import fit, predict

    docs = table(spark, sf_dir, "documents").withColumn("held_out", id_crc("doc_id") % 4 == 2)
    profiles = fit(docs.filter(~F.col("held_out")))
    return predict(docs.select("doc_id", "held_out", "text"), profiles).drop("text")


def op4_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its links of cosine 0.9 and more and its component."""
    from constella.llm.ego_join import near_vectors

    found = near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.9)
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, that of its edited text, their likeness and the digests in which they differ."""
    from constella.llm.fingerprint import fingerprints

    digests = lambda name: F.array_join(F.transform(name, lambda x: F.hex(x)), " ").alias(name)
    return fingerprints(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
        digests("lost"), digests("gained"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and the smallest id within reach by links of two bits or fewer."""
    from constella.llm.simhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2, seed=42)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a model learned from those that aren't held out."""
    from constella.llm.kneser_ney import score, train

    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (id_crc("doc_id") % 7 == 2).alias("held_out"), "text")
    model = train(docs.filter(~F.col("held_out")), shared_dir(spark, "kneser-ney"))
    return score(docs, model).drop("text")


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data and secrets replaced."""
    from constella.llm.surrogates import replace

    return replace(table(spark, sf_dir, "documents"), key=SURROGATE_KEY)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens packed into sequences of five permitted lengths."""
    return packed(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    from constella.llm.packing import pack, token_lengths

    from public_tokenizers import PATTERN

    lengths = cut(token_lengths(docs, vocabulary("byte_bpe_50k.tiktoken"), PATTERN), name="token-lengths")
    return pack(lengths, SEQUENCE_LENGTHS)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded: token count and digests of ids and bytes."""
    from public_tokenizers import PATTERN

    from constella.llm.bpe import bpe_decode, bpe_encode

    ranks = vocabulary("byte_bpe_50k.tiktoken")
    ids = bpe_encode(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, PATTERN)
    ids = ids.select("doc_id", "ids")
    return bpe_decode(ids, ranks, PATTERN).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector on the 32 leading principal components of all of them, scaled to unit variance."""
    from constella.llm.whitening import whiten

    found = whiten(table(spark, sf_dir, "embeddings"), components=32)
    return found.withColumn("deviation", F.col("deviation").cast("bigint"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its Merkle proof, folded again from its leaf, or a tampered one where 7 divides its crc32."""
    from constella.llm.merkle import fold, manifest, proof_digest, prove

    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    found = prove(manifest(table(spark, sf_dir, "documents"), tampered))
    found = found.withColumn("folded_root", fold(F.coalesce("altered", "hash")))
    return found.select("doc_id", F.col("hash").alias("leaf"), "subroot", "root", proof_digest().alias("proof_sha256"),
                        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix takes of it."""
    from constella.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents"), cycle=(1, 2, 3), epochs=3, seed=13)


QUERIES = {
    "op1_warc": op1_warc,
    "op2_token_files": op2_token_files,
    "op3_language": op3_language,
    "op4_vectors": op4_vectors,
    "op5_fingerprints": op5_fingerprints,
    "op6_simhash": op6_simhash,
    "op7_kneser_ney": op7_kneser_ney,
    "op8_surrogates": op8_surrogates,
    "op9_packing": op9_packing,
    "op10_bpe": op10_bpe,
    "op11_whitening": op11_whitening,
    "op12_merkle": op12_merkle,
    "op13_mixing": op13_mixing,
}

_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0}::VARCHAR END"


def _leaf_sql(n_chars: str) -> str:
    return " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", n_chars, "text"))


# crc32 of an id's decimal digits, a bit at a time: a byte is mixed in, then eight steps (-1) of the polynomial
OP12_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, sha256({_leaf_sql('n_chars')}) AS leaf, sha256({_leaf_sql('(n_chars + 1)')}) AS other,
         list_reduce(flatten([[4294967295::BIGINT], flatten([[ascii(substr(doc_id::VARCHAR, i::INT, 1))::BIGINT,
             -1, -1, -1, -1, -1, -1, -1, -1] for i in range(1, strlen(doc_id::VARCHAR) + 1)])]),
             lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END) AS crc
  FROM documents),
l AS (SELECT doc_id, coalesce('=' || lang, '') AS g, leaf,
             CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN other ELSE leaf END AS start,
             row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
             count(*) OVER (PARTITION BY lang) AS n FROM d),
nodes(g, k, i, n, h) AS (
  SELECT g, 0, i, n, leaf FROM l
  UNION ALL SELECT g, k + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1
  GROUP BY g, k, i // 2, n),
s AS (SELECT g, k, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(k, i, n, h) AS (
  SELECT 0, i, n, subroot FROM s
  UNION ALL SELECT k + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM tops WHERE n > 1
  GROUP BY k, i // 2, n),
steps AS (
  SELECT l.g, l.i AS row_, k.k AS k, (l.i >> k.k) & 1 AS is_right, o.h AS h
  FROM l JOIN s ON s.g = l.g JOIN (SELECT DISTINCT g, k, n FROM nodes) k ON k.g = l.g AND k.n > 1
  LEFT JOIN nodes o ON o.g = l.g AND o.k = k.k AND o.i = xor(l.i >> k.k, 1)
  UNION ALL
  SELECT l.g, l.i, s.k + t.k, (s.i >> t.k) & 1, o.h
  FROM l JOIN s ON s.g = l.g JOIN (SELECT DISTINCT k, n FROM tops) t ON t.n > 1
  LEFT JOIN tops o ON o.k = t.k AND o.i = xor(s.i >> t.k, 1)),
proofs AS (SELECT g, row_, sha256(coalesce(string_agg(h, '' ORDER BY k), '')) AS proof_sha256 FROM steps GROUP BY g, row_),
folds(g, row_, k, h) AS (
  SELECT g, i, 0, start FROM l
  UNION ALL SELECT f.g, f.row_, f.k + 1, sha256(CASE WHEN p.is_right = 1 THEN coalesce(p.h, '') || f.h
                                               ELSE f.h || coalesce(p.h, '') END)
  FROM folds f JOIN steps p ON p.g = f.g AND p.row_ = f.row_ AND p.k = f.k),
ends AS (SELECT g, row_, arg_max(h, k) AS folded_root FROM folds GROUP BY g, row_)
SELECT l.doc_id, l.leaf, s.subroot, r.h AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
       e.folded_root, e.folded_root = r.h AS verified
FROM l JOIN s ON s.g = l.g JOIN ends e ON e.g = l.g AND e.row_ = l.i CROSS JOIN (SELECT h FROM tops WHERE n = 1) r
LEFT JOIN proofs p ON p.g = l.g AND p.row_ = l.i
"""

OP13_SQL = """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
           FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
      FROM d GROUP BY source),
-- those with the least room for their weight are clamped first: the level without the first k of them
o AS (SELECT *, coalesce(sum(3 * source_size) OVER before, 0)::BIGINT AS clamped,
             (sum(w) OVER () - coalesce(sum(w) OVER before, 0))::BIGINT AS open_, (sum(source_size) OVER ())::BIGINT AS total
      FROM s WINDOW before AS (ORDER BY 3.0 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT total - clamped AS rest, open_ FROM o
          WHERE 3 * source_size * open_ >= w * (total - clamped) ORDER BY open_ DESC LIMIT 1),
t AS (SELECT source, source_size,
             CASE WHEN 3 * source_size * open_ < w * rest THEN (3 * source_size)::DOUBLE
                  ELSE (w * rest)::DOUBLE / open_::DOUBLE END AS target,
             CASE WHEN 3 * source_size * open_ < w * rest THEN 3 * source_size
                  ELSE (2 * w * rest + open_) // (2 * open_) END AS take
      FROM s CROSS JOIN level),
laid AS (SELECT d.*, t.source_size, t.target, t.take, coalesce(sum(d.size) OVER (
           PARTITION BY d.source ORDER BY md5('13:' || coalesce(d.doc_id::VARCHAR, '-')), d.doc_id, d.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
         FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, source,
       (CASE WHEN source_size > 0 THEN take // source_size ELSE 0 END)::BIGINT AS repetitions,
       ((CASE WHEN source_size > 0 THEN take // source_size ELSE 0 END) * size + least(greatest(
          CASE WHEN source_size > 0 THEN take % source_size ELSE 0 END - before, 0), size))::BIGINT AS taken
FROM laid
"""

SQL: dict[str, str] = {"op1_warc": OP1_SQL, "op12_merkle": OP12_SQL, "op13_mixing": OP13_SQL}
