"""The whole pipeline against plain versions of its stages."""

import re
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from constella.llm.queries import SEQUENCE_LENGTHS, SURROGATE_KEY
from constella.llm.surrogates import replace

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def survivors(rows):
    """Smallest id of each group of texts whose fingerprints are linked by two bits or fewer, one after the other."""
    marks, left, kept = {i: fingerprint(t) for i, t in rows}, {i for i, _ in rows}, set()
    while left:
        group, todo = set(), [left.pop()]
        while todo:
            x = todo.pop()
            group.add(x)
            near = {y for y in left if (marks[x] ^ marks[y]).bit_count() <= 2}
            left -= near
            todo += near
        kept.add(min(group))
    return kept


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr(
        "doc_id", "text", "lang", "source", "n_chars")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    some = sorted(texts)[:6]
    long = " ".join(f"word{i * i % 977} the" for i in range(4000))
    more = [(10_000 + i, texts[k], "en", None, 5) for i, k in enumerate(some)]                     # copies of others
    more += [(-5, texts[some[0]], None, "s", None), (10_100, None, "en", "s", None), (10_101, "", "en", "s", 0),
             (10_102, "12 !! 34", None, "s", 8), (10_103, long, "en", "s", len(long)), (10_104, long.upper(), "en", "s", len(long)),
             (10_105, " ".join(reversed(texts[some[3]].split())) + " a.b@c.org and +49 30 1234567", "en", "s", 0)]
    docs.union(spark.createDataFrame(more, DOCUMENTS)).write.parquet(f"{at}/documents.parquet")
    return at


def test_run_matches_plain_stages(spark, folder):
    import public_tokenizers as P
    from constella.llm.packing import _encoding

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = survivors([(i, t) for i, t in rows if t and any(c.isalpha() for c in t)])
    assert len(kept) < len(rows) - 6 and -5 in kept and 10_103 in kept and 10_104 not in kept
    said = {r.doc_id: r.text for r in replace(docs.filter(F.col("doc_id").isin(*kept)), SURROGATE_KEY).collect()}
    assert "a.b@c.org" not in said[10_105]
    encode = _encoding(P.path("byte_bpe_50k.tiktoken"), P.PATTERN).encode_ordinary
    want = {i: len(encode(t)) + 1 for i, t in said.items()}

    per_doc, bins = defaultdict(list), defaultdict(list)
    for r in corpus_pipeline.run(spark, folder).collect():
        per_doc[r.doc_id].append((r.start, r.length))
        bins[r.bin_id, r.bin_size].append((r.position, r.length))
    assert per_doc.keys() == want.keys()
    for i, parts in per_doc.items():
        ends = [0]
        for start, n in sorted(parts):
            assert start == ends[-1]
            ends.append(start + n)
        assert ends[-1] == want[i]
    assert len({b for b, _ in bins}) == len(bins)
    for (_, size), items in bins.items():
        at = 0
        for position, n in sorted(items):
            assert position >= at
            at = position + n
        assert at <= size and size == min(s for s in SEQUENCE_LENGTHS if s >= sum(n for _, n in items))


def test_run_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
