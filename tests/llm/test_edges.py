"""Nulls, empty and repeated rows, clashing names and empty tables, against brute-force versions."""

import itertools
import base64
import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash

from constella.llm.common import importable, shared_dir

SCHEMA = "doc_id bigint, text string, lang string, ids string, fp string, score string, _shard int"
LINES = "".join(f"paragraph {i}\n" for i in range(300))
DOCS = [(1, "The quick brown fox jumps over the lazy dog", "en"), (2, "The quick brown fox jumps over the lazy dog", "en"),
        (3, None, "en"), (4, "", None), (None, "le renard brun saute par-dessus le chien", "fr"), (6, "12 34 !!", "fr"),
        (7, "mail me: a.b@mail1.example.com or +1 (309) 555-7741", "en"), (7, "mail me: a.b@mail1.example.com or +1 (309) 555-7741", "en"),
        (8, LINES, "en"), (9, "word " * 30_000, "en"), (10, " \n\t ", "en")]


@pytest.fixture(scope="module")
def docs(spark):
    importable(spark)
    return spark.createDataFrame([(*d, "x", "x", "x", 0) for d in DOCS], SCHEMA).cache()


def test_pretokens_and_merges_match_the_libraries():
    import public_tokenizers as P
    import tiktoken
    from tokenizers import Tokenizer

    from constella.llm.bpe import codec
    from constella.llm.token_files import encoder

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    tik = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    own, enc = codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN), encoder(P.path("byte_bpe_50k.json"))
    rng = random.Random(7)
    for _ in range(500):
        text = "".join(rng.choice(" \n\t'sabcé¿漢1239.!\x85\x1cñ😀") for _ in range(rng.randint(0, 40)))
        ids = np.frombuffer(own.encode(text), "<i4").tolist()
        assert ids == tik.encode_ordinary(text)
        assert own.decode(ids) == text.encode()
        assert enc.encode(text + "<|endoftext|>").tolist() == tok.encode(text + "<|endoftext|>", add_special_tokens=False).ids


def test_tree_forest_joins_what_brute_force_joins():
    from constella.llm.simhash import forest

    rng = random.Random(1)
    fps = [rng.getrandbits(64) for _ in range(60)]
    fps = list({f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for f in fps for _ in range(4)} | set(fps))

    def parts(links):
        top = {f: f for f in fps}

        def root(f):
            while top[f] != f:
                f = top[f]
            return f

        for a, b in links:
            top[root(a)] = root(b)
        return {frozenset(f for f in fps if root(f) == r) for r in set(map(root, fps))}

    assert parts(forest(fps, 2)) == parts([(a, b) for a in fps for b in fps if (a ^ b).bit_count() <= 2])


def test_plan_packs_every_item_and_cuts_bins_down():
    from constella.llm.packing import plan

    rng = random.Random(2)
    counts = {n: rng.randint(1, 9) for n in rng.sample(range(1, 101), 60)}
    groups, seen = plan(counts, [25, 50, 100]), {}
    for g in groups:
        used = sum(n * k for n, k in g.items)
        assert used + g.room == g.size == min(s for s in (25, 50, 100) if s >= used)
        for n, k in g.items:
            seen[n] = seen.get(n, 0) + k * g.bins
    assert seen == counts and plan({}, [8]) == []


def test_token_files(spark, docs):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    from constella.llm.token_files import TokenFile, read_documents, write_token_files

    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    manifest = write_token_files(docs, shared_dir(spark, "t"), P.path("byte_bpe_50k.json"), 0, seq_len=64, shard_bytes=2000)
    got = sorted((r.start, r.n_tokens, r.ids_crc32) for r in read_documents(manifest).collect())
    want, start = [], 0
    for _, text in sorted(((d[0], d[1] or "") for d in DOCS), key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = [*tok.encode(text, add_special_tokens=False).ids, 0]
        want.append((start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    file = TokenFile(manifest.orderBy("shard").first().uri)
    assert file.sequence(0).base is not None and file.mask(0)[0]    # a view of the mapped file


def test_simhash_and_language(docs):
    from constella.llm.langid import fit, predict
    from constella.llm.simhash import near_duplicates, simhash

    got = [(r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in near_duplicates(docs).collect()]
    assert sorted(x[1] for x in got) == sorted(simhash(d[1]) for d in DOCS)
    of = {i: c for i, _, c in got}
    assert of[2] == 1 and of[4] == of[10] == 3 and of[None] is None and of[7] == 7
    rows = {r.doc_id: r for r in predict(docs, fit(docs)).collect()}
    assert rows[3].lang_pred == rows[4].lang_pred == rows[6].lang_pred == "und"
    assert rows[1].lang_pred == "en" and rows[None].lang_pred == "fr" and rows[1].ids == "x" and 0 <= rows[1].score <= 1


def test_fingerprints_and_surrogates(docs):
    from constella.llm.fingerprint import fingerprints
    from constella.llm.surrogates import replace

    order = sorted(((d[0], d[1] or "") for d in DOCS), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    sets = lambda t: {x.strip(" ") for x in t.split("\n")} - {""}
    want, digest = [], lambda x: xxhash.xxh64_intdigest(x.encode(), 42)
    signed = lambda xs: tuple(sorted(x - (x >> 63 << 64) for x in map(digest, xs)))
    for i, (key, text) in enumerate(order):
        after, half = order[(i + 1) % len(order)][1], len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        a, b, c = sets(text), sets(edited), sets(after)
        like = lambda x, y: round(len(x & y) / len(x | y) if x | y else 1.0, 9)
        want.append((key or 0, len(text), hashlib.sha256(edited.encode()).hexdigest(), like(a, b), like(a, c),
                     signed(a - b), signed(b - a)))
    rows = fingerprints(docs).collect()
    got = [(r.doc_id or 0, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9), tuple(r.lost),
            tuple(r.gained)) for r in rows]
    of = {i: {r.fingerprint for r in rows if r.doc_id == i} for i in (1, 2, 3, 4)}
    assert of[1] == of[2] and of[3] == of[4] and of[1] != of[3]
    assert sorted(got) == sorted(want)    # 300 paragraphs: peeling must be tried again with larger tables
    rows = [r for r in replace(docs, "k").collect() if r.n_entities]
    assert len(rows) == 2 and rows[0].text == rows[1].text and "555-7741" not in rows[0].text
    assert {r.text for r in replace(docs, "k").filter("doc_id = 3").collect()} == {None}


def test_empty_tables(spark, docs):
    from constella.llm.ego_join import near_vectors
    from constella.llm.packing import pack
    from constella.llm.warc import read_warc, write_warc

    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]),
                                     (6, [1.0, 0.0, 0.0]), (2, [1.0, 0.01])], "vec_id bigint, embedding array<double>")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in near_vectors(vectors).collect())
    assert got == [(1, 2, 1), (2, 2, 1), (2, 2, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 0, 6)]
    assert near_vectors(vectors.limit(0)).count() == 0
    assert pack(spark.createDataFrame([], "doc_id bigint, length bigint"), [8]).count() == 0
    pages = spark.createDataFrame([(1, "u", "a"), (2, None, "a"), (None, "u", "a"), (3, "u", None)], "page_id bigint, url string, html string")
    got = {r.key: (r.record_type, r.refers_to, r.payload_bytes) for r in read_warc(write_warc(pages, shared_dir(spark, "w"))).collect()}
    assert got == {1: ("revisit", 2, 1), 2: ("response", None, 1), None: ("revisit", 2, 1), 3: ("response", None, 0)}


def test_batches_of_texts_encode_as_the_library_does(monkeypatch):
    import random

    import public_tokenizers
    import pyarrow as pa

    from constella.llm import chunks
    from constella.llm.token_files import TextEncoder

    monkeypatch.setattr(chunks, "SLICE", 4096)
    enc, draw = TextEncoder(public_tokenizers.path("byte_bpe_50k.json")), random.Random(7)
    letters = " \t\n\r\x0b\x1c\x85\u00a0\u2003\u3000\u200bab'sZ\u00e91\u6f22!   "
    texts = ["".join(draw.choices(letters, k=draw.randrange(30))) for _ in range(3000)]
    texts += [None, "", " ", " " * 20_000, "a" * 20_000, "word " * 20_000]
    want = [enc.tok.encode(t or "", add_special_tokens=False).ids for t in texts]
    ids, counts = enc.cache.encode_all(pa.array(texts))
    assert counts.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]
    assert enc.count_all(pa.array(texts)).tolist() == counts.tolist()
    assert enc.count_all(pa.array(["a <|endoftext|> b", None])).tolist() == [4, 0]
    assert enc.count_all(pa.array([], pa.string())).tolist() == []


def test_words_met_again_are_not_encoded_again():
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer

    from constella.llm.chunks import ChunkTable

    class Counting:
        def __init__(self, tok):
            self.tok, self.asked, self.model = tok, [], self

        def encode(self, text, **settings):
            self.asked.append(text)
            return self.tok.encode(text, **settings)

        def tokenize(self, word):
            self.asked.append(word)
            return self.tok.model.tokenize(word)

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    count, letters = Counting(tok), "abcdefgh"
    table = ChunkTable(count)
    words = ["".join(w) for w in itertools.product(letters, repeat=4)]
    texts = [f"Head {w} {w}, {w}.\n{w} 7{w} {w}\n\n{w} {w}'s caf\u00e9{w} {w}\x1c {w}\n" for w in words]
    want = [tok.encode(t).ids for t in texts]
    ids, counts = table.encode_all(pa.array(texts))
    assert counts.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]
    assert all(count.asked.count(x) == 1 for x in ("\u0120" + words[0], words[0], ",", "'s"))    # in whatever chunk
    before = len(count.asked)
    ids, counts = table.encode_all(pa.array([f"Head {w}; {w}, {w}" for w in reversed(words)]))
    assert count.asked[before:] == [";", "Head"]
    small = ChunkTable(tok, room=3)
    for _ in range(2):    # what was forgotten is encoded again
        assert small.encode_all(pa.array(texts[:50]))[0].tolist() == [i for x in want[:50] for i in x]
    assert len(small.stems.texts) == len(small.stems.ids) == 3


def test_batches_of_ids_decode_to_the_texts():
    import public_tokenizers as P
    import pyarrow as pa

    from constella.llm.bpe import codec

    own = codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    texts = ["drop", None, "", "plain words, again words", "\u6f22\U0001f600 \u00e9\n\n x", " " * 5000, "ab" * 9000]
    lists = own.encode_all(pa.array(texts))
    assert [x.as_py() for x in lists] == [np.frombuffer(own.encode(t), "<i4").tolist() for t in texts]
    assert own.decode_all(lists.slice(1)).to_pylist() == [(t or "").encode() for t in texts[1:]]
    assert own.decode_all(pa.array([None, [], [1]], pa.list_(pa.int32()))).to_pylist() == [b"", b"", own.decode([1])]
    assert own.decode_all(pa.array([], pa.list_(pa.int32()))).to_pylist() == []
    with pytest.raises(ValueError):
        own.decode_all(pa.array([[own.ids[-1], None]], pa.list_(pa.int32())))


def test_a_pair_s_digests_are_hashed_once(spark, capsys):
    from pyspark.sql import functions as F

    from constella.llm.fingerprint import differences, peel, sketch, subtract

    pairs = spark.createDataFrame([(1, [5, 6, 7], [7, 8]), (2, [], [-1]), (3, [9], [9]), (4, list(range(40)), list(range(60)))],
                                  "row bigint, a array<bigint>, b array<bigint>")
    pairs.select(peel(subtract(sketch(F.col("a")), sketch(F.col("b"))), F.lit(0)).alias("d")).explain("simple")
    assert capsys.readouterr().out.count("xxhash64(") == 3    # a's, b's and, when peeling, a single digest's
    got = {r.row: (sorted(r.only_a), sorted(r.only_b)) for r in differences(pairs).collect()}
    assert got == {1: ([5, 6], [8]), 2: ([], [-1]), 3: ([], []), 4: ([], list(range(40, 60)))}


@pytest.mark.parametrize("pattern", [r"\p{L}+ \p{L}+|\s+|\S", r"(\p{L}+) |.|\n"])
def test_other_patterns_may_match_across_spaces(pattern):
    import public_tokenizers as P
    import pyarrow as pa
    import regex

    from constella.llm.bpe import Codec

    own = Codec(P.path("byte_bpe_50k.tiktoken"), pattern)
    texts = ["the quick brown fox", "a b  c d e\n f g", "", "one two", None, "one two"]
    want = [[i for m in regex.finditer(pattern, t or "") for i in own.encode_word(m.group())] for t in texts]
    assert own.encode_all(pa.array(texts)).to_pylist() == want
    assert [np.frombuffer(own.encode(t), "<i4").tolist() for t in texts] == want


def test_ids_too_large_for_a_token_file_are_an_error(spark, tmp_path):
    import public_tokenizers as P

    from constella.llm.token_files import write_token_files

    docs = spark.createDataFrame([(1, "some ordinary words")], "doc_id bigint, text string")
    for end, dtype in ((0, "uint8"), (70_000, "uint16")):
        with pytest.raises(Exception, match="doesn't fit"):
            write_token_files(docs, f"file://{tmp_path}/{dtype}", P.path("byte_bpe_50k.json"), end, dtype=dtype).count()
