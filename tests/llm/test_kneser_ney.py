"""The bigram model against a plain one over dictionaries, and what every model must fulfil."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from constella.llm import kneser_ney
from constella.llm.common import importable
from constella.llm.kneser_ney import BEGIN, perplexity, score, train, word_hashes

SCHEMA = "doc_id bigint, text string, score string, n_tokens int"
CASE = {c: c + 32 for c in range(65, 91)}


def tokens(text):
    return [w.decode() for w in (text or "").translate(CASE).encode().split()] + ["</s>"]


class Plain:
    def __init__(self, texts):
        docs = [["<s>", *tokens(t)] for t in texts]
        self.pairs = Counter(p for d in docs for p in zip(d, d[1:]))
        self.count = Counter(w for d in docs for w in d[1:])
        self.after, self.contexts = defaultdict(list), Counter()
        for (h, w), c in self.pairs.items():
            self.after[h].append(c)
            self.contexts[w] += 1
        self.d = self.discounts(self.pairs.values())
        self.dw = self.discounts(self.contexts.values())
        self.types, self.bigrams = len(self.count), len(self.pairs)
        self.rest = sum(self.dw(c) for c in self.contexts.values()) / self.bigrams if docs else 1.0

    @staticmethod
    def discounts(counts):
        n = Counter(counts)
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.0
        def d(c):
            k = min(c, 3)
            return min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.0), k) if k and n[k] else 0.0
        return d

    def p(self, h, w):
        c = self.contexts[w]
        single = max(c - self.dw(c), 0) / max(self.bigrams, 1) + self.rest / (self.types + 1)
        if h not in self.after:
            return single
        seen, c = self.after[h], self.pairs[h, w]
        return max(c - self.d(c), 0) / sum(seen) + sum(map(self.d, seen)) / sum(seen) * single

    def row(self, text):
        said, n = ["<s>", *tokens(text)], sum(self.count.values())
        return (len(said) - 1, sum(self.count[w] > 0 for w in said[1:]), n,
                sum(math.log10((self.count[w] + 1) / (n + self.types + 1)) for w in said[1:]),
                sum(math.log10(self.p(h, w)) for h, w in zip(said, said[1:])))


def texts(seed, n=60):
    rng = random.Random(seed)
    words = [f"{w}{k}" for k in range(12) for w in ("Ab", "é", "x y", "漢")]
    some = [" ".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=rng.randint(0, 30))) for _ in range(n)]
    # copies, ties, every kind of white space, nulls, nothing
    return some + some[:5] + ["the " * 3000, "a\tb\x0bc\x0cd\re\nf", "  ", "", None, None, "ÀB Àb İ"]


@pytest.fixture(scope="module")
def scored(spark, tmp_path_factory):
    def run(training, all_):
        importable(spark)
        frame = lambda rows: spark.createDataFrame([(i, t, "x", 0) for i, t in enumerate(rows)], SCHEMA).repartition(3)
        model = train(frame(training), f"file://{tmp_path_factory.mktemp('model')}")
        return model, [tuple(r)[1:] for r in score(frame(all_), model).orderBy("doc_id").select(
            "doc_id", *kneser_ney.OUTPUTS).collect()]
    return run


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_scores_match_the_plain_model(scored, seed):
    training, others = texts(seed), texts(seed + 10) + ["unseen words only", "the unseen the"]
    plain = Plain(training)
    _, got = scored(training, others)
    for t, row in zip(others, got):
        want = plain.row(t)
        assert row[:3] == want[:3]
        assert row[3:] == pytest.approx(want[3:], rel=1e-9, abs=1e-9), t


def test_blocks_don_t_change_the_counts(scored):
    training = texts(4) + [" ".join(str(i % 700) for i in range(30_000))]
    plain = Plain(training)
    model, got = scored(training * 2, training[:3])
    assert (model.tokens, model.types, model.bigrams) == (2 * sum(plain.count.values()), plain.types, plain.bigrams)
    assert all(np.isfinite(r[4]) for r in got)


def test_probabilities_sum_to_one_after_every_context(scored):
    training = texts(5)
    model, _ = scored(training, [])
    plain = Plain(training)
    digest = lambda w: xxhash.xxh64_intdigest(b" end" if w == "</s>" else w.encode())
    all_words = np.array([digest(w) for w in plain.count] + [digest("never seen")], dtype=np.uint64)
    for h in [BEGIN, *(np.uint64(digest(w)) for w in list(plain.after)[1:12]), np.uint64(7)]:
        logs, _ = model.log_probabilities(np.full(len(all_words), h), all_words)
        assert (10 ** logs).sum() == pytest.approx(1)


def test_no_training_rows_and_no_rows(scored):
    _, got = scored([], ["a b", None])
    assert [r[:3] for r in got] == [(3, 0, 0), (1, 0, 0)] and all(r[3] == r[4] == 0 for r in got)    # one in V + 1 = 1
    assert scored(["a b"], [])[1] == []


def test_long_texts_are_cut_at_white_space_only(monkeypatch):
    rng = random.Random(6)
    text = "".join(rng.choice("aB \n\té漢") for _ in range(5000)) + "w" * 400 + " end"
    whole = word_hashes(text)
    monkeypatch.setattr(kneser_ney, "_PIECE", 64)
    assert (word_hashes(text) == whole).all() and len(whole) == len(tokens(text))


def test_held_out_texts_are_less_surprising_than_to_single_words(spark, scored):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", F.col("text")).orderBy("doc_id").collect()
    _, got = scored([r.text for r in docs if r.doc_id % 7], [r.text for r in docs if not r.doc_id % 7])
    n = sum(r[0] for r in got)
    assert perplexity(sum(r[4] for r in got), n) < perplexity(sum(r[3] for r in got), n)
