"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent letter n-grams (n = 1 to 3, words padded with a space), most
frequent first.  A document's own list is compared with every profile by the out-of-place distance: the sum over the
document's n-grams of how far each stands from its place in the profile, or the profile's length if it isn't there.
The nearest language wins; ties go to the smallest name.  The score is 1 - distance / largest possible distance.

n-grams are counted over all training texts: by tasks over their rows (memory bounded by ``ROOM`` distinct n-grams),
then by Spark per language and n-gram.  A profile has ``size`` entries, so all of them together are bounded by the
number of languages, which is checked.

Nulls and ties: rows with a null lang or text teach nothing; a null text and a text without letters are ``und`` with
score 0, and so is everything if nothing was learned.  Repeated rows count as often as they come.  Other columns pass
through; one that already has an output's name is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROOM = 400_000
MAX_LANGUAGES = 2_000
UNKNOWN = "und"
_OTHER = regex.compile(r"\P{L}+")
_SPAN = 1 << 20


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams (code points packed in 21 bits each) of a whole text, and their counts."""
    letters = _OTHER.sub(" ", text.lower()).strip()
    if not letters:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    all_ = np.frombuffer(f" {letters} ".encode("utf-32-le"), dtype="<u4")
    found = []
    for at in range(0, len(all_), _SPAN):    # n-grams that begin in the span
        c = all_[at:at + _SPAN + 2].astype(np.int64)
        space = c == 32
        one = c[:_SPAN][~space[:_SPAN]]
        two = (c[:-1] << 21 | c[1:])[:_SPAN]
        three = (c[:-2] << 42 | c[1:-1] << 21 | c[2:])[:_SPAN][~space[1:-1][:_SPAN]]
        found.append(np.unique(np.concatenate([one, two, three]), return_counts=True))
    return found[0] if len(found) == 1 else _merged(found)


def _merged(counted: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams, at = np.unique(np.concatenate([g for g, _ in counted]), return_inverse=True)
    counts = np.zeros(len(grams), dtype=np.int64)
    np.add.at(counts, at, np.concatenate([n for _, n in counted]))
    return grams, counts


def ranked(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, ties by code."""
    return grams[np.lexsort((grams, -counts))[:size]]


class Profiles:
    """Languages in order of their names, the n-grams of all profiles, and each n-gram's rank by language."""

    def __init__(self, ranks: dict[str, dict[int, int]], size: int):
        self.size, self.names = size, sorted(ranks)
        self.grams = np.array(sorted({g for r in ranks.values() for g in r}), dtype=np.int64)
        self.ranks = np.full((len(self.grams), len(self.names)), -1, dtype=np.int64)
        at = {g: i for i, g in enumerate(self.grams.tolist())}
        for k, name in enumerate(self.names):
            for g, r in ranks[name].items():
                self.ranks[at[g], k] = r

    def predict(self, text: str | None) -> tuple[str, float]:
        grams = ranked(*gram_counts(text or ""), self.size)
        if not len(grams) or not self.names:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        theirs = np.where((self.grams[at] == grams)[:, None], self.ranks[at], -1)
        own = np.arange(len(grams))[:, None]
        distance = np.where(theirs < 0, self.size, np.abs(theirs - own)).sum(0)
        best = int(distance.argmin())
        return self.names[best], 1.0 - float(distance[best]) / (len(grams) * self.size)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", size: int = 400) -> Profiles:
    """Profiles of every language of ``docs``, learned from all of its rows."""
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))

    def count(batches):
        held: dict[str, list] = {}
        room = 0

        def flush():
            for name, counted in held.items():
                grams, n = _merged(counted)
                yield pa.record_batch({"lang": pa.array([name] * len(grams)), "gram": pa.array(grams),
                                       "n": pa.array(n)})

        for batch in batches:
            for name, t in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                counted = gram_counts(t)
                held.setdefault(name, []).append(counted)
                room += len(counted[0])
                if room > ROOM:
                    held = {k: [_merged(v)] for k, v in held.items()}
                    room = sum(len(v[0][0]) for v in held.values())
                    if room > ROOM // 2:
                        yield from flush()
                        held, room = {}, 0
        yield from flush()

    counts = rows.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))
    # a limit by rank: Spark keeps the first rows of each task before the shuffle
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)
    ranks: dict[str, dict[int, int]] = {}
    for name, gram, rank in top.select("lang", "gram", "rank").toLocalIterator():
        ranks.setdefault(name, {})[gram] = rank - 1
        if len(ranks) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} distinct values of {lang}: not a language column")
    return Profiles(ranks, size)


def predict(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; only the text is looked at."""
    docs = docs.drop("lang_pred", "score")
    shared = docs.sparkSession.sparkContext.broadcast(profiles)    # size x MAX_LANGUAGES ranks at most

    def guess(batches):
        for batch in batches:
            found = [shared.value.predict(t) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(guess, T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()),
                                                T.StructField("score", T.DoubleType())]))
