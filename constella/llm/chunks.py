"""Text cut into chunks whose byte-level BPE encodings concatenate to that of the whole text.

Many texts are cut at once by Arrow, whose dictionary leaves each distinct chunk to be looked up once.

The byte-level pattern never lets a pre-token run from a character that isn't white space into a following space,
and looks no further back; so a text may be cut before every single space between two other characters.  Chunks
repeat (they are words with punctuation), and so do their pre-tokens; each worker keeps the encodings of recent ones.
By any other pattern a text is one chunk.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# Fixed value: the pattern of the byte-level vocabularies
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Python's \s holds every character that the vocabulary's pattern takes for white space, and a few more: no wrong cut
_UNCLEAR = re.compile(r" \s|\s ")
# The same by the white space characters themselves, for Arrow
_UNCLEAR_RE2 = "( [{0}]|[{0}] )".format("".join(c for c in map(chr, range(0x3001)) if c.isspace()))
# A chunk's first letters, all ASCII, and what follows them; the last line of that, where it is one word.  Both are cut
# where a pre-token ends: after a run of letters, and after a single line break
_STEM_RE2 = r"(?s)^(?P<stem>[A-Za-z]+)(?P<tail>(?:[\x00-@\[-`{-\x7f].*)?)$"
_LINE_RE2 = r"(?s)^(?P<tail>(?:.*[!-~])?\n)(?P<line>[A-Za-z]+)$"
_CUT = re.compile(r"(?<=\S) (?=\S)")
# The space in the byte-level alphabet
_SPACE = "\u0120"
SLICE = 1 << 23


def cut_text(text: str) -> list[str]:
    """The first chunk, then each further chunk without its leading space."""
    return _CUT.split(text) if _UNCLEAR.search(text) else text.split(" ")


def slices(texts: pa.Array) -> list[pa.Array]:
    """``texts`` in runs of about SLICE bytes (a longer text is a run of its own)."""
    texts = texts.fill_null("")
    run = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64)) // SLICE
    at = [0, *(np.flatnonzero(np.diff(run)) + 1), len(texts)]
    return [texts.slice(a, b - a) for a, b in zip(at, at[1:]) if b > a]


def coded(texts: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]:
    """The distinct further chunks of ``texts`` (without their space), their distinct first chunks, the place of each
    chunk of each text in the two, one after the other, and where each text's chunks begin."""
    parts = pc.split_pattern(texts, " ")
    unclear = np.flatnonzero(pc.match_substring_regex(texts, _UNCLEAR_RE2).to_numpy(zero_copy_only=False))
    if len(unclear):
        order = np.arange(len(texts))
        order[unclear] = len(texts) + np.arange(len(unclear))
        cut = pa.array([cut_text(texts[int(i)].as_py()) for i in unclear], parts.type)
        parts = pa.concat_arrays([parts, cut]).take(pa.array(order))
    starts = (ends := parts.offsets.to_numpy())[:-1] - ends[0]
    chunks = parts.flatten()
    rest, heads = chunks.dictionary_encode(), chunks.take(pa.array(starts)).dictionary_encode()
    codes = rest.indices.to_numpy().astype(np.int64)
    codes[starts] = heads.indices.to_numpy().astype(np.int64) + len(rest.dictionary)
    return rest.dictionary, heads.dictionary, codes, starts


class Recent(dict):
    """A dict that keeps what was used lately: when it has ``room`` entries it becomes the old generation."""

    def __init__(self, room: int):
        super().__init__()
        self.room, self.old = room, {}

    def find(self, x: str) -> bytes | None:
        if (known := self.get(x)) is None and (known := self.old.get(x)) is not None:
            self[x] = known
        return known

    def turn(self) -> None:
        if len(self) > self.room:
            self.old = dict(self)
            self.clear()


class ChunkCache:
    """Encodings (bytes) of recent chunks and, below them, of recent pre-tokens.

    ``encode_many`` turns a list of pre-tokens into a list of bytes.  A chunk that isn't known is split by the
    vocabulary's ``pattern``; a chunk or pre-token over ``longest`` characters isn't kept, so memory is bounded.
    """

    def __init__(self, encode_many: Callable[[list[str]], list[bytes]], pattern: str, chunks: int = 120_000,
                 words: int = 350_000, longest: int = 64):
        found = regex.compile(pattern)
        self.split = (lambda text: [m.group() for m in found.finditer(text)]) if found.groups else found.findall
        self.encode_many, self.longest, self.cuts = encode_many, longest, pattern == BYTE_LEVEL
        self.chunks, self.words = Recent(chunks), Recent(words)

    def _split_all(self, chunks: list[str]) -> list[bytes]:
        pieces = [self.split(c) for c in chunks]
        find, found, missing = self.words.find, {}, []
        for words in pieces:
            for w in words:
                if w not in found:
                    if (known := find(w)) is None:
                        missing.append(w)
                    found[w] = known
        if missing:
            for w, x in zip(missing, self.encode_many(missing)):
                found[w] = x
                if len(w) <= self.longest:
                    self.words[w] = x
            self.words.turn()
        return [b"".join([found[w] for w in words]) for words in pieces]

    def _find(self, chunks: list[str]) -> list[bytes]:
        """Encodings of distinct chunks, given without the space that they begin with."""
        out = list(map(self.chunks.find, chunks))
        missing = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(missing, self._split_all([" " + chunks[i] for i in missing])):
            out[i] = x
            if len(chunks[i]) <= self.longest:
                self.chunks[chunks[i]] = x
        self.chunks.turn()
        return out

    def _coded(self, texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Encodings of the distinct chunks of ``texts``, the place of each chunk of each text among them, and where
        each text's chunks begin (a text has one at least)."""
        if not self.cuts:
            whole = texts.dictionary_encode()
            return self._split_all(whole.dictionary.to_pylist()), whole.indices.to_numpy().astype(np.int64), np.arange(len(texts))
        rest, heads, codes, starts = coded(texts)
        return self._find(rest.to_pylist()) + self._split_all(heads.to_pylist()), codes, starts

    def count_all(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text; a null is the empty text."""
        out = [np.empty(0, np.int64)]
        for part in slices(texts):
            known, codes, starts = self._coded(part)
            sizes = np.array(list(map(len, known)), dtype=np.int64) // 4
            out.append(np.add.reduceat(sizes[codes], starts))
        return np.concatenate(out)

    def encode_all(self, texts: pa.Array, dtype: str = "<u4") -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the number of ids of each; a null is the empty text."""
        flat, counts = [np.empty(0, dtype)], [np.empty(0, np.int64)]
        for part in slices(texts):
            known, codes, starts = self._coded(part)
            sizes = np.array(list(map(len, known)), dtype=np.int64) // 4
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype("i4")
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(known), dtype)))
            flat.append(lists.take(pa.array(codes)).flatten().to_numpy())
            counts.append(np.add.reduceat(sizes[codes], starts))
        return np.concatenate(flat), np.concatenate(counts)

    def encode(self, text: str) -> bytes:
        head, *rest = cut_text(text) if self.cuts else [text]
        distinct = list(dict.fromkeys(rest))
        found = dict(zip(distinct, self._find(distinct)))
        return b"".join((self._split_all([head]) if head else []) + [found[w] for w in rest])


def _lists(counts: np.ndarray, ids: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(counts)]).astype("i4")
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, "<u4"), *ids])))


class RecentLists:
    """Texts and their ids as Arrow columns; the ``room`` texts used last are kept, of up to ``longest`` characters."""

    def __init__(self, make: Callable[[pa.Array], pa.Array], room: int, longest: int = 64):
        self.make, self.room, self.longest = make, room, longest
        self.texts, self.ids = pa.array([], pa.string()), pa.array([], pa.list_(pa.uint32()))

    def find(self, texts: pa.Array) -> pa.Array:
        """The ids of distinct ``texts``."""
        at = pc.index_in(texts, value_set=self.texts)
        new = at.is_null().to_numpy(zero_copy_only=False)
        place = at.fill_null(0).to_numpy().astype(np.int64)
        place[new] = len(self.texts) + np.arange(new.sum())
        out = pa.concat_arrays([self.ids, self.make(texts.filter(pa.array(new)))]).take(pa.array(place))
        unused = np.ones(len(self.texts), bool)
        unused[place[~new]] = False
        unused = pa.array(np.flatnonzero(unused))
        short = pc.less_equal(pc.utf8_length(texts), self.longest)
        # those used now go first, so what falls off the end was not used for longest
        self.texts, self.ids = (pa.concat_arrays([now.filter(short), before.take(unused)])[:self.room]
                                for now, before in ((texts, self.texts), (out, self.ids)))
        return out


class ChunkTable:
    """Encodings of texts by a tokenizers library's Tokenizer with the byte-level pre-tokenizer and no normalizer.

    Distinct chunks are cut into stem, tail and last line's word where pre-tokens end anyway, and recent ones of each
    kind are kept.  A stem or word of ASCII letters is one pre-token and goes to the library's model (in the byte-level
    alphabet these letters stand for themselves); all else, and the first chunks of texts, to the library as it stands.
    What is kept are Arrow columns, so memory is small and bounded.
    """

    def __init__(self, tok, room: int = 500_000):
        self.tok = tok
        self.stems, self.lines = RecentLists(self._stems, room), RecentLists(lambda x: self._words(x, ""), room)
        self.tails = RecentLists(lambda x: self._alone(x.to_pylist()), 100_000)

    def _alone(self, texts: list[str]) -> pa.Array:
        found = [np.array(self.tok.encode(x, add_special_tokens=False).ids, dtype="<u4") for x in texts]
        return _lists(np.array(list(map(len, found)), dtype=np.int64), found)

    def _words(self, words: pa.Array, before: str) -> pa.Array:
        """Encodings of words of ASCII letters, with ``before`` in front."""
        model = self.tok.model.tokenize
        found = [[t.id for t in model(before + w)] for w in words.to_pylist()]
        return _lists(np.array(list(map(len, found)), dtype=np.int64), [np.array([i for x in found for i in x], dtype="<u4")])

    def _stems(self, texts: pa.Array) -> pa.Array:
        plain = pc.match_substring_regex(texts, "^[A-Za-z]+$").to_numpy(zero_copy_only=False)
        order = np.empty(len(texts), np.int64)
        order[np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])] = np.arange(len(texts))
        return pa.concat_arrays([self._words(texts.filter(pa.array(plain)), _SPACE), self._alone(
            [" " + x for x in texts.filter(pa.array(~plain)).to_pylist()])]).take(pa.array(order))

    def _find(self, chunks: pa.Array) -> pa.Array:
        """Encodings of distinct chunks, given without the space that they begin with."""
        cut = pc.extract_regex(chunks, _STEM_RE2)
        part = lambda x, name: pc.struct_field(x, name)
        stems = pc.if_else(cut.is_valid(), part(cut, "stem"), chunks).dictionary_encode()
        tails = part(cut, "tail").fill_null("").dictionary_encode()
        rest = pc.extract_regex(tails.dictionary, _LINE_RE2)
        lines = part(rest, "line").fill_null("").dictionary_encode()
        rest = pc.if_else(rest.is_valid(), part(rest, "tail"), tails.dictionary).dictionary_encode()
        words = lines.dictionary.filter(pc.not_equal(lines.dictionary, ""))
        known = pa.concat_arrays([self.stems.find(stems.dictionary), self.tails.find(rest.dictionary),
                                  self.lines.find(words), pa.array([[]], pa.list_(pa.uint32()))])
        n_stems, n_rest = len(stems.dictionary), len(rest.dictionary)
        word = pc.index_in(lines.dictionary, value_set=words).fill_null(len(words)).to_numpy().astype(np.int64)
        of = tails.indices.to_numpy()
        codes = np.stack([stems.indices.to_numpy().astype(np.int64), n_stems + rest.indices.to_numpy().astype(np.int64)[of],
                          n_stems + n_rest + word[lines.indices.to_numpy()][of]], axis=1)
        known = known.take(pa.array(codes.ravel()))
        return pa.ListArray.from_arrays(pa.array(known.offsets.to_numpy()[::3]), known.values)

    def _coded(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        rest, heads, codes, starts = coded(texts)
        return pa.concat_arrays([self._find(rest), self._alone(heads.to_pylist())]), codes, starts

    def count_all(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text; a null is the empty text."""
        out = [np.empty(0, np.int64)]
        for part in slices(texts):
            known, codes, starts = self._coded(part)
            out.append(np.add.reduceat(known.value_lengths().to_numpy().astype(np.int64)[codes], starts))
        return np.concatenate(out)

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the number of ids of each; a null is the empty text."""
        flat, counts = [np.empty(0, "<u4")], [np.empty(0, np.int64)]
        for part in slices(texts):
            known, codes, starts = self._coded(part)
            flat.append(known.take(pa.array(codes)).flatten().to_numpy())
            counts.append(np.add.reduceat(known.value_lengths().to_numpy().astype(np.int64)[codes], starts))
        return np.concatenate(flat), np.concatenate(counts)
