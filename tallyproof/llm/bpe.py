"""BPE encoding and decoding with content-defined chunk reuse.

Texts are cut into chunks where a rolling hash over two consecutive words says so, so copies and
shared passages are cut alike wherever they stand. Every executor process encodes a chunk once and
keeps it in a bounded memory; a chunk met for the first time is put together from its words, each
of which is encoded once too. Words and chunks are known by two 64-bit hashes over their bytes, and
ids and texts lie in flat arrays, from which those of a whole block are taken at once.

Joins. White space ends every pre-token of this family of vocabularies, no pattern looks across it
and normalization never composes with it, so pieces that meet at ASCII white space agree with the
whole text. Longer runs without white space are cut by a rolling hash over their characters; their
joins are repaired: the last pre-tokens on the left and the first on the right are encoded anew
together, over a window that grows until its pre-token boundary agrees with that of the right piece.

ASCII text is normalized by lower case alone, and a run of letters is one pre-token. Where the
vocabulary's settings are the known ones, such pieces go to copies of the tokenizer without the steps
that would not change them, and closing punctuation is cut off, as a pre-token ends there.

Memory is kept per process and not shared between executors: sharing chunks across the cluster
would move every text twice, which costs more than encoding it. Losing an executor loses nothing.

Defined results: a null text is an empty one and has no ids. Repeated rows are encoded each.
Input columns named ``ids`` or ``decoded`` are replaced.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyproof.llm.common import blocks, fields, mapped, table, utf8, without
from tallyproof.llm.words import span_hashes, sums, windows, words

# A chunk ends after a pair of words whose hash is a multiple of this: about as many words.
CHUNK_WORDS = 32
# Runs without white space beyond so many characters are cut and repaired; mean length of a cut.
LONG_RUN, RUN_CUT = 2048, 512
# Entries of each memory.
WORDS_KEPT, PIECES_KEPT, CHUNKS_KEPT = 250_000, 200_000, 10_000
# The settings for which the short cuts of ASCII text hold.
NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
CLOSING = ".,;:!?"


class Flat:
    """Runs of numbers in one growing array."""

    def __init__(self, kind: type):
        self.values, self.edges = np.empty(1 << 12, kind), np.zeros(1 << 10, np.int64)
        self.runs = 0

    def add(self, values: np.ndarray, size: np.ndarray) -> None:
        used, end = int(self.edges[self.runs]), int(self.edges[self.runs]) + len(values)
        if end > len(self.values):
            self.values = np.concatenate([self.values[:used], np.empty(2 * end - used, self.values.dtype)])
        self.values[used:end] = values
        last = self.runs + len(size)
        if last >= len(self.edges):
            self.edges = np.concatenate([self.edges, np.zeros(2 * last + 1 - len(self.edges), np.int64)])
        self.edges[self.runs + 1 : last + 1] = used + np.cumsum(size)
        self.runs = last

    def take(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of the given runs in a row, and the size of each run."""
        start = self.edges[runs]
        size = self.edges[runs + 1] - start
        before = np.cumsum(size) - size
        return self.values[np.arange(int(size.sum())) + np.repeat(start - before, size)], size


class Memory:
    """Ids and decoded text by key, in flat arrays; each decoded part ends in a space.

    Keys are 64-bit hashes that are told apart by a second, independent one, or strings. When more
    than ``most`` entries are held at the start of a block, the half used last stays.
    """

    def __init__(self, most: int):
        self.most, self.tick = most, 0
        self.clear()

    def clear(self) -> None:
        self.place: dict = {}
        self.check, self.used = np.zeros(1 << 10, np.uint64), np.zeros(1 << 10, np.int64)
        self.ids, self.text = Flat(np.uint32), Flat(np.uint8)

    def next_block(self) -> None:
        self.tick += 1
        n = self.ids.runs
        if n > self.most:
            # entries of one tick stay or go together, so half of them at the most is kept
            used = self.used[:n]
            kept = np.flatnonzero(used > np.partition(used, n // 2)[n // 2])
            keys = np.empty(n, object)
            keys[list(self.place.values())] = list(self.place)
            keys, check, ticks = keys[kept].tolist(), self.check[kept], used[kept]
            ids, text = self.ids.take(kept), self.text.take(kept)
            self.clear()
            self.add(keys, check, ids, text)
            self.used[: len(ticks)] = ticks

    def find(self, keys: list, check: np.ndarray | None = None) -> np.ndarray:
        """Place of each key, or -1."""
        found = np.fromiter(map(self.place.get, keys, repeat(-1)), np.int64, len(keys))
        if check is not None:
            found[(found >= 0) & (self.check[found] != check)] = -1
        self.used[found[found >= 0]] = self.tick
        return found

    def add(self, keys: list, check: np.ndarray | None, ids: tuple, text: tuple) -> np.ndarray:
        """Places of new entries, given the values and sizes of their ids and texts."""
        first, last = self.ids.runs, self.ids.runs + len(keys)
        if last > len(self.check):
            more = np.zeros(2 * last - len(self.check), np.int64)
            self.check, self.used = np.concatenate([self.check, more.astype(np.uint64)]), np.concatenate([self.used, more])
        self.check[first:last] = 0 if check is None else check
        self.used[first:last] = self.tick
        self.place.update(zip(keys, range(first, last), strict=True))
        self.ids.add(*ids)
        self.text.add(*text)
        return np.arange(first, last)

    def joined(self, places: np.ndarray, count: np.ndarray) -> tuple[tuple, tuple]:
        """Ids and texts of ``count`` entries each in a row."""
        edge = np.concatenate([[0], np.cumsum(count)])
        out = []
        for flat in (self.ids, self.text):
            values, size = flat.take(places)
            total = np.concatenate([[0], np.cumsum(size)])
            out.append((values, np.diff(total[edge])))
        return out[0], out[1]


class Encoder:
    """A tokenizer with its memories; one per process and vocabulary."""

    made: dict[str, Encoder] = {}

    def __init__(self, text: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_str(text)
        self.suffix = self.lib.model.end_of_word_suffix
        added = self.lib.get_added_tokens_decoder()
        self.special = set(added)
        self.reach = max([4, *(len(t.content) for t in added.values())])
        self.words, self.pieces, self.chunks = Memory(WORDS_KEPT), Memory(PIECES_KEPT), Memory(CHUNKS_KEPT)
        parts = json.loads(text)
        steps = (parts.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        self.known = (parts.get("normalizer") or {}).get("normalizers") == NORMALIZERS and steps[0].get("pattern") == {"Regex": SPLIT}
        parts["normalizer"] = None
        self.lower = Tokenizer.from_str(json.dumps(parts)) if self.known else self.lib
        parts["pre_tokenizer"] = None
        self.letters = Tokenizer.from_str(json.dumps(parts)) if self.known else self.lib

    @classmethod
    def of(cls, text: str) -> Encoder:
        key = hashlib.sha256(text.encode()).hexdigest()
        if key not in cls.made:
            cls.made[key] = cls(text)
        return cls.made[key]

    def units(self, text: str, at: int = 0) -> list[tuple[int, int, list[int]]]:
        """Pre-tokens of ``text`` as start, end and ids; offsets count from ``at``. Pre-tokens that
        share a character, as its lower case may have two, are one unit."""
        out: list[tuple[int, int, list[int]]] = []
        closed = True
        found = self.lib.encode(text, add_special_tokens=False)
        for token, i, (a, b) in zip(found.tokens, found.ids, found.offsets, strict=True):
            if out and (not closed or at + a < out[-1][1]):
                start, end, ids = out[-1]
                out[-1] = (start, max(end, at + b), [*ids, i])
            else:
                out.append((at + a, at + b, [i]))
            closed = not self.suffix or token.endswith(self.suffix) or i in self.special
        return out

    def run(self, text: str) -> list[int]:
        """Ids of a run without white space, put together from repaired chunks."""
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
        rolled = windows(points, 8)
        cuts = [0, *(np.flatnonzero(rolled % np.uint64(RUN_CUT) == 0) + 8).tolist(), len(text)]
        left: list[tuple[int, int, list[int]]] = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a < b:
                left = self.joined(text, left, self.units(text[a:b], a), a, b)
        return [i for unit in left for i in unit[2]]

    def joined(self, text: str, left: list, right: list, cut: int, end: int) -> list:
        """``left`` and ``right`` as one, the join encoded anew until both sides agree on it.

        What a pre-token is depends on no more than ``reach`` characters around it, so units that
        end before that on the left stand, and a boundary that both sides see with so much text
        behind it is one of the whole text.
        """
        if not left:
            return right
        n = len(left)
        while n and left[n - 1][1] > cut - self.reach:
            n -= 1
        kept, start = left[:n], left[n][0] if n < len(left) else cut
        for i, unit in enumerate(right):
            far = next((r[1] for r in right[i + 1 :] if r[1] >= unit[1] + self.reach), None)
            if far is None:
                break
            window = self.units(text[start:far], start)
            for k in range(len(window) - 1):
                if window[k][1] == unit[1] and window[k + 1][0] == right[i + 1][0]:
                    return kept + window[: k + 1] + right[i + 1 :]
        return kept + self.units(text[start:end], start)

    def split(self, word: str) -> tuple[str, ...]:
        """Pieces of a word that may be encoded apart; those of ASCII words in lower case."""
        if not self.known or not word.isascii() or "<|" in word:
            return (word,)
        word = word.lower()
        body = word.rstrip(CLOSING)
        if not body or not body[-1].isalpha():
            body = word
        return (body,) if len(body) == len(word) else (body, word[len(body) :])

    def learn_pieces(self, pieces: list[str]) -> None:
        """Encode pieces that are not in memory, each by the shortest way that is exact."""
        ways: dict[str, list[str]] = {"long": [], "letters": [], "lower": [], "lib": []}
        for piece in pieces:
            if len(piece) > LONG_RUN:
                ways["long"].append(piece)
            elif not self.known or not piece.isascii() or "<|" in piece:
                ways["lib"].append(piece)
            else:
                ways["letters" if piece.isalpha() else "lower"].append(piece)
        for way, found in ways.items():
            if way == "long":
                ids = [self.run(p) for p in found]
            else:
                ids = [x.ids for x in getattr(self, way).encode_batch_fast(found, add_special_tokens=False)]
            texts = [t.encode() + b" " if i else b"" for i, t in zip(ids, self.lib.decode_batch(ids, skip_special_tokens=False), strict=True)]
            size = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum()))
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            self.pieces.add(found, None, (flat, size), (np.frombuffer(b"".join(texts), np.uint8), lengths))

    def learn(self, words: list[bytes], keys: list[int], check: np.ndarray) -> np.ndarray:
        """Places of new words, put together from their pieces."""
        split = [self.split(w.decode()) for w in words]
        pieces = list(chain.from_iterable(split))
        unknown = dict.fromkeys(pieces)
        places = self.pieces.find(list(unknown))
        self.learn_pieces([p for p, k in zip(unknown, places.tolist(), strict=True) if k < 0])
        parts = self.pieces.joined(self.pieces.find(pieces), np.fromiter(map(len, split), np.int64, len(split)))
        return self.words.add(keys, check, *parts)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], list[bytes]]:
        """Ids as little-endian 32-bit integers and decoded text of each row of a buffer."""
        for memory in (self.pieces, self.words, self.chunks):
            memory.next_block()
        w = words(data, offsets)
        n = len(w.start)
        if not n:
            empty = [b""] * (len(offsets) - 1)
            return empty, empty
        other = span_hashes(255 - data, w.start, w.end)
        first = np.ones(n, bool)
        first[1:] = w.row[1:] != w.row[:-1]
        pairs = windows(w.hash, 2)
        first[2:] |= pairs[:-1] % np.uint64(CHUNK_WORDS) == 0
        at = np.flatnonzero(first)
        end = np.append(at[1:], n)
        # chunks of this block, each once, and of those the new ones
        keys, some, which = np.unique(sums(w.hash)(at, end), return_index=True, return_inverse=True)
        check = sums(other)(at, end)[some]
        places = self.chunks.find(keys.tolist(), check)
        new = np.flatnonzero(places < 0)
        if len(new):
            low, count = at[some[new]], (end - at)[some[new]]
            inside = np.arange(int(count.sum())) + np.repeat(low - (np.cumsum(count) - count), count)
            word, one, of = np.unique(w.hash[inside], return_index=True, return_inverse=True)
            one = inside[one]
            found = self.words.find(word.tolist(), other[one])
            lacking = np.flatnonzero(found < 0)
            if len(lacking):
                raw, spot = data.tobytes(), one[lacking]
                own = [raw[a:b] for a, b in zip(w.start[spot].tolist(), w.end[spot].tolist(), strict=True)]
                found[lacking] = self.learn(own, word[lacking].tolist(), other[spot])
            places[new] = self.chunks.add(keys[new].tolist(), check[new], *self.words.joined(found[of], count))
        per_row = np.bincount(w.row[at], minlength=len(offsets) - 1)
        (ids, n_ids), (text, n_text) = self.chunks.joined(places[which], per_row)
        ids, text = ids.astype("<u4").tobytes(), text.tobytes()
        out = []
        for values, size, tail in ((ids, n_ids * 4, 0), (text, n_text, 1)):
            edge = np.concatenate([[0], np.cumsum(size)]).tolist()
            # the last part of a text ends in no space
            out.append([values[a : max(a, b - tail)] for a, b in zip(edge[:-1], edge[1:], strict=True)])
        return out[0], out[1]


def encoded(docs: DataFrame, tokenizer: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded``.

    ``tokenizer`` is the path of a vocabulary file of a few megabytes; its content is broadcast, so
    executors need not see the file.
    """
    with open(tokenizer, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    chosen = docs.select(*without(docs, "ids", "decoded"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(content.value)
        for batch in batches:
            data, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
            for i, j in blocks(offsets):
                ids, back = encoder.encode(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                columns = [*batch.slice(i, j - i).columns, pa.array(ids, pa.binary()), pa.array(back, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "ids", "decoded"])

    return mapped(chosen, work, f"{fields(chosen)}, ids binary, decoded string")


def digests(docs: DataFrame, *keep: str) -> DataFrame:
    return docs.select(
        *keep,
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return digests(encoded(docs, vocabulary()), "doc_id")


def encode_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Last pipeline stage: ids of every document."""
    return digests(encoded(docs, vocabulary()), "doc_id", "lang", "source")
