"""Token counts by a finite-state transducer compiled from a vocabulary.

A merge tokenizer with ranked pieces has one tokenization in which every two neighbours stand when
they are tokenized by themselves. So the tokens of a longer text follow from a bounded memory: the
places from which a piece may still go on, the last token before each of them, and how many tokens
each is ahead of the others. Such memories are the states of a deterministic transducer. A
transition reads one character and emits the tokens that no continuation can take back, those that
all open places have in common; what is owed beyond them is a number of the state.

States and transitions are compiled when they are met first and kept in a hash table of integers; a
table that has grown beyond a bound is emptied between two blocks. Only the question whether two
pieces stand next to each other goes to the library, once per pair and in batches.

Texts are cut into chunks, and all chunks of a block advance together, one character a step. A
chunk's map takes the state before it to the state behind it and a count. Where no piece crosses a
word start, the map past the first word start of a chunk is constant; so a chunk is cut there, and
only its head waits for the state before it. Chunks inside one long word have no such place: their
maps are tabulated at the states that reach them, first at a guess, until every state that leaves a
chunk is found in the table of the next. The maps are then composed by pointer doubling, a parallel
prefix scan in which every step joins neighbouring runs of chunks.

Defined results: a null text is an empty one and has no tokens and no bytes. Repeated rows are counted
each. An empty table gives an empty one. Input columns named like an output column are replaced.
Vocabularies that normalize texts, have user-defined pieces or lack characters of their pieces are
refused. Memory of a task grows with its longest text, about 100 bytes per character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyproof.llm.common import blocks, fields, mapped, table, utf8, without
from tallyproof.llm.words import code_points

LIMIT = 4096
# Characters of a chunk, bytes of a block of texts.
CHUNK, BLOCK_BYTES = 96, 1 << 19
# Transitions beyond which the tables are emptied before the next block.
MOST = 1 << 20
SPACE, MARK = 0x20, 0x2581
MIX = np.uint64(0x9E3779B97F4A7C15)
# Bits of a code point in a key, and of a state in a cell.
BITS, STATE_BITS = 21, 40


class Vocabulary:
    """Pieces of a model as a trie over code points, and the library's word on pairs of pieces."""

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto()
        spec.ParseFromString(model)
        kinds = proto.ModelProto.SentencePiece
        plain = not spec.normalizer_spec.precompiled_charsmap and not spec.normalizer_spec.remove_extra_whitespaces
        simple = all(p.type in (kinds.NORMAL, kinds.UNKNOWN, kinds.CONTROL, kinds.BYTE) for p in spec.pieces)
        if spec.trainer_spec.model_type != proto.TrainerSpec.BPE or not plain or not simple or not spec.trainer_spec.byte_fallback:
            raise ValueError("only merge models with byte fallback that leave texts as they are can be compiled")
        self.lead = [MARK] if spec.normalizer_spec.add_dummy_prefix else []
        # the same pieces without a mark before the text, to ask about pieces inside it
        spec.normalizer_spec.add_dummy_prefix = False
        self.library = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())
        self.text = {i: p.piece for i, p in enumerate(spec.pieces) if p.type == kinds.NORMAL}
        self.child: dict[int, int] = {}
        self.token, self.inner = [-1], [False]
        self.leading: set[str] = set()
        for i, piece in self.text.items():
            self.add(i, piece)
        if not self.leading <= set(self.text.values()) or not {c for p in self.text.values() for c in p} <= set(self.text.values()):
            raise ValueError("a piece holds a character that is no piece")
        # a mark after another character is in no piece: every word starts anew
        self.parts_words = not any("▁" in p.lstrip("▁") for p in self.text.values())
        self.pairs: dict[tuple[int, int], bool] = {}

    def add(self, number: int, piece: str) -> None:
        node = 0
        for c in piece:
            key = node << BITS | ord(c)
            if key not in self.child:
                self.child[key] = len(self.token)
                self.token.append(-1)
                self.inner.append(False)
                self.inner[node] = True
            node = self.child[key]
        self.token[node] = number
        self.leading.update(piece[:-1])

    def ask(self, pairs: set[tuple[int, int]]) -> None:
        """Whether two pieces stay as they are next to each other."""
        new = [p for p in pairs if p not in self.pairs]
        found = self.library.encode([self.text[a] + self.text[b] for a, b in new], num_threads=1) if new else []
        self.pairs.update((p, ids == list(p)) for p, ids in zip(new, found, strict=True))


class Machine:
    """The transducer as far as it is compiled. State 0 is the start of a word."""

    made: dict[int, Machine] = {}

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.clear()

    @classmethod
    def of(cls, model: bytes) -> Machine:
        key = hash(model)
        if key not in cls.made:
            cls.made[key] = cls(Vocabulary(model))
        return cls.made[key]

    def clear(self) -> None:
        # a state: open places (trie node, last token before, tokens ahead) and whether a mark was read
        start = (((0, -1, 0),), True)
        self.states, self.number = [start], {start: 0}
        self.owed = np.zeros(1 << 12, np.int64)
        self.used = 0
        self.vocabulary.pairs.clear()
        self.resize(1 << 14)

    def resize(self, size: int) -> None:
        old, self.cells = getattr(self, "cells", None) if self.used else None, np.full((size, 2), -1, np.int64)
        if old is not None:
            self.insert(old[old[:, 0] >= 0])

    def slots(self, keys: np.ndarray) -> np.ndarray:
        shift = np.uint64(64 - (len(self.cells).bit_length() - 1))
        return ((keys.astype(np.uint64) * MIX) >> shift).astype(np.int64)

    def taken(self, at: np.ndarray) -> np.ndarray:
        # a cell is 16 bytes, which numpy copies at once when it takes them for one number
        return self.cells.view(np.complex128)[:, 0].take(at).view(np.int64).reshape(-1, 2)

    def insert(self, cells: np.ndarray) -> None:
        at, left = self.slots(cells[:, 0]), np.arange(len(cells))
        while len(left):
            spot = at[left]
            free = self.cells[spot, 0] == -1
            self.cells[spot[free]] = cells[left[free]]
            # of several keys for one slot the last was written
            left = left[self.cells[spot, 0] != cells[left, 0]]
            at[left] = (at[left] + 1) & (len(self.cells) - 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """States behind the transitions and what they emit in one number; new ones are compiled."""
        at = self.slots(keys)
        found = self.taken(at)
        other = np.flatnonzero(found[:, 0] != keys)
        new = []
        while len(other):
            empty = found[other, 0] == -1
            if empty.any():
                new.append(other[empty])
                other = other[~empty]
            at[other] = (at[other] + 1) & (len(self.cells) - 1)
            found[other] = self.taken(at[other])
            other = other[found[other, 0] != keys[other]]
        if new:
            self.compile(np.unique(keys[np.concatenate(new)]))
            return self.find(keys)
        return found[:, 1]

    def compile(self, keys: np.ndarray) -> None:
        v, moves, pairs = self.vocabulary, [], set()
        for key in keys.tolist():
            point = key & (1 << BITS) - 1
            places, mark = self.states[key >> BITS]
            if v.parts_words and point == MARK and not mark:
                places = ((0, -1, places[-1][2]),)
            grown = [(v.child.get(node << BITS | point), last, ahead) for node, last, ahead in places]
            grown = [g for g in grown if g[0] is not None]
            moves.append((point, places, grown))
            pairs.update((last, v.token[node]) for node, last, _ in grown if last >= 0 and v.token[node] >= 0)
        v.ask(pairs)
        following, emits = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
        for k, (point, places, grown) in enumerate(moves):
            ends = [(v.token[node], ahead + 1) for node, last, ahead in grown if v.token[node] >= 0 and (last < 0 or v.pairs[last, v.token[node]])]
            if len(ends) == 1:
                token, ahead = ends[0]
                # a token whose last character never goes on inside a piece stands next to any other
                token = token if v.text[token][-1] in v.leading else -1
            elif not grown and not ends:
                token, ahead = -1, places[-1][2] + len(chr(point).encode())
            else:
                raise RuntimeError(f"{len(ends)} tokenizations where there is one")
            still = [g for g in grown if v.inner[g[0]]]
            least = min([ahead, *[g[2] for g in still]])
            state = tuple((node, last, a - least) for node, last, a in still), (0, token, ahead - least)
            following[k] = self.state_of(((*state[0], state[1]), point == MARK))
            emits[k] = least - min(p[2] for p in self.states[int(keys[k]) >> BITS][0])
        while 2 * (self.used + len(keys)) > len(self.cells):
            self.resize(2 * len(self.cells))
        self.insert(np.column_stack([keys, emits << STATE_BITS | following]))
        self.used += len(keys)

    def state_of(self, state: tuple) -> int:
        n = self.number.setdefault(state, len(self.states))
        if n == len(self.states):
            self.states.append(state)
            if n >= len(self.owed):
                self.owed = np.concatenate([self.owed, np.zeros(len(self.owed), np.int64)])
            self.owed[n] = state[0][-1][2]
        return n

    def run(self, points: np.ndarray, start: np.ndarray, end: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """State and emitted tokens behind each chunk, all chunks advancing together."""
        order = np.argsort(start - end, kind="stable")
        at, now = start[order], state[order].astype(np.int64)
        length = (end - start)[order]
        count = np.zeros(len(order), np.int64)
        # chunks that are still running are the first ones of the order
        running = len(order) - np.searchsorted(length[::-1], np.arange(int(length[0]) if len(length) else 0), "right")
        for step, n in enumerate(running.tolist()):
            found = self.find(now[:n] << BITS | points[at[:n] + step])
            now[:n] = found & (1 << STATE_BITS) - 1
            count[:n] += found >> STATE_BITS
        out, total = np.empty_like(now), np.empty_like(count)
        out[order], total[order] = now, count
        return out, total

    def counts(self, points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of the texts that ``offsets`` cuts out of ``points``, marks for spaces in place."""
        if self.used > MOST:
            self.clear()
        texts = np.flatnonzero(np.diff(offsets))
        out = np.zeros(len(offsets) - 1, np.int64)
        if not len(texts):
            return out
        first = np.zeros(len(points), bool)
        first[offsets[texts]] = True
        word = first.copy()
        if self.vocabulary.parts_words:
            word[1:] |= (points[1:] == MARK) & (points[:-1] != MARK)
        inside = np.arange(len(points)) - np.repeat(offsets[texts], np.diff(offsets)[texts])
        chunk = np.flatnonzero(inside % CHUNK == 0)
        words = np.flatnonzero(word)
        at = np.searchsorted(words, chunk)
        ends = np.append(chunk[1:], len(points))
        heads = words[np.minimum(at, len(words) - 1)]
        cut = np.unique(np.concatenate([chunk, heads[(heads >= chunk) & (heads < ends)]]))
        close = np.append(cut[1:], len(points))
        known = word[cut]
        last = np.append(first[cut[1:]], True)
        total = self.scanned(points, cut, close, known, last)
        out[texts] = total[first[cut]]
        return out

    def scanned(self, points: np.ndarray, cut: np.ndarray, close: np.ndarray, known: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Tokens from the start of each chunk to the end of its text (meant for known chunks).

        ``known``: the chunk starts a word, so its map is constant; ``last``: it ends a text.
        """
        n = len(cut)
        # rows of the tables: chunk, state before, state behind, tokens
        part, before = np.flatnonzero(known), np.zeros(int(known.sum()), np.int64)
        after, count = self.run(points, cut[part], close[part], before)
        # guess the start of a word for chunks behind chunks whose own start is not known
        behind = np.append(False, ~known[:-1]) & ~known
        goes_on = ~last & np.append(~known[1:], False)
        new_part, new_state = np.flatnonzero(behind), np.zeros(int(behind.sum()), np.int64)
        key = part << 32 | before
        while True:
            follow = part[goes_on[part]] + 1
            wanted = np.unique(np.concatenate([follow << 32 | after[goes_on[part]], new_part << 32 | new_state]))
            new = wanted[~np.isin(wanted, key)]
            if not len(new):
                break
            new_part, new_state = new >> 32, new & 0xFFFFFFFF
            more, tokens = self.run(points, cut[new_part], close[new_part], new_state)
            part, after, count = np.append(part, new_part), np.append(after, more), np.append(count, tokens)
            key = np.append(key, new)
            new_part = new_state = np.empty(0, np.int64)
        order = np.argsort(key, kind="stable")
        key, part, after, count = key[order], part[order], after[order], count[order]
        # each row goes on to the row of the next chunk for its state behind, or to none
        state = np.where(goes_on[part], after, 0)
        follows = np.searchsorted(key, (part + 1) << 32 | state)
        follows = np.where(last[part], len(key), np.minimum(follows, len(key)))
        total = count + np.where(goes_on[part], 0, self.owed[after])
        total, follows = np.append(total, 0), np.append(follows, len(key))
        while (follows < len(key)).any():
            total = total + total[follows]
            follows = follows[follows]
        out = np.zeros(n, np.int64)
        begin = np.searchsorted(key, np.arange(n) << 32)
        out[known] = total[begin[known]]
        return out


def marked(data: np.ndarray, offsets: np.ndarray, lead: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts with marks for spaces and ``lead`` before each text with any."""
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
    points[points == SPACE] = MARK
    cuts = code_points(data)[offsets]
    size = np.diff(cuts)
    points = np.insert(points, np.repeat(cuts[:-1][size > 0], len(lead)), np.tile(lead, int((size > 0).sum())))
    return points, np.concatenate([[0], np.cumsum(size + len(lead) * (size > 0))])


def counted(docs: DataFrame, model: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit``.

    ``model`` is the path of a vocabulary file of a few megabytes; its content is broadcast, so
    executors need not see the file.
    """
    with open(model, "rb") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    chosen = docs.select(*without(docs, "n_bytes", "n_tokens", "over_limit"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine.of(content.value)
        for batch in batches:
            data, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
            found = []
            for i, j in blocks(offsets, BLOCK_BYTES):
                points, cuts = marked(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], machine.vocabulary.lead)
                found.append(machine.counts(points, cuts))
            tokens = np.concatenate(found) if found else np.empty(0, np.int64)
            columns = [*batch.columns, pa.array(np.diff(offsets)), pa.array(tokens), pa.array(tokens > limit)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "n_bytes", "n_tokens", "over_limit"])

    return mapped(chosen, work, f"{fields(chosen)}, n_bytes bigint, n_tokens bigint, over_limit boolean")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return counted(docs, vocabulary()).select("doc_id", F.col("n_bytes"), F.col("n_tokens"), F.col("over_limit"))
