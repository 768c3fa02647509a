"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

The encoder keeps the symbols of all words of a batch in one flat numpy array. In each round it
looks up the rank of every neighbouring pair, takes the minimum per word (a segmented reduction),
merges all occurrences of that pair from the left at once, and compacts the arrays; words
without a pair left drop out. A word here is a run of space symbols with the run of others after it: no
piece has a space symbol after another symbol (checked when the model is loaded), so words never interact.

Merging all occurrences at once equals the library's one-at-a-time order as long as the merged
symbol forms no pair of the same or a better rank. Pieces that do are marked when the model is
loaded. A word whose best pair is so marked merges its leftmost occurrence only; where
such a word is long, a heap does the same in O(n log n).

Cases: null text is encoded as the empty text, which has no ids; repeated rows get equal ids;
extra columns are kept; one named like an output column is replaced. Pairs of equal rank (a tie) merge
from the left, as in the library. A text of any length is encoded whole, and an empty table gives no rows.
"""

from __future__ import annotations

import functools
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, columns, ddl, others

SPACE = "▁"
_NONE = np.int64(1 << 40)
#: Words kept with their ids in each Python worker: so many of late and as many from before.
CACHE_WORDS = 100_000
#: From so many symbols on, a word with a marked pair goes to the heap.
HEAP_FROM = 48


class Vocabulary:
    """The tables of a SentencePiece BPE model: ranks of pairs, characters, bytes."""

    def __init__(self, model: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.special = np.array([sp.is_control(i) or sp.is_unknown(i) for i in range(n)])
        self.unknown = sp.unk_id()
        self.byte = np.full(256, -1)
        self.byte_of = np.full(n, -1)
        for i in range(n):
            if sp.is_byte(i):
                self.byte_of[i] = int(self.pieces[i][3:5], 16)
                self.byte[self.byte_of[i]] = i
        normal = [i for i in range(n) if not (self.special[i] or sp.is_byte(i))]
        if any(sp.is_unused(i) for i in normal):
            raise ValueError("models with unused pieces aren't supported")
        self.id_of = {self.pieces[i]: i for i in normal}
        if any(SPACE in p.lstrip(SPACE) for p in self.id_of):
            raise ValueError("a piece has a space symbol after another symbol")
        if sp.encode("a  b ") and sp.decode(sp.encode("a  b ")) != "a  b " or sp.encode("ﬁ") == sp.encode("fi"):
            raise ValueError("models that normalise texts aren't supported")
        scores = np.array([sp.get_score(i) for i in range(n)])
        order = np.unique(-scores[normal])
        rank = np.full(n, _NONE)
        rank[normal] = np.searchsorted(order, -scores[normal])
        self.rank = rank
        # Symbols: ids below n are pieces; a character that is no piece gets n + its code point and never merges.
        pairs: dict[int, int] = {}
        marked = np.zeros(n, bool)
        for p, i in self.id_of.items():
            for k in range(1, len(p)):
                a, b = self.id_of.get(p[:k], -1), self.id_of.get(p[k:], -1)
                if a >= 0 and b >= 0:
                    pairs[(a << 32) | b] = i
                for half in (a, b):
                    if half >= 0 and rank[i] <= rank[half]:
                        marked[half] = True
        for p in list(self.id_of):
            if any(c not in self.id_of for c in p) and len(p) > 1:
                # Merges between a character that is no piece and others need symbols of their own; SentencePiece trains none.
                raise ValueError("a piece has a character that is no piece")
        keys = np.fromiter(pairs, np.int64, len(pairs))
        at = np.argsort(keys)
        self.pair_key, self.pair_id = keys[at], np.fromiter(pairs.values(), np.int64, len(pairs))[at]
        # Open hashing with a fixed table makes a lookup a few array reads.
        self.bits = max(8, int(len(keys) * 8).bit_length())
        slot = self._slot(self.pair_key)
        first = np.zeros((1 << self.bits) + 1, np.int64)
        np.add.at(first, slot + 1, 1)
        by_slot = np.argsort(slot, kind="stable")
        self.slot_start = np.cumsum(first)
        self.slot_key, self.slot_id = np.append(self.pair_key[by_slot], -1), np.append(self.pair_id[by_slot], -1)
        self.depth = int(first.max())
        self.marked = marked
        self.char_symbol = n + np.arange(0x110000, dtype=np.int64)
        for c, i in self.id_of.items():
            if len(c) == 1:
                self.char_symbol[ord(c)] = i
        self.n = n
        self.piece_bytes = [b"" if self.special[i] and i != self.unknown else p.replace(SPACE, " ").encode() for i, p in enumerate(self.pieces)]
        if self.unknown >= 0:
            self.piece_bytes[self.unknown] = " ⁇ ".encode()

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols makes, or -1."""
        key = (a << 32) | b
        slot = self._slot(key)
        at, end = self.slot_start[slot], self.slot_start[slot + 1]
        out = np.full(len(key), -1, np.int64)
        for d in range(self.depth):
            live = at + d < end
            hit = live & (self.slot_key[np.where(live, at + d, -1)] == key)
            out[hit] = self.slot_id[(at + d)[hit]]
        return out

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The characters of all words as symbols, and each word's number of them."""
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        return self.char_symbol[flat], np.fromiter(map(len, words), np.int64, len(words))

    def _heap(self, s: list[int]) -> list[int]:
        """All merges of one word, best rank first, leftmost among equals."""
        left, right = list(range(-1, len(s) - 1)), [*range(1, len(s)), -1]
        heap: list[tuple[int, int, int, int, int]] = []

        def push(i: int, j: int) -> None:
            m = int(self.merged(np.array([s[i]]), np.array([s[j]]))[0])
            if m >= 0:
                heapq.heappush(heap, (int(self.rank[m]), i, s[i], s[j], m))

        for i in range(len(s) - 1):
            push(i, i + 1)
        while heap:
            _, i, a, b, m = heapq.heappop(heap)
            j = right[i]
            if s[i] != a or j < 0 or s[j] != b:
                continue
            s[i], s[j] = m, -1
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
                push(i, right[j])
            if left[i] >= 0:
                push(left[i], i)
        return [x for x in s if x >= 0]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The little-endian int32 ids of each word, which has its space symbols and isn't empty."""
        sym, count = self.symbols(words)
        word = np.repeat(np.arange(len(words)), count)
        ended: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            pair = np.full(len(sym), -1, np.int64)
            inside = np.flatnonzero(word[:-1] == word[1:])
            pair[inside] = self.merged(sym[inside], sym[inside + 1])
            rank = np.where(pair >= 0, self.rank[pair], _NONE)
            start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            size = np.diff(np.r_[start, len(sym)])
            of = np.repeat(np.arange(len(start)), size)
            best = np.minimum.reduceat(rank, start)
            done = best == _NONE
            at = np.flatnonzero((rank == best[of]) & ~done[of])
            unsafe = np.zeros(len(start), bool)
            unsafe[of[at[self.marked[pair[at]]]]] = True
            for k in np.flatnonzero(unsafe & (size >= HEAP_FROM)):
                done[k] = True
                s = self._heap(sym[start[k] : start[k] + size[k]].tolist())
                ended.append((np.full(len(s), word[start[k]]), np.array(s, np.int64)))
                size[k] = 0
            keep = ~done[of]
            over = done[of] & (size[of] > 0)
            ended.append((word[over], sym[over]))
            at = at[keep[at]]
            if len(at):
                # Neighbouring hits share a symbol: of a row of them every second merges, from the left.
                row = np.r_[True, (np.diff(at) != 1) | (of[at][1:] != of[at][:-1])]
                place = np.arange(len(at)) - np.maximum.accumulate(np.where(row, np.arange(len(at)), 0))
                first = np.r_[True, of[at][1:] != of[at][:-1]]
                at = at[np.where(unsafe[of[at]], first, place % 2 == 0)]
                sym[at] = pair[at]
                keep[at + 1] = False
            sym, word = sym[keep], word[keep]
        word, sym = np.concatenate([w for w, _ in ended]), np.concatenate([s for _, s in ended])
        by_word = np.argsort(word, kind="stable")
        word, sym = word[by_word], sym[by_word]
        edge = np.searchsorted(word, np.arange(len(words) + 1)) * 4
        data, edge = sym.astype("<i4").tobytes(), edge.tolist()
        out = [data[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]
        for k in np.unique(word[sym >= self.n]).tolist():
            out[k] = self._fallback(np.frombuffer(out[k], "<i4")).astype("<i4").tobytes()
        return out

    def _fallback(self, sym: np.ndarray) -> np.ndarray:
        ids: list[int] = []
        for s in sym.tolist():
            if s < self.n:
                ids.append(s)
            elif self.byte[0] >= 0:
                ids += [int(self.byte[b]) for b in chr(s - self.n).encode("utf-8", "replace")]
            else:
                ids.append(self.unknown)
        return np.array(ids, np.int64)

    def decode_ids(self, ids: np.ndarray) -> str:
        """Pieces joined, space symbols as spaces but for one at the start; runs of byte pieces as UTF-8, each byte that is no part of a character as U+FFFD."""
        parts = list(map(self.piece_bytes.__getitem__, ids.tolist()))
        is_byte = self.byte_of[ids] >= 0
        for i in np.flatnonzero(is_byte).tolist():
            parts[i] = bytes([self.byte_of[ids[i]]])
        if not is_byte.any() or (len(run := b"".join(parts)) and _valid(run)):
            out = (b"".join(parts) if not is_byte.any() else run).decode()
        else:
            edge = np.flatnonzero(np.r_[True, is_byte[1:] != is_byte[:-1], True])
            out = "".join(_bytes_text(b"".join(parts[a:b])) if is_byte[a] else b"".join(parts[a:b]).decode() for a, b in zip(edge[:-1], edge[1:], strict=True))
        first = next((i for i in ids.tolist() if self.piece_bytes[i] or self.byte_of[i] >= 0), None)
        return out[1:] if first is not None and self.pieces[first].startswith(SPACE) else out


def _valid(b: bytes) -> bool:
    try:
        b.decode()
    except UnicodeDecodeError:
        return False
    return True


def _bytes_text(b: bytes) -> str:
    out, i = [], 0
    while i < len(b):
        for k in (1, 2, 3, 4):
            if _valid(c := b[i : i + k]) and len(c) == k:
                out.append(c.decode())
                i += k
                break
        else:
            out.append("�")
            i += 1
    return "".join(out)


@functools.cache
def vocabulary(model: str) -> Vocabulary:
    return Vocabulary(model)


class Encoder:
    """Encodes texts; the ids of words seen before come from a bounded cache of two generations."""

    def __init__(self, model: str):
        self.vocab = vocabulary(model)
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, batch: list[str]) -> list[np.ndarray]:
        """The int32 ids of each text."""
        words = []
        for t in batch:
            # A key without a space symbol stands for the word with one before it, as nearly all are; others have all their space symbols.
            s = t.replace(SPACE, " ") if SPACE in t else t
            w = s.split(" ") if t else []
            if "" in w:
                w, parts, run = [], w, ""
                for x in parts:
                    run += SPACE
                    if x:
                        w.append(x if run == SPACE else run + x)
                        run = ""
                w += [run] * bool(run)
            words.append(w)
        if len(self.cache) > CACHE_WORDS:
            self.old, self.cache = self.cache, {}
        cache, old = self.cache, self.old
        seen = set().union(*words)
        seen.difference_update(cache)
        new = []
        for w in seen:
            if (x := old.get(w)) is None:
                new.append(w)
            else:
                cache[w] = x
        for at in range(0, len(new), 10_000):
            part = new[at : at + 10_000]
            cache.update(zip(part, self.vocab.encode_words([w if w[0] == SPACE else SPACE + w for w in part]), strict=True))
        return [np.frombuffer(b"".join(map(cache.__getitem__, ws)), "<i4") for ws in words]


@functools.cache
def encoder(model: str) -> Encoder:
    return Encoder(model)


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32), pa.int32()))


def _add(df: DataFrame, column: str, kind: str, fn) -> DataFrame:
    kept = others(df, column)

    def one(batch: pa.RecordBatch):
        yield pa.RecordBatch.from_arrays([*columns(batch, kept), fn(batch)], names=[*(f.name for f in kept), column])

    return arrow_map(df, one, ddl(kept, f"`{column}` {kind}"))


def _encoded(column: pa.Array, model: str) -> pa.ListArray:
    return _lists(encoder(model).encode([t or "" for t in column.to_pylist()]))


def _decoded(column: pa.ListArray, model: str) -> pa.Array:
    v, values, out = vocabulary(model), column.values.to_numpy(zero_copy_only=False), []
    offsets, there = column.offsets.to_pylist(), column.is_valid().to_pylist()
    for a, b, ok in zip(offsets[:-1], offsets[1:], there, strict=True):
        out.append(v.decode_ids(values[a:b]) if ok and b > a else "")
    return pa.array(out, pa.string())


def encode(df: DataFrame, model: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the column ids, array<int>: the library's ids without begin or end, no sampling."""
    return _add(df, ids, "array<int>", lambda batch: _encoded(batch.column(batch.schema.get_field_index(text)), model))


def decode(df: DataFrame, model: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add the column decoded: the text of the ids; null ids give the empty text."""
    return _add(df, decoded, "string", lambda batch: _decoded(batch.column(batch.schema.get_field_index(ids)), model))


def encode_and_decode(df: DataFrame, model: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Replace the text by its ids and what they decode to, in one pass: one Python worker a task, and the ids cross to it once."""
    kept = others(df, text, ids, decoded)

    def one(batch: pa.RecordBatch):
        coded = _encoded(batch.column(batch.schema.get_field_index(text)), model)
        yield pa.RecordBatch.from_arrays([*columns(batch, kept), coded, _decoded(coded, model)], names=[*(f.name for f in kept), ids, decoded])

    return arrow_map(df, one, ddl(kept, f"`{ids}` array<int>", f"`{decoded}` string"))


def ids_digest(ids: Column) -> Column:
    """Lower-case hex of the SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(ids.cast("array<string>"), ","), 256)
