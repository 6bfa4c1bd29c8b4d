"""SentencePiece BPE by vectorised merge rounds over flat symbol arrays."""

from __future__ import annotations

import re
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from energylake.llm.common import map_texts, pick

SPACE = "▁"
MAX_WORD = 256
CACHE_BYTES, WORD_BYTES = 64 << 20, 190  # a word's own cost: a string, its entry and a number
DECODE_ROWS = 256
NO_RANK = np.int64(1) << 40


class Pieces:
    """Tables of a BPE model with byte fallback and an identity normaliser.

    ``code`` numbers every piece that can take part in a merge; characters without a piece
    get numbers beyond them and never merge.  ``pair`` holds the sorted keys left * size +
    right of all pairs whose joined text is a piece, ``rank`` and ``joined`` what they become.
    """

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        texts = [model.id_to_piece(i) for i in range(size)]
        normal = [i for i in range(size) if not (
            model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        if any(model.is_unused(i) for i in range(size)) or model.normalize("ﬁ  a ") != f"{SPACE}ﬁ{SPACE * 2}a{SPACE}":
            raise ValueError("only models without unused pieces and with an identity normaliser")
        if any(SPACE in t.lstrip(SPACE) for t in (texts[i] for i in normal)):
            raise ValueError("pieces may hold the space mark only at their start")
        self.size = size
        self.id_of = {texts[i]: i for i in normal}
        order = np.unique([-model.get_score(i) for i in normal], return_inverse=True)[1]
        rank = dict(zip(normal, order.tolist()))
        pairs = {}
        for text, whole in self.id_of.items():
            for cut in range(1, len(text)):
                left, right = self.id_of.get(text[:cut]), self.id_of.get(text[cut:])
                if left is not None and right is not None:
                    pairs[left * size + right] = (rank[whole], whole)
        self.table = pairs
        self.pair = np.array(sorted(pairs), np.int64)
        self.rank = np.array([pairs[k][0] for k in self.pair.tolist()], np.int64)
        self.joined = np.array([pairs[k][1] for k in self.pair.tolist()], np.int64)
        byte = {int(texts[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        if len(byte) < 256:
            raise ValueError("only models with byte fallback")
        self.byte = np.array([byte[b] for b in range(256)], np.int32)
        letters = {ord(t): i for t, i in self.id_of.items() if len(t) == 1}
        self.letter = np.arange(max(letters) + 1) + size  # number of each code point, up to the highest piece
        self.letter[list(letters)] = list(letters.values())
        back = [b"" if model.is_control(i) else bytes([int(t[3:5], 16)]) if model.is_byte(i)
                else b" \xe2\x81\x87 " if model.is_unknown(i) else t.replace(SPACE, " ").encode()
                for i, t in enumerate(texts)]
        self.back = np.frombuffer(b"".join(back), np.uint8)
        self.back_size = np.array([len(b) for b in back], np.int64)
        self.back_start = np.concatenate([[0], np.cumsum(self.back_size)[:-1]])
        # a character in no piece at all can be cut at; the newline is the one worth it
        self.newline = None if any("\n" in t for t in self.id_of) else byte[10]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair; NO_RANK where the pair is no piece."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        known = (self.pair[at] == key) & (left < self.size) & (right < self.size)
        return np.where(known, self.rank[at], NO_RANK), self.joined[at]


@lru_cache(maxsize=1)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def symbols(p: Pieces, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """One number per character of all words, and how many each word has.

    A character's number is its piece, or one beyond all pieces that stands for its code point.
    """
    size = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return np.where(points < len(p.letter), p.letter[np.minimum(points, len(p.letter) - 1)], points + p.size), size


def merge_rounds(p: Pieces, start: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merged symbols of all words and the first position of each word.

    ``symbol`` is flat over the words, which begin at ``start``; no word is empty.  Each
    round finds the smallest pair rank of every word, merges its leftmost pair of that rank
    in all words at once, looks up the two new pairs of each merge, and closes the gaps.
    Words without a pair leave the arrays.  Merging one pair a word and round keeps the order
    of the sequential algorithm, where a new pair may outrank an equal one further right.
    """
    words = len(start)
    length = np.diff(np.append(start, len(symbol)))
    done_symbol, done_word = [], []
    word = np.repeat(np.arange(words), length)  # of each symbol
    last = np.zeros(len(symbol), bool)
    last[start + length - 1] = True
    rank, joined = np.full(len(symbol), NO_RANK), np.zeros(len(symbol), np.int64)
    inner = np.flatnonzero(~last)
    rank[inner], joined[inner] = p.ranks(symbol[inner], symbol[inner + 1])
    while len(symbol):
        first = np.flatnonzero(np.diff(word, prepend=-1))
        # rank and position in one number: the minimum is the leftmost pair of the best rank
        best = np.minimum.reduceat((rank << 22) + np.arange(len(rank)) - np.repeat(
            first, np.diff(np.append(first, len(rank)))), first)
        open_ = best >> 22 < NO_RANK
        if not open_.all():  # words without a pair are complete
            stay = np.repeat(open_, np.diff(np.append(first, len(rank))))
            done_symbol.append(symbol[~stay])
            done_word.append(word[~stay])
            symbol, word, last = symbol[stay], word[stay], last[stay]
            rank, joined = rank[stay], joined[stay]
            if not len(symbol):
                break
            best = best[open_]
            first = np.flatnonzero(np.diff(word, prepend=-1))
        at = first + (best & ((1 << 22) - 1))
        symbol[at] = joined[at]
        last[at] = last[at + 1]
        keep = np.ones(len(symbol), bool)
        keep[at + 1] = False
        new = at - np.arange(len(at))  # one symbol fewer before each later word
        symbol, word, last, rank, joined = symbol[keep], word[keep], last[keep], rank[keep], joined[keep]
        rank[new] = NO_RANK
        after = new[~last[new]]
        before = new[(new > 0) & (word[new - 1] == word[new])]
        left = np.concatenate([after, before - 1])
        rank[left], joined[left] = p.ranks(symbol[left], symbol[left + 1])
    if not done_word:
        return np.empty(0, np.int64), np.zeros(words + 1, np.int64)
    symbol, word = np.concatenate(done_symbol), np.concatenate(done_word)
    order = np.argsort(word, kind="stable")
    return symbol[order], np.searchsorted(word[order], np.arange(words + 1))


def merge_long(p: Pieces, symbol: list[int]) -> list[int]:
    """The same merges for one long word, whose rounds would be too many, from a heap of pairs."""
    n = len(symbol)
    symbol, after, before = list(symbol), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []

    def offer(i):
        j = after[i]
        if j < n:
            got = p.table.get(symbol[i] * p.size + symbol[j]) if symbol[i] < p.size and symbol[j] < p.size else None
            if got:
                heap.append((got[0], i, symbol[i], symbol[j], got[1])) if not ready else heappush(
                    heap, (got[0], i, symbol[i], symbol[j], got[1]))

    ready = False
    for i in range(n - 1):
        offer(i)
    heapify(heap)
    ready = True
    while heap:
        _, i, left, right, whole = heappop(heap)
        if symbol[i] != left or after[i] >= n or symbol[after[i]] != right:
            continue
        j = after[i]
        symbol[i], symbol[j] = whole, -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    return [s for s in symbol if s >= 0]


def spelled(p: Pieces, merged: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids and their number per word; characters without a piece become their UTF-8 bytes."""
    odd = np.flatnonzero(merged >= p.size)
    if not len(odd):
        return merged.astype(np.int32), size
    data = [chr(c).encode("utf-8", "surrogatepass") for c in (merged[odd] - p.size).tolist()]
    width = np.ones(len(merged), np.int64)
    width[odd] = list(map(len, data))
    ids = np.repeat(merged, width).astype(np.int32)
    ends = np.cumsum(width)
    ids[np.repeat(merged >= p.size, width)] = p.byte[np.frombuffer(b"".join(data), np.uint8)]
    bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(size)])]
    return ids, np.diff(bounds)


def encode_words(p: Pieces, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in one array, and their number per word."""
    flat, size = symbols(p, words)
    start = np.cumsum(size) - size
    long = np.flatnonzero(size > MAX_WORD)
    if not len(long):
        merged, cut = merge_rounds(p, start, flat)
        return spelled(p, merged, np.diff(cut))
    short = np.flatnonzero(size <= MAX_WORD)
    kept = np.repeat(size <= MAX_WORD, size)
    merged, cut = merge_rounds(p, np.cumsum(size[short]) - size[short], flat[kept])
    parts = dict(zip(short.tolist(), np.split(merged, cut[1:-1]))) if len(short) else {}
    for i in long.tolist():
        parts[i] = np.array(merge_long(p, flat[start[i]:start[i] + size[i]].tolist()), np.int64)
    parts = [parts[i] for i in range(len(words))]
    return spelled(p, np.concatenate(parts), np.array(list(map(len, parts)), np.int64))


class Known:
    """Ids of words met before, one after the other in one array; the older half goes when it is full."""

    def __init__(self, p: Pieces, limit: int):
        self.p, self.limit, self.bytes = p, limit, 0
        self.place: dict[str, int] = {}
        self.start, self.values = np.zeros(1, np.int64), np.empty(0, np.int32)

    def places(self, words: list[str]) -> np.ndarray:
        """The place of each word; new ones are encoded first."""
        fresh = list(dict.fromkeys([w for w in words if w not in self.place]))
        if fresh:
            if self.bytes > self.limit:
                self._halve()
                fresh = list(dict.fromkeys([w for w in words if w not in self.place]))
            ids, size = encode_words(self.p, fresh)
            self.place.update(zip(fresh, range(len(self.place), len(self.place) + len(fresh))))
            self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(size)])
            self.values = np.concatenate([self.values, ids])
            self.bytes += sum(map(len, fresh)) + WORD_BYTES * len(fresh) + ids.nbytes
        return np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))

    def ids(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words at the places, joined, and their number per word."""
        size = self.start[places + 1] - self.start[places]
        shift = np.repeat(self.start[places] - (np.cumsum(size) - size), size)
        return self.values[np.arange(len(shift)) + shift], size

    def _halve(self) -> None:
        words = list(self.place)[len(self.place) // 2:]
        keep = np.arange(len(self.place) - len(words), len(self.place))
        self.values, size = self.ids(keep)
        self.start = np.concatenate([[0], np.cumsum(size)])
        self.place = dict(zip(words, range(len(words))))
        self.bytes = sum(map(len, words)) + WORD_BYTES * len(words) + self.values.nbytes


@lru_cache(maxsize=1)
def known(path: str) -> Known:
    return Known(pieces(path), CACHE_BYTES)


def encoder(path: str):
    """Function from texts to their ids, as one Arrow list array.

    The space mark opens every word, so texts are cut into words at spaces and, if no piece
    holds a newline, at newlines.  Words met before, also by earlier tasks of the worker, come from a
    store of bounded size.
    """
    p, store = pieces(path), known(path)
    cut = re.compile(f"{SPACE}*[^{SPACE}\n]+|\n|{SPACE}+" if p.newline is not None
                     else f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall

    def encode(texts):
        words = [cut(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        count = np.fromiter(map(len, words), np.int64, len(words))
        values, size = store.ids(store.places(list(chain.from_iterable(words))))
        ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum(count)]
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))]

    return encode


def decode_ids(p: Pieces, ids: np.ndarray) -> str:
    """Text of the ids: piece texts and fallback bytes joined, less the opening space."""
    size = p.back_size[ids]
    if not size.sum():
        return ""
    shift = np.repeat(p.back_start[ids] - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
    data = p.back[np.arange(len(shift)) + shift].tobytes()
    return data.decode("utf-8", "replace").removeprefix(" ")


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and ids, exactly as the library encodes the whole text.

    No begin or end ids.  Null and empty texts give an empty list; repeated rows are encoded
    each for itself.  The model file's path must be readable on every executor.
    """
    return map_texts(pick(docs, doc_id=id_col, text=text_col), "text",
                     [T.StructField("ids", T.ArrayType(T.IntegerType()))], lambda: encoder(model_path))


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """The frame with the text of its ids; null and empty lists give the empty text."""
    at = encoded.columns.index(ids_col)
    schema = T.StructType([*encoded.schema.fields, T.StructField(out, T.StringType())])

    def run(batches):
        p = pieces(model_path)
        for batch in (whole.slice(i, DECODE_ROWS) for whole in batches
                      for i in range(0, whole.num_rows, DECODE_ROWS)):
            column = batch.column(at)
            offsets, values = column.offsets.to_numpy(), column.values.to_numpy()
            known = column.is_valid().to_numpy(zero_copy_only=False)
            texts = [decode_ids(p, values[a:b]) if k else "" for a, b, k in zip(
                offsets, offsets[1:], known)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             [*batch.schema.names, out])

    return encoded.mapInArrow(run, schema)

