"""Byte-level BPE: merges replayed over all distinct words of a block at once, and decoding.

Texts are parted into words by the splitting rule of the rank files. A word
that is a token itself is that token. The others are laid side by side as one
array of tokens, first of single bytes. An inverted index holds, for every
rank, the places of the token pairs that merge to it. Ranks are taken in
rising order: all places of a rank merge together, and only the pairs with
the two neighbours of each new token are looked up and indexed again, so that
the work is that of the merges made and never a scan of the words.

A word's own encoding takes its lowest rank first, leftmost first. Taking the
ranks of all words in order is the same as long as no new pair has a rank at
or below the one at work; words where that happens are set aside and merged
one step at a time.
"""

from __future__ import annotations

import base64
import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hearth.llm.text import blocks, code_points, map_batches, quoted, ranges, small_batches, utf8_lengths

# Text bytes of a block (a longer text is one by itself), and of a piece that is parted into words at once.
BLOCK_BYTES, PIECE_BYTES = 8 << 20, 1 << 20
OTHER, LETTER, NUMBER, BLANK = range(4)
NONE = np.int32(1 << 30)  # no merge
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0     　" + "".join(map(chr, range(0x2000, 0x200B)))


@functools.lru_cache(maxsize=1)
def char_classes() -> bytes:
    """The class of every code point, as the library sees it: its Unicode version decides where Python's lags behind."""
    classes = np.zeros(0x110000, np.uint8)
    unsure = []
    letter_or_number = regex.compile(r"[\p{L}\p{N}]")
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))
        if kind[0] in "LN":
            classes[c] = LETTER if kind[0] == "L" else NUMBER
        elif kind == "Cn" and letter_or_number.match(chr(c)):
            unsure.append(c)
    classes[[ord(c) for c in WHITE_SPACE]] = BLANK
    ranks = {bytes([i]): i for i in range(256)}
    for c in unsure:
        for start in "a1":
            ranks[(start + chr(c)).encode()] = len(ranks)
    probe = tiktoken.Encoding("probe", pat_str=r"\p{L}+|\p{N}+|.", mergeable_ranks=ranks, special_tokens={})
    for c in unsure:  # one token: the library takes both characters for one word
        for start, kind in (("a", LETTER), ("1", NUMBER)):
            if len(probe.encode_ordinary(start + chr(c))) == 1:
                classes[c] = kind
    return classes.tobytes()


def _apostrophes(chars: np.ndarray, kinds: np.ndarray, starts: np.ndarray, last: np.ndarray) -> None:
    """Moves word starts for 's 't 're 've 'm 'll 'd where an apostrophe begins a word and letters follow."""
    at = np.flatnonzero((chars == ord("'")) & starts)
    at = at[at + 1 < len(chars)]
    at = at[~last[at] & (kinds[at + 1] == LETTER)]
    one = chars[at + 1]
    after = np.minimum(at + 2, len(chars) - 1)
    two = np.where((at + 2 < len(chars)) & ~last[at + 1], chars[after], 0)
    length = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, 0)
    for a, b in ("re", "ve", "ll"):
        length[(one == ord(a)) & (two == ord(b))] = 2
    at, length = at[length > 0], length[length > 0]
    starts[at + 1] = False
    end = at + 1 + length
    starts[end[end < len(chars)]] = True


def word_starts(chars: np.ndarray, edges: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Flags of the characters that begin a word of the splitting rule."""
    n = len(chars)
    starts = np.zeros(n, bool)
    if not n:
        return starts
    kinds = classes[chars]
    first = np.zeros(n, bool)
    first[edges[:-1][edges[:-1] < n]] = True
    last = np.zeros(n, bool)
    last[edges[1:][edges[1:] > 0] - 1] = True
    changed = first.copy()
    changed[1:] |= kinds[1:] != kinds[:-1]
    blank = kinds == BLANK
    ends = last.copy()
    ends[:-1] |= changed[1:]
    # blanks: one word up to the last but one; the last one begins a word of its own, or leads the next as a space
    starts |= changed & blank
    starts |= blank & ends & ~last
    led = np.zeros(n, bool)
    led[1:] = (chars[:-1] == 0x20) & ~first[1:]
    starts |= changed & ~blank & ~led
    _apostrophes(chars, kinds, starts, last)
    return starts


def split_words(texts: list[str], classes: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts (binary), and how many each text has."""
    parts, counts = [], []
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop]) <= PIECE_BYTES):
            size += len(texts[stop])
            stop += 1
        chars, edges = code_points(texts[at:stop])
        begins = np.flatnonzero(word_starts(chars, edges, classes))
        bytes_before = np.concatenate([[0], np.cumsum(utf8_lengths(chars), dtype=np.int64)])
        offsets = np.append(bytes_before[begins], bytes_before[-1]).astype(np.int64)
        data = "".join(texts[at:stop]).encode()
        parts.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(data)]))
        counts.append(np.diff(np.searchsorted(begins, edges)))
        at = stop
    return pa.concat_arrays(parts) if parts else pa.array([], pa.large_binary()), np.concatenate([np.zeros(0, np.int64), *counts])


class Ranks:
    """The ranks of a tiktoken file's bytes; ``classes`` come from ``char_classes``."""

    def __init__(self, content: bytes, classes: bytes):
        self.classes = np.frombuffer(classes, np.uint8)
        self.rank_of = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}
        if max(self.rank_of.values()) >= 1 << 16 or not all(bytes([i]) in self.rank_of for i in range(256)):
            raise ValueError("the rank file needs all single bytes, and ranks below 65,536")
        self.single = np.array([self.rank_of[bytes([i])] for i in range(256)], np.int32)
        tokens = [b""] * (max(self.rank_of.values()) + 1)
        for t, r in self.rank_of.items():
            tokens[r] = t
        self.tokens, self.token_size = tokens, np.array([len(t) for t in tokens], np.int64)
        keys, ranks = [], []  # every pair of tokens that is a token together
        for t, r in self.rank_of.items():
            for k in range(1, len(t)):
                a, b = self.rank_of.get(t[:k]), self.rank_of.get(t[k:])
                if a is not None and b is not None:
                    keys.append((a << 16) + b)
                    ranks.append(r)
        order = np.argsort(np.array(keys, np.uint32))
        self.pair_keys, self.pair_ranks = np.array(keys, np.uint32)[order], np.array(ranks, np.int32)[order]

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank each two neighbours merge to; negative tokens are the ends of words."""
        keys = (np.maximum(left, 0).astype(np.uint32) << np.uint32(16)) + np.maximum(right, 0).astype(np.uint32)
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == keys) & (left >= 0) & (right >= 0), self.pair_ranks[at], NONE)

    def stepwise(self, word: bytes) -> list[int]:
        """One merge at a time: lowest rank, then leftmost."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while True:
            best = min(((r, i) for i in range(len(parts) - 1) if (r := self.rank_of.get(parts[i] + parts[i + 1])) is not None), default=None)
            if best is None:
                return [self.rank_of[p] for p in parts]
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words one after the other, and where each word's begin and end."""
        whole = np.array([self.rank_of.get(w, -1) for w in words], np.int32)
        rest = np.flatnonzero(whole < 0)
        ids, edges, odd = self.replay([words[i] for i in rest.tolist()])
        lengths = np.ones(len(words), np.int64)
        lengths[rest] = np.diff(edges)
        slow = {int(rest[i]): np.array(self.stepwise(words[rest[i]]), np.int32) for i in odd.tolist()}
        for i, x in slow.items():
            lengths[i] = len(x)
        out_edges = np.concatenate([[0], np.cumsum(lengths)])
        out = np.empty(out_edges[-1], np.int32)
        known = np.flatnonzero(whole >= 0)
        out[out_edges[known]] = whole[known]
        plain = np.ones(len(rest), bool)
        plain[odd] = False
        size = np.diff(edges)[plain]
        out[ranges(out_edges[rest[plain]], size)] = ids[ranges(edges[:-1][plain], size)]
        for i, x in slow.items():
            out[out_edges[i] : out_edges[i + 1]] = x
        return out, out_edges

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and edges of the words, and the numbers of words set aside (their ids don't count)."""
        lengths = np.array([len(w) for w in words], np.int64)
        # each word's bytes, then an end mark of token -1
        text = np.frombuffer(b"\0".join(words) + b"\0", np.uint8) if words else np.zeros(0, np.uint8)
        token = self.single[text]
        ends = np.cumsum(lengths + 1) - 1
        token[ends] = -1
        n = len(token)
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        rank = np.full(n, NONE, np.int32)
        if n:
            rank[:-1] = self.merged(token[:-1], token[1:])
        index: dict[int, list[np.ndarray]] = {}
        self._add(index, np.flatnonzero(rank < NONE).astype(np.int32), rank)
        odd: list[np.ndarray] = []
        for r in range(len(self.tokens)):
            if r not in index:
                continue
            at = np.sort(np.concatenate(index.pop(r)))
            at = at[rank[at] == r]
            if not len(at):
                continue
            over = rank[after[at]] == r
            if over.any():  # leftmost first: a place whose first token was just taken does not merge
                taken, keep = -1, np.ones(len(at), bool)
                for k, (x, y) in enumerate(zip(at.tolist(), after[at].tolist(), strict=True)):
                    keep[k] = x != taken
                    taken = y if keep[k] else -1
                at = at[keep]
            right = after[at]
            far = after[right]
            token[at] = r
            after[at] = far
            before[far] = at
            rank[right] = NONE
            token[right] = -2
            near = before[at]
            touched = np.concatenate([at, near[(near >= 0) & (token[near] != r)]])
            rank[touched] = self.merged(token[touched], token[after[touched]])
            touched = touched[rank[touched] < NONE]
            early = rank[touched] <= r
            if early.any():
                aside = np.unique(np.searchsorted(ends, touched[early]))
                odd.append(aside)
                for w in aside.tolist():
                    rank[ends[w] - lengths[w] : ends[w]] = NONE
                touched = touched[rank[touched] < NONE]
            self._add(index, touched, rank)
        kept = token >= 0
        edges = np.concatenate([[0], np.cumsum(kept)[ends]]) if n else np.zeros(1, np.int64)
        return token[kept], edges, np.unique(np.concatenate([np.zeros(0, np.int64), *odd]))

    @staticmethod
    def _add(index: dict[int, list[np.ndarray]], places: np.ndarray, rank: np.ndarray) -> None:
        if not len(places):
            return
        ranks = rank[places]
        if len(places) > 1:
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        cuts = [0, *cuts.tolist(), len(places)]
        first = ranks[cuts[:-1]].tolist()
        for r, a, b in zip(first, cuts[:-1], cuts[1:], strict=True):
            index.setdefault(r, []).append(places[a:b])

    def encode(self, texts: list[str], rows: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each ``rows`` texts their ids one after the other, and where each text's begin and end."""
        words, counts = split_words(texts, self.classes)
        coded = words.dictionary_encode()
        del words
        ids, edges = self.encode_words(coded.dictionary.to_pylist())
        number, size = coded.indices.to_numpy(zero_copy_only=False), np.diff(edges)
        last = np.concatenate([[0], np.cumsum(counts)])
        for i in range(0, len(texts), rows):
            cut = last[i : i + rows + 1]
            part = number[cut[0] : cut[-1]]
            ends = np.concatenate([[0], np.cumsum(size[part])])
            yield ids[ranges(edges[part], size[part])], ends[cut - cut[0]]

    def decode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of all ids, and where each id's begin and end."""
        return b"".join(map(self.tokens.__getitem__, ids.tolist())), np.concatenate([[0], np.cumsum(self.token_size[ids])])


@functools.lru_cache(maxsize=2)
def _ranks(content: bytes, classes: bytes) -> Ranks:
    return Ranks(content, classes)


def _model(docs: DataFrame, rank_file: str):
    small_batches(docs.sparkSession)
    with open(rank_file, "rb") as f:  # read by the driver; executors get the bytes
        return docs.sparkSession.sparkContext.broadcast((f.read(), char_classes()))


def _packed(data: bytes, edges: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(data)])


def encode(docs: DataFrame, rank_file: str, text_col: str = "text", ids_col: str = "ids", packed: bool = False) -> DataFrame:
    """``docs`` with ``ids_col``: the ids of the whole text as array<int>, or ``packed`` as little-endian 32-bit integers.

    Null and empty texts have no ids (an empty array). Texts of any length are
    encoded whole. An existing ``ids_col`` is replaced; other columns and
    repeated rows stay; an empty table gives no rows. A task holds a block of
    BLOCK_BYTES of text at a time, or one longer text.
    """
    model = _model(docs, rank_file)
    rest = [c for c in docs.columns if c != ids_col]
    at = rest.index(text_col)

    def run(batches):
        ranks = _ranks(*model.value)
        for block in blocks(batches, at, BLOCK_BYTES):
            texts = [t or "" for b in block for t in b.column(at).to_pylist()]
            table = pa.Table.from_batches(block)
            row = 0
            for flat, cut in ranks.encode(texts):
                for part in table.slice(row, len(cut) - 1).combine_chunks().to_batches():
                    column = _packed(flat.astype("<u4").tobytes(), cut * 4) if packed else pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(flat))
                    yield pa.RecordBatch.from_arrays([*part.columns, column], [*rest, ids_col])
                row += len(cut) - 1

    kept = docs.select(*map(quoted, rest))
    kind = T.BinaryType() if packed else T.ArrayType(T.IntegerType())
    return map_batches(kept, run, T.StructType([*kept.schema, T.StructField(ids_col, kind)]))


def decode(rows: DataFrame, rank_file: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``rows`` with ``out_col`` binary: the bytes of the ids (array<int> or packed). Null ids give no bytes; an id
    outside the file raises IndexError."""
    model = _model(rows, rank_file)
    rest = [c for c in rows.columns if c != out_col]
    at = rest.index(ids_col)

    def run(batches):
        ranks = _ranks(*model.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                values = part.column(at).to_pylist() if pa.types.is_binary(part.column(at).type) else part.column(at).to_numpy(zero_copy_only=False)
                each = [np.frombuffer(v, "<u4") if isinstance(v, bytes) else np.zeros(0, np.int64) if v is None else v for v in values]
                data, edges = ranks.decode(np.concatenate([np.zeros(0, np.int64), *each]).astype(np.int64))
                ends = edges[np.cumsum([0, *map(len, each)])]
                yield pa.RecordBatch.from_arrays([*part.columns, _packed(data, ends)], [*rest, out_col])

    kept = rows.select(*map(quoted, rest))
    return map_batches(kept, run, T.StructType([*kept.schema, T.StructField(out_col, T.BinaryType())]))
