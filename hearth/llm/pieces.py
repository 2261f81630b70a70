"""SentencePiece BPE: exact encoding by a prefix table, and decoding.

The encoding of a text by greedy merges has one property that makes a table
possible: a sequence of pieces is the encoding of its text exactly if each
two neighbours are, taken alone, the encoding of the two together (merges in
one place never depend on symbols beyond a border that no merge crosses). So
every prefix of a text has one last piece: among the pieces that end there
(found by an Aho-Corasick automaton) the one that fits the last piece of the
prefix before it. The table of last pieces is filled from left to right, and
the ids are read off backwards. A pair is tested once by merging its few
characters, and remembered.

Texts are cut where no piece can cross (before white space marks, and beside
characters that stand in no longer piece), so that the units of a text are
encoded one by one. A block of texts is cut at once, its distinct units are
encoded once each, or looked up, and their ids are laid out for all places.
"""

from __future__ import annotations

import codecs
import functools
import unicodedata
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hearth.llm.text import blocks, code_points, map_batches, quoted, ranges, small_batches, utf8_lengths

MARK = "▁"
# Bounds of the memories of one Python worker (entries); a full one starts anew.
WORDS_KEPT, PAIRS_KEPT, WORD_LENGTH = 1 << 19, 1 << 18, 40
# Text bytes of a block (a longer text is one by itself), and characters cut into units at once.
BLOCK_BYTES, PIECE_CHARS = 8 << 20, 1 << 20

codecs.register_error("each_byte", lambda e: ("�", e.start + 1))


MARKS, OTHERS, PUNCTUATION, ALONE = range(4)


def _unit_classes(longer: list[str]) -> np.ndarray:
    """The class of every code point, by which texts are cut where no piece crosses: white space marks stay with what
    follows; punctuation is parted from other characters, as far as no piece joins the two; ASCII characters in no
    longer piece are alone."""
    inside = set().union(*longer)
    marks = {c for c in inside if unicodedata.category(c)[0] in "PSCZ" or unicodedata.category(c) == "No"} - {MARK}
    while joined := {x for t in longer for a, b in zip(t, t[1:], strict=False) if MARK not in (a, b) and (a in marks) != (b in marks) for x in (a, b)} & marks:
        marks -= joined
    classes = np.full(0x110000, OTHERS, np.uint8)
    classes[[c for c in range(128) if chr(c) not in inside]] = ALONE
    classes[[ord(c) for c in marks]] = PUNCTUATION
    classes[ord(MARK)] = MARKS
    return classes


def split_units(texts: list[str], classes: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The units of all texts (binary), white space as marks and one mark before, and how many each text has."""
    texts = [MARK + t.replace(" ", MARK) if t else "" for t in texts]
    chars, edges = code_points(texts)
    kinds = classes[chars]
    begins = np.ones(len(chars), bool)
    same, led = kinds[1:] == kinds[:-1], kinds[:-1] == MARKS
    begins[1:] = (kinds[1:] == ALONE) | ~same & ~led
    begins[edges[:-1][edges[:-1] < len(chars)]] = True
    at = np.flatnonzero(begins)
    ends = np.concatenate([[0], np.cumsum(utf8_lengths(chars), dtype=np.int64)])
    offsets = np.append(ends[at], ends[-1])
    units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer("".join(texts).encode())])
    return units, np.diff(np.searchsorted(at, edges))


class Pieces:
    """The vocabulary of a model file's bytes: BPE with byte fallback, a dummy prefix and
    no normalisation (others raise ValueError)."""

    def __init__(self, model: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.end_id = sp.eos_id()
        texts = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(len(texts))]
        self.byte_ids = [0] * 256
        self.bytes_of = [b""] * len(texts)
        self.ids, self.scores = {}, {}
        for i, text in enumerate(texts):
            if sp.is_byte(i):
                self.byte_ids[int(text[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(text[3:5], 16)])
            elif sp.is_unknown(i):
                self.bytes_of[i] = " \u2047 ".encode()
            elif not special[i]:
                self.ids[text], self.scores[text] = i, sp.get_score(i)
                self.bytes_of[i] = text.replace(MARK, " ").encode()
        longer = [t for t in self.ids if len(t) > 1]
        if not all(self.byte_ids) or any(MARK in t.lstrip(MARK) for t in longer):
            raise ValueError("the model needs byte pieces, and white space only at the start of pieces")
        self.automaton = ahocorasick.Automaton()
        for t, i in self.ids.items():
            self.automaton.add_word(t, (i, len(t)))
        self.automaton.make_automaton()
        self.texts = texts
        self.silent = {i for i in range(len(texts)) if sp.is_control(i)}
        self.classes = _unit_classes(longer)
        self.words: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[int, bool] = {}  # by (left << 20) + right
        for probe in ("", " a  b", "\n\t ﬁé é Ⅷ ｘ　 ", "the  quick\r\nbrown" + " " * 9 + "fox \U0001f98a"):
            if self.encode(probe) != sp.encode(probe, add_eos=True):
                raise ValueError("the model normalises texts or has no dummy prefix")

    def merged(self, text: str) -> list[str]:
        """Greedy merges of the few characters of a pair: highest score first, then leftmost."""
        parts, scores = list(text), self.scores
        while True:
            best = max(((s, -i) for i in range(len(parts) - 1) if (s := scores.get(parts[i] + parts[i + 1])) is not None), default=None)
            if best is None:
                return parts
            i = -best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def fits(self, left: int, right: int) -> bool:
        """Whether two pieces are the encoding of both together; left -1: none, or an unknown character."""
        parts = [self.texts[i] for i in (left, right) if i >= 0]
        fits = self.merged("".join(parts)) == parts
        if len(self.pairs) >= PAIRS_KEPT:
            self.pairs.clear()
        self.pairs[(left << 20) + right] = fits
        return fits

    def unit(self, text: str) -> tuple[int, ...]:
        """The ids of a text without dummy prefix or end id."""
        n = len(text)
        last, length = [-1] * n, [0] * n
        pairs, fits = self.pairs, self.fits
        for end, (i, k) in self.automaton.iter(text):
            if not length[end]:
                left = last[end - k] if end >= k else -1
                known = pairs.get((left << 20) + i)
                if known or known is None and fits(left, i):
                    last[end], length[end] = i, k
        out: list[int] = []
        at = n - 1
        while at >= 0:
            if length[at]:
                out.append(last[at])
                at -= length[at]
            else:  # an unknown character
                out.extend(self.byte_ids[b] for b in reversed(text[at].encode()))
                at -= 1
        out.reverse()
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        """The ids of a text, with the end id."""
        ((flat, _),) = self.encode_texts([text])
        return flat.tolist()

    def encode_texts(self, texts: list[str], rows: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each ``rows`` texts their ids one after the other, with end ids, and where each text's begin and end."""
        parts, counts, at = [], [], 0
        while at < len(texts):  # cut into units a piece at a time
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size + len(texts[stop]) <= PIECE_CHARS):
                size += len(texts[stop])
                stop += 1
            units, count = split_units(texts[at:stop], self.classes)
            parts.append(units)
            counts.append(count)
            at = stop
        coded = pa.concat_arrays([*parts, pa.array([b""], pa.large_binary())]).dictionary_encode()
        each = [self._known(u.decode()) for u in coded.dictionary.to_pylist()[:-1]]
        size = np.array([*map(len, each), 1], np.int64)  # the empty unit, which is last, stands for the end id
        ids = np.fromiter(chain(chain.from_iterable(each), [self.end_id]), np.int32, size.sum())
        begin = np.cumsum(size) - size
        number = coded.indices.to_numpy(zero_copy_only=False)[:-1]
        last = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1, np.int64)
        for i in range(0, len(texts), rows):
            cut = last[i : i + rows + 1]
            part = np.insert(number[cut[0] : cut[-1]], cut[1:] - cut[0], len(each))  # an end id behind each text
            ends = np.concatenate([[0], np.cumsum(size[part])])
            yield ids[ranges(begin[part], size[part])], ends[cut - cut[0] + np.arange(len(cut))]

    def _known(self, unit: str) -> tuple[int, ...]:
        ids = self.words.get(unit)
        if ids is None:
            ids = self.unit(unit)
            if len(unit) <= WORD_LENGTH:
                if len(self.words) >= WORDS_KEPT:
                    self.words.clear()
                self.words[unit] = ids
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of ids: control ids are empty, and one leading space goes."""
        while ids and ids[-1] in self.silent:
            ids = ids[:-1]
        if not self.silent.isdisjoint(ids):  # they also part the bytes of a character
            parts, at = [], 0
            for i in [*(i for i, x in enumerate(ids) if x in self.silent), len(ids)]:
                parts.append(self._joined(ids[at:i]))
                at = i + 1
            ids = [x for x in ids if x not in self.silent]
            text = "".join(parts)
        else:
            text = self._joined(ids)
        return text[1:] if ids and self.texts[ids[0]][:1] == MARK else text

    def _joined(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "each_byte")


@functools.lru_cache(maxsize=2)
def _pieces(model: bytes) -> Pieces:
    return Pieces(model)


def _model(docs: DataFrame, model_path: str):
    small_batches(docs.sparkSession)
    with open(model_path, "rb") as f:  # read by the driver; executors get the bytes
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids_col`` array<int>: the ids of the whole text, with an end id.

    A null or empty text has the end id only. Texts of any length are encoded
    whole, in memory that grows with the longest one. An existing ``ids_col``
    is replaced; other columns and repeated rows stay; an empty table gives
    no rows.
    """
    model = _model(docs, model_path)
    rest = [c for c in docs.columns if c != ids_col]

    def run(batches):
        pieces = _pieces(model.value)
        at = rest.index(text_col)
        for block in blocks(batches, at, BLOCK_BYTES):
            table, row = pa.Table.from_batches(block), 0
            for flat, cut in pieces.encode_texts([t or "" for b in block for t in b.column(at).to_pylist()]):
                for part in table.slice(row, len(cut) - 1).combine_chunks().to_batches():
                    ids = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(flat))
                    yield pa.RecordBatch.from_arrays([*part.columns, ids], [*rest, ids_col])
                row += len(cut) - 1
        pieces.words.clear()  # a worker that lives on keeps no memory of this task

    kept = docs.select(*map(quoted, rest))
    return map_batches(kept, run, T.StructType([*kept.schema, T.StructField(ids_col, T.ArrayType(T.IntegerType()))]))


def decode(rows: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``rows`` with ``out_col``: the text of the ids. Null ids give an empty text."""
    model = _model(rows, model_path)
    rest = [c for c in rows.columns if c != out_col]

    def run(batches):
        pieces = _pieces(model.value)
        at = rest.index(ids_col)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                column = part.column(at)
                ids, edges = column.flatten().to_pylist() if column.null_count else column.flatten().to_numpy().tolist(), [0, *np.cumsum(column.value_lengths().fill_null(0)).tolist()]
                texts = [pieces.decode(ids[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*rest, out_col])

    kept = rows.select(*map(quoted, rest))
    return map_batches(kept, run, T.StructType([*kept.schema, T.StructField(out_col, T.StringType())]))
