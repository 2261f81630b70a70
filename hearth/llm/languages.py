"""Language identification: scripts narrow, words score, Viterbi labels spans.

A word is a run of letters. Its script (of its first letter) leaves the
languages that were learned with that script; its letter trigrams, borders
included, give a log-likelihood for each of them. The best path over a text's
words, where each change of language costs ``switch``, labels spans of mixed
texts. The language with most letters on the path is the text's.

Learning counts hashed trigrams per language in Spark; a model has
``BUCKETS`` numbers a language, whatever the corpus.
"""

from __future__ import annotations

import functools
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
PIECE_CHARS = 1 << 21  # letters scored at once
PATH_CELLS = 1 << 24  # words x languages on paths at once
UNKNOWN = "und"

# Main ranges of scripts (fixed values of the Unicode standard): first and last code point.
SCRIPTS = {
    "latin": [(0x0041, 0x024F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)],
    "greek": [(0x0370, 0x03FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x0400, 0x052F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x0530, 0x058F)],
    "hebrew": [(0x0590, 0x05FF)],
    "arabic": [(0x0600, 0x06FF), (0x0750, 0x077F), (0x08A0, 0x08FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x0900, 0x097F), (0xA8E0, 0xA8FF)],
    "bengali": [(0x0980, 0x09FF)],
    "tamil": [(0x0B80, 0x0BFF)],
    "telugu": [(0x0C00, 0x0C7F)],
    "thai": [(0x0E00, 0x0E7F)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
OTHER = len(SCRIPTS) + 1


@functools.cache
def script_table() -> np.ndarray:
    """0 for characters that are no letter, else the number of the script, or OTHER."""
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    for k, ranges in enumerate(SCRIPTS.values(), 1):
        for first, last in ranges:
            table[first : last + 1] = k
    table[~np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)] = 0
    return table


@functools.cache
def mark_table() -> np.ndarray:
    """True for combining marks (vowel signs, accents), which are letters where they follow one."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "M" for c in range(0x110000)), bool, 0x110000)


def scripts_of(char: np.ndarray) -> np.ndarray:
    """The script of each character, 0 for those that are no letter; a mark has the script of the letter that it follows."""
    script, mark = script_table()[char], mark_table()[char]
    if mark.any():
        base = np.maximum.accumulate(np.where(mark, 0, np.arange(len(char))))
        script = np.where(mark, np.where(mark[base], 0, script[base]), script)
    return script


class Letters:
    """The letters of texts: ``script`` and trigram ``bucket`` of each, the letter at which each word starts
    (``words``), and the first word of each text (``first``, with the end)."""

    def __init__(self, texts: list[str]):
        lower = [t.lower() for t in texts]
        char = np.frombuffer(" ".join(lower).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        script = scripts_of(char)
        at = np.flatnonzero(script)
        edge = np.concatenate([[True], np.diff(at) > 1, [True]]) if len(at) else np.ones(1, bool)
        code = char[at].astype(np.uint64)
        before, after = np.roll(code, 1), np.roll(code, -1)
        before[edge[:-1]] = 0
        after[edge[1:]] = 0
        mixed = before * np.uint64(0x9E3779B97F4A7C15) + code * np.uint64(0xC2B2AE3D27D4EB4F) + after * np.uint64(0x165667B19E3779F9)
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        self.bucket = (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
        self.script = script[at]
        self.words = np.flatnonzero(edge[:-1])
        offsets = np.cumsum([0, *(len(t) + 1 for t in lower)])
        self.first = np.searchsorted(at[self.words], offsets)
        self.letters = np.searchsorted(at, offsets)


def _pieces(texts: list[str | None]):
    """Runs (first, last, texts) of about PIECE_CHARS characters."""
    row, part, size = 0, [], 0
    for i, t in enumerate(texts):
        part.append(t or "")
        size += len(part[-1])
        if size >= PIECE_CHARS or i == len(texts) - 1:
            yield row, i + 1, part
            row, part, size = i + 1, [], 0


@dataclass
class Model:
    """``languages`` by code point, log-likelihoods (bucket, language), and (script, language): 0, or a cost where the language has no such script."""

    languages: list[str]
    trigrams: np.ndarray
    scripts: np.ndarray
    switch: float

    def scores(self, x: Letters) -> np.ndarray:
        """(word, language)"""
        if not len(x.words):
            return np.zeros((0, len(self.languages)), np.float32)
        out = np.add.reduceat(self.trigrams[x.bucket], x.words, axis=0)
        return out + self.scripts[x.script[x.words]]


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", switch: float = 10.0, smooth: float = 0.5, least_share: float = 0.01) -> Model:
    """A model of the rows whose language and text are not null.

    A language is a candidate for the scripts of at least ``least_share`` of
    its letters. A table without such rows gives a model without languages.
    """
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, last, part in _pieces(texts):
                x = Letters(part)
                names, which = np.unique(langs[first:last], return_inverse=True)
                letter = np.repeat(which, np.diff(x.letters))
                width = BUCKETS + 256
                found = np.bincount(letter * width + x.bucket, minlength=width * len(names))
                found += np.bincount(letter * width + BUCKETS + x.script, minlength=width * len(names))
                for k, name in enumerate(names.tolist()):
                    total[name] = total.get(name, 0) + found[k * width : (k + 1) * width]
        for name, t in total.items():
            feature = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(feature), pa.string()), pa.array(feature.astype(np.int32)), pa.array(t[feature])], ["lang", "feature", "n"])

    # at most BUCKETS + 256 rows a language
    found = rows.mapInArrow(count, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(found["lang"].unique().tolist())
    counts = np.zeros((BUCKETS + 256, len(languages)))
    counts[found["feature"].to_numpy(), [languages.index(x) for x in found["lang"]]] = found["n"]
    grams, scripts = counts[:BUCKETS] + smooth, counts[BUCKETS:]
    share = scripts / np.maximum(scripts.sum(axis=0), 1)
    known = share >= least_share
    cost = np.where(known | ~known.any(axis=1, keepdims=True), 0.0, -1000.0)
    return Model(languages, np.log(grams / grams.sum(axis=0)).astype(np.float32), cost.astype(np.float32), switch)


def best_paths(scores: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """The language number of each word on its text's best path; words of text d are first[d] .. first[d+1].

    All texts step together: step t holds the t-th words, longest texts first,
    so that the texts still running stand in front.
    """
    n_words = np.diff(first)
    total, k = scores.shape
    if not total:
        return np.zeros(0, np.int64)
    order = np.argsort(-n_words, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    active = np.searchsorted(-n_words[order], -np.arange(n_words.max() + 1), side="left")  # texts with more than t words
    begin = np.concatenate([[0], np.cumsum(active)])
    text = np.repeat(np.arange(len(n_words)), n_words)
    place = begin[np.arange(total) - first[text]] + rank[text]
    laid = np.empty_like(scores)
    laid[place] = scores
    own = np.arange(k, dtype=np.int16)
    back = np.empty((total, k), np.int16)
    state = np.zeros(active[0], np.int64)
    v = laid[: active[0]]
    for t in range(1, len(active)):
        a = active[t]
        state[a : len(v)] = v[a:].argmax(axis=1)  # texts that ended
        if not a:
            break
        before = v[:a]
        change = before.max(axis=1, keepdims=True) - np.float32(switch)
        stay = before >= change
        rows = slice(begin[t], begin[t] + a)
        back[rows] = np.where(stay, own, before.argmax(axis=1)[:, None])
        v = np.where(stay, before, change) + laid[rows]
    out = np.empty(total, np.int64)
    for t in range(len(active) - 2, -1, -1):
        a = active[t]
        rows = slice(begin[t], begin[t] + a)
        out[rows] = state[:a]
        if t:
            state[:a] = back[rows][np.arange(a), state[:a]]
    return out[place]


def label_texts(texts: list[str | None], model: Model) -> list[tuple[str, float, list]]:
    """(language, share of the letters, spans [{begin, stop, lang}] of words) of each text."""
    if not model.languages:
        return [(UNKNOWN, 0.0, [])] * len(texts)
    k, out = len(model.languages), []
    names, held, cells = model.languages, [], 0
    runs = list(_pieces(texts))
    for i, (_, _, part) in enumerate(runs):
        x = Letters(part)
        held.append((model.scores(x), np.diff(x.first), np.diff(np.append(x.words, len(x.bucket)))))
        cells += held[-1][0].size
        if cells < PATH_CELLS and i < len(runs) - 1:
            continue
        scores, n_words, length = (np.concatenate(c) for c in zip(*held, strict=True))
        held, cells = [], 0
        first = np.concatenate([[0], np.cumsum(n_words)])
        path = best_paths(scores, first, model.switch)
        text = np.repeat(np.arange(len(n_words)), n_words)
        votes = np.bincount(text * k + path, weights=length, minlength=len(n_words) * k).reshape(-1, k)
        new = np.ones(len(path), bool)
        new[1:] = (path[1:] != path[:-1]) | (text[1:] != text[:-1])
        spans = np.flatnonzero(new)
        stops = np.append(spans[1:], len(path))
        edge = np.searchsorted(spans, first)
        most, sums = votes.argmax(axis=1), votes.sum(axis=1)
        for d in range(len(n_words)):
            if not sums[d]:
                out.append((UNKNOWN, 0.0, []))
                continue
            s = slice(edge[d], edge[d + 1])
            where = zip((spans[s] - first[d]).tolist(), (stops[s] - first[d]).tolist(), path[spans[s]].tolist(), strict=True)
            out.append((names[most[d]], float(votes[d, most[d]] / sums[d]), [{"begin": b, "stop": e, "lang": names[p]} for b, e, p in where]))
    return out


def label(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: dict[str, Column] | None = None) -> DataFrame:
    """(id, the columns ``keep``, lang_pred, score, spans array<struct<begin, stop, lang>>) of each row.

    ``spans`` cover the words (runs of letters) begin..stop-1. A null text, or
    one without letters, is ``und`` with score 0 and no spans; of equally
    frequent languages the first by code point wins. Repeated rows get equal
    labels; null ids and other columns don't matter; an empty table gives no
    rows. Whole texts are labelled, of any length.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("id"), *(c.alias(n) for n, c in (keep or {}).items()), F.col(text_col).alias("__text"))
    out = rows.drop("__text").withColumns({"lang_pred": F.lit("").cast("string"), "score": F.lit(0.0), "spans": F.lit(None).cast("array<struct<begin:int,stop:int,lang:string>>")})
    columns = out.columns
    spans = pa.list_(pa.struct([("begin", pa.int32()), ("stop", pa.int32()), ("lang", pa.string())]))

    def run(batches):
        for b in batches:
            found = label_texts(b.column(b.num_columns - 1).to_pylist(), shared.value)
            made = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()), pa.array([x[2] for x in found], spans)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *made], columns)

    return rows.mapInArrow(run, out.schema)
