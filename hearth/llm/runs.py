"""Periodic runs of words: Lyndon arrays by grouping, roots extended to runs.

The first phase of a grouping suffix sorter puts suffixes with the same
longest Lyndon prefix into one group. Groups are taken from the highest down:
every place of a group looks left for the nearest place of a lower group, and
that one's prefix grows by the group's prefix, as often as places of the group
look at it. When its group is taken, the length of a place's prefix is its
entry of the Lyndon array. The phase is done under the order of the words and
under the reversed order: each run has, under one of the two, its Lyndon root
as the longest Lyndon word at some place. Roots that repeat are extended to
both sides as long as words one period apart agree.

A run of four periods holds each of its words four times. Texts are first
parted at words that occur less often in their part, until nothing changes;
no run crosses such a word, so only the remaining stretches are grouped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm.text import IS_SPACE, SPACE, Words, chunks, map_batches, quoted, small_batches

# A run is at least this many words and periods long.
LEAST_WORDS, LEAST_PERIODS = 6, 4


def lyndon_array(word: list[int]) -> list[int]:
    """The length of the longest Lyndon word that begins at each place (smaller numbers are smaller words)."""
    n = len(word)
    length = [1] * n
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))  # the places of groups not taken yet, as a linked list
    members: list[list[int]] = []
    numbers: dict[int, int] = {}
    for w in sorted(set(word)):
        numbers[w] = len(members)
        members.append([])
    group = [numbers[w] for w in word]
    for i, g in enumerate(group):
        members[g].append(i)
    lower = list(range(-1, len(members) - 1))  # the next lower and the next higher group
    higher = list(range(1, len(members) + 1))
    at = len(members) - 1
    while at >= 0:
        taken = [i for i in members[at] if group[i] == at]
        members[at] = []
        size = length[taken[0]] if taken else 0
        seen: list[int] = []  # the places looked at, and how often; rising, as ``taken`` is
        times: list[int] = []
        for i in taken:
            a, b = left[i], right[i]
            if b < n:
                left[b] = a
            if a >= 0:
                right[a] = b
                if seen and seen[-1] == a:
                    times[-1] += 1
                else:
                    seen.append(a)
                    times.append(1)
        grown: dict[int, dict[int, list[int]]] = {}
        for j, k in zip(seen, times, strict=True):
            length[j] += k * size
            grown.setdefault(group[j], {}).setdefault(k, []).append(j)
        for old, by_times in grown.items():  # the more often looked at, the higher; all above those that were not
            for k in sorted(by_times, reverse=True):
                new, over = len(members), higher[old]
                members.append(by_times[k])
                for j in by_times[k]:
                    group[j] = new
                lower.append(old)
                higher.append(over)
                lower[over], higher[old] = new, new
        at = lower[at]
    return length


def _common(data: bytes, a: int, b: int, stop: int) -> int:
    """How many numbers (four bytes each) agree from places a < b on, up to ``stop`` of them."""
    done, step = 0, 4
    while done < stop:
        step = min(step, stop - done)
        if data[4 * (a + done) : 4 * (a + done + step)] == data[4 * (b + done) : 4 * (b + done + step)]:
            done += step
            step *= 2
        elif step == 1:
            break
        else:
            step = max(1, step // 4)
    return done


def runs_of(word: list[int], least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of the maximal runs, by start, then period."""
    n, found = len(word), set()
    data = np.array(word, np.int32).tobytes()
    for order in (word, [-w for w in word]):
        ends: dict[int, int] = {}  # of the last run of each period
        roots = lyndon_array(order)
        for i, p in enumerate(roots):
            # the first root of a run is followed by all but one of its periods
            if i + (least_periods - 1) * p > n or i + p >= n or word[i] != word[i + p] or ends.get(p, 0) >= i + p:
                continue
            end = i + p + _common(data, i, i + p, n - i - p)
            if end - i < (least_periods - 1) * p:
                continue
            start = i
            while start and word[start - 1] == word[start - 1 + p]:
                start -= 1
            ends[p] = end
            if end - start >= max(least_words, least_periods * p):
                found.add((start, end - start, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(codes: np.ndarray, text: np.ndarray, least_words: int, least_periods: int) -> list[tuple[int, int]]:
    """Begin and end of the stretches that can hold runs: each word often enough within its own stretch."""
    place, part, codes = np.arange(len(codes)), text.astype(np.int64), codes.astype(np.int64)
    width = int(codes.max()) + 1 if len(codes) else 1
    while len(place):
        _, number, count = np.unique(part * width + codes, return_inverse=True, return_counts=True)
        often = count[number] >= least_periods
        before = len(place)
        place, codes, part = place[often], codes[often], part[often]
        fresh = np.ones(len(place), bool)
        fresh[1:] = (place[1:] != place[:-1] + 1) | (part[1:] != part[:-1])
        part = np.cumsum(fresh)
        keep = np.bincount(part)[part] >= least_words
        place, codes, part = place[keep], codes[keep], part[keep]
        if before - len(place) <= before >> 3:  # hardly a change: the rest is small or made of runs
            break
    edge = np.flatnonzero(part[1:] != part[:-1]) + 1
    begins, ends = np.concatenate([[0], edge]), np.concatenate([edge, [len(place)]])
    return [(int(place[a]), int(place[b - 1]) + 1) for a, b in zip(begins, ends, strict=True) if a < b]


def _found(texts: pa.Array, least_words: int, least_periods: int):
    """(words, runs, collapsed text) of each text."""
    for _, _, data, offsets in chunks(texts):
        w = Words(data, offsets)
        raw = data[~IS_SPACE[data]]
        edges = np.concatenate([[0], np.cumsum(w.ends - w.starts)]).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(w), [None, pa.py_buffer(edges), pa.py_buffer(raw)])
        codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        text = w.text_of()
        runs: dict[int, list[tuple[int, int, int]]] = {}
        for a, b in stretches(codes, text, least_words, least_periods):
            shift = a - int(w.first[text[a]])
            some = runs_of(codes[a:b].tolist(), least_words, least_periods)
            if some:
                runs.setdefault(int(text[a]), []).extend((s + shift, k, q) for s, k, q in some)
        content = data.tobytes()
        for d in range(len(offsets) - 1):
            own = content[offsets[d] : offsets[d + 1]].split()
            mine = runs.get(d, [])
            if mine:
                kept = np.ones(len(own), bool)
                for s, k, q in mine:
                    kept[s + q : s + k] = False
                own_kept = [own[i] for i in np.flatnonzero(kept).tolist()]
            else:
                own_kept = own
            yield len(own), mine, b" ".join(own_kept).decode()


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> DataFrame:
    """(id, text_hash, n_words, runs array<struct<start, length, period>>, collapsed) of each row.

    A run is a stretch of words, at least ``least_words`` words and
    ``least_periods`` (2 or more) smallest periods long, that can't be made
    longer on either side; start counts words from 0. ``collapsed`` holds the
    words that no run has after its first period, joined by one space. Null
    and empty texts have no words and no runs; null ids and repeated rows are
    rows like others; other columns are ignored; an empty table gives no
    rows. Each text is searched whole, in one task.
    """
    if least_periods < 2:
        raise ValueError("a run has two periods at least")
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"))
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    names = ["id", "text_hash", "n_words", "runs", "collapsed"]

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                done = [*_found(part.column(2), least_words, least_periods)]
                runs = [[{"start": s, "length": k, "period": q} for s, k, q in x[1]] for x in done]
                columns = [pa.array([x[0] for x in done], pa.int64()), pa.array(runs, run_type), pa.array([x[2] for x in done], pa.string())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], names)

    sent = rows.select("id", F.xxhash64("text").alias("text_hash"), "text")
    one = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
    fields = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(one)), T.StructField("collapsed", T.StringType())]
    return map_batches(sent, run, T.StructType([*sent.schema.fields[:2], *fields]))


def with_repeats(id_col: str, text_col: str) -> Column:
    """Texts of which one in ten (by the id's crc32) gets a periodic end, as ``op13`` asks for."""
    h = F.crc32(F.col(quoted(id_col)).cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split(quoted(text_col), SPACE), lambda w: w != "")

    def repeated(w: Column) -> Column:
        a = g % F.size(w)
        p = 1 + F.floor((F.size(w) - a) / (3 + g % 8))
        at = F.transform(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.element_at(w, (F.when(i >= a, a + (i - a) % p).otherwise(i) + 1).cast("int")))
        return F.when(F.size(w) > 0, F.array_join(at, " ")).otherwise("")

    # inside transform() the words are computed once, not for each word
    return F.when(h % 10 == 0, F.transform(F.array(words), repeated)[0]).otherwise(F.col(quoted(text_col)))
