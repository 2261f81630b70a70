"""Quality by weak supervision: rules vote, EM weighs them, the posterior decides.

Every rule looks at counts of one text and votes good (1), bad (-1) or
abstains (0). Nobody knows the true quality: expectation-maximisation over all
documents' votes estimates the share of good documents and, for each rule, how
often it votes which way on good and on bad ones. A document is kept if its
posterior probability to be good is at least ``threshold``, so that one weak
rule can't reject it alone, and several can.

Documents with the same votes are alike to EM, so Spark counts the vote
patterns (at most 3^rules, whatever the input), the driver iterates over
those, and the posteriors per pattern are joined back.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.text import Rolling, Words, chunks, small_batches, splitmix
from hearth.session import scratch_path

WINDOW = 5
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", dtype=np.uint8))
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
STOPS = np.isin(np.arange(256), np.frombuffer(b".!?", dtype=np.uint8))
# Documents that a rule is taken to have judged before: [class bad, good][vote bad, good].
PRIOR = np.array([[4.0, 1.0], [1.0, 4.0]])
_WINDOWS = Rolling(0x9FB21C651E98DF25)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended_lines", "n_letter_words", "n_symbol_words")


def repeated_words(w: Words) -> np.ndarray:
    """For each word whether it stands in a 5-word window that its text holds twice or more."""
    n, covered = len(w), np.zeros(len(w) + 1, dtype=np.int64)
    text = w.text_of()
    starts = np.arange(max(0, n - WINDOW + 1))
    starts = starts[text[starts] == text[starts + WINDOW - 1]]
    if len(starts):
        h = _WINDOWS.slices(w.hashes(), starts, starts + WINDOW)
        h = splitmix(h + text[starts].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, back, times = np.unique(h, return_inverse=True, return_counts=True)
        starts = starts[times[back] > 1]
        np.add.at(covered, starts, 1)
        np.add.at(covered, starts + WINDOW, -1)
    return np.cumsum(covered)[:n] > 0


def _per_text(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[edges[1:]] - total[edges[:-1]]


def count_texts(column: pa.Array) -> list[np.ndarray]:
    """The counts of ``COUNTS`` of each text."""
    out = [np.zeros(len(column), dtype=np.int64) for _ in COUNTS]
    for row, last, data, offsets in chunks(column):
        w = Words(data, offsets)
        word_bytes = np.zeros(len(data) + 1, dtype=np.int8)
        np.add.at(word_bytes, w.starts, 1)
        np.subtract.at(word_bytes, w.ends, 1)
        in_word = np.cumsum(word_bytes[:-1], dtype=np.int8).astype(bool)
        holds = lambda kind: np.add.reduceat(kind[data], w.starts, dtype=np.int64) > 0 if len(w) else np.zeros(0, bool)
        lines = np.zeros((3, last - row), dtype=np.int64)
        raw = data.tobytes()
        for d in range(last - row):
            seen, found = set(), 0
            for line in raw[offsets[d] : offsets[d + 1]].split(b"\n"):
                bare = line.strip()
                if bare:
                    found += 1
                    lines[0, d] += line in seen
                    lines[2, d] += STOPS[bare[-1]]
                    seen.add(line)
            lines[1, d] = found
        values = (
            np.diff(w.first),
            _per_text(in_word & ((data & 0xC0) != 0x80), offsets),
            _per_text(SYMBOLS[data], offsets),
            lines[0],
            _per_text(repeated_words(w), w.first),
            lines[1],
            lines[2],
            _per_text(holds(LETTER), w.first),
            _per_text(holds(SYMBOLS), w.first),
        )
        for o, v in zip(out, values, strict=True):
            o[row:last] = v
    return out


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> DataFrame:
    """(id, text_hash, counts...) of each row; ``whole``: with the row itself, as the struct ``row``."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), (F.struct(*docs.columns) if whole else F.col(text_col)).alias("row"))
    schema = (rows if whole else rows.drop("row")).withColumns({c: F.lit(0).cast("long") for c in COUNTS}).schema
    names, at = schema.names, docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            row = b.column(2)
            texts = pc.struct_field(row, [at]) if whole else row
            yield pa.RecordBatch.from_arrays([*b.columns[: 3 if whole else 2], *map(pa.array, count_texts(texts))], names)

    return rows.mapInArrow(run, schema)


def _vote(value: Column, bad: Column, good: Column) -> Column:
    return F.when(value.isNull(), 0).when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """The votes, from the counts: shares per word and per line abstain where there is none."""
    words, lines = F.nullif(F.col("n_words"), F.lit(0)), F.nullif(F.col("n_lines"), F.lit(0))
    length, symbols = F.col("word_chars") / words, F.col("n_symbols") / words
    repeats, letters = F.col("n_repeat_words") / words, F.col("n_letter_words") / words
    marked = F.col("n_symbol_words") / words
    doubled, ended = F.col("n_dup_lines") / lines, F.col("n_ended_lines") / lines
    return {
        "size": _vote(F.col("n_words"), F.col("n_words") < 20, F.col("n_words") >= 50),
        "symbols": _vote(symbols, symbols > 0.1, symbols <= 0.02),
        "marked": _vote(marked, marked > 0.2, marked <= 0.05),
        "repeats": _vote(repeats, repeats > 0.15, repeats <= 0.05),
        "lines": _vote(doubled, doubled > 0.3, doubled <= 0.1),
        "word_length": _vote(length, (length < 3) | (length > 10), length.between(3.5, 8.5)),
        "letters": _vote(letters, letters < 0.8, letters >= 0.95),
        "ends": _vote(ended, ended < 0.3, ended >= 0.6),
    }


def estimate(patterns: np.ndarray, times: np.ndarray, steps: int = 200) -> tuple[np.ndarray, float, np.ndarray]:
    """EM over vote patterns (rows of -1/0/1) and how often each occurs.

    Returns the posterior of each pattern, the share of good documents and
    P(vote | class, the rule votes), shaped (class, rule, bad or good): an
    abstention says nothing of the class. It starts from the majority of the
    votes, and every rule starts with the few documents of ``PRIOR``.
    """
    times = times.astype(float)
    good = np.clip(0.5 + patterns.sum(axis=1) / (2 * max(1, patterns.shape[1])), 0.05, 0.95)
    hot = np.stack([patterns == v for v in (-1, 1)], axis=2).astype(float)  # pattern, rule, vote
    for _ in range(steps):
        weight = np.stack([(1 - good) * times, good * times])
        table = np.einsum("cp,prv->crv", weight, hot) + PRIOR[:, None, :]
        table /= table.sum(axis=2, keepdims=True)
        share = (weight[1].sum() + 1) / (times.sum() + 2)
        score = np.einsum("prv,crv->cp", hot, np.log(table)) + np.log([1 - share, share])[:, None]
        now = 1 / (1 + np.exp(np.clip(score[0] - score[1], -500, 500)))
        if np.abs(now - good).max() < 1e-10:
            break
        good = now
    return now, share, table


def _voted(counted: DataFrame) -> DataFrame:
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counted.select("*", *(v.alias(k) for k, v in rules().items()), failed.alias("base_failed"))


def _qualities(voted: DataFrame) -> DataFrame:
    """(a vote per rule, quality): the posterior of each pattern of votes, at most 3^rules rows."""
    names = list(rules())
    seen = voted.groupBy(*names).count().orderBy(*names).collect()
    votes = np.array([[r[n] for n in names] for r in seen]).reshape(-1, len(names))
    quality = estimate(votes, np.array([r["count"] for r in seen]))[0] if seen else []
    found = [(*v, float(q)) for v, q in zip(votes.tolist(), quality, strict=True)]
    return F.broadcast(voted.sparkSession.createDataFrame(found, ", ".join(f"{n} int" for n in names) + ", quality double"))


def _kept(voted: DataFrame, qualities: DataFrame, threshold: float) -> DataFrame:
    verdict = (~F.col("base_failed") & (F.col("quality") >= threshold)).alias("kept")
    return voted.join(qualities, list(rules())).select(*voted.columns, "quality", verdict)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """(id, text_hash, counts, a vote per rule, base_failed, quality, kept) of each row.

    ``base_failed``: under 10 words, or over a fifth of the words in repeated
    windows. ``quality`` is the posterior, ``kept`` is false where the base
    failed, else quality >= threshold. A null, empty or wordless text has zero
    counts and fails the base; null ids are rows like others; repeated rows
    vote each time; other columns are ignored; an empty table gives no rows.
    Texts of any length are counted whole.
    """
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "quality")
    _voted(counts(docs, id_col, text_col)).write.parquet(path)
    voted = spark.read.parquet(path)
    return _kept(voted, _qualities(voted), threshold)


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns. Texts are counted twice rather than shuffled."""
    qualities = _qualities(_voted(counts(docs, id_col, text_col)))
    return _kept(_voted(counts(docs, id_col, text_col, whole=True)), qualities, threshold).where("kept").select("row.*")
