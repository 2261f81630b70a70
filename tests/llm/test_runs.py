import hashlib
import random
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from hearth.llm import runs
from tests.llm.helpers import documents, frame, words


def brute_lyndon(w):
    """The longest Lyndon word at i ends where the next smaller suffix begins."""
    return [next((j for j in range(i + 1, len(w)) if w[j:] < w[i:]), len(w)) - i for i in range(len(w))]


def brute_runs(w, least_words=6, least_periods=4):
    """Every stretch by its definition: for each period all maximal stretches of equal words, least period first."""
    out, n = [], len(w)
    for q in range(1, n // least_periods + 1):
        i = 0
        while i + q < n:
            k = i
            while k + q < n and w[k] == w[k + q]:
                k += 1
            if k > i and k + q - i >= max(least_words, least_periods * q) and not any(q % d == 0 and all(w[x] == w[x + d] for x in range(i, k + q - d)) for d in range(1, q)):
                out.append((i, k + q - i, q))
            i = max(k, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, found):
    gone = {i for s, k, q in found for i in range(s + q, s + k)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def sequences(seed, n):
    rnd = random.Random(seed)
    for _ in range(n):
        kind, size = rnd.random(), rnd.randint(0, 60)
        if kind < 0.4:
            yield [rnd.randrange(rnd.choice([1, 2, 3, 9])) for _ in range(size)]
        elif kind < 0.8:
            base = [rnd.randrange(3) for _ in range(rnd.randint(1, 6))]
            w = (base * 20)[:size]
            for _ in range(rnd.randint(0, 2)):
                if w:
                    w[rnd.randrange(len(w))] = rnd.randrange(4)
            yield w
        else:
            a, b = [0], [0, 1]
            while len(b) < size:
                a, b = b, b + a
            yield b[:size]


def test_lyndon_arrays():
    for w in sequences(1, 3000):
        assert runs.lyndon_array(w) == brute_lyndon(w), w
        turned = [-x for x in w]
        assert runs.lyndon_array(turned) == brute_lyndon(turned), w


@pytest.mark.parametrize("least_words, least_periods", [(6, 4), (1, 2), (5, 3)])
def test_runs(least_words, least_periods):
    for w in sequences(2, 2000):
        assert runs.runs_of(w, least_words, least_periods) == brute_runs(w, least_words, least_periods), w


def test_long_sequences_stay_linear():
    n = 60_000
    assert runs.runs_of([7] * n) == [(0, n, 1)]
    assert runs.runs_of([*range(1000)] * 60) == [(0, n, 1000)]
    assert runs.runs_of([*range(n)]) == [] and runs.runs_of([*range(n, 0, -1)]) == []


def test_table(spark):
    rows = documents() + [(2000 + i, " ".join(f"w{x}" for x in w), None, None, None, None, None, None) for i, w in enumerate(sequences(3, 200))]
    rows += [(3000, "so so so so so so it it it it it it\n so", None, None, None, None, None, None), (3001, "a b " * 900 + "c " * 900, None, None, None, None, None, None)]
    df = frame(spark, rows).withColumn("a.b", F.lit(1)).withColumn("runs", F.lit(1))
    want = sorted(repr((r[0], len(w), found, collapsed(w, found))) for r in rows for w in [words(r[1])] for found in [brute_runs(w) if len(w) < 5000 else []])
    got = sorted(repr((r.id, r.n_words, [tuple(x) for x in r.runs], r.collapsed)) for r in runs.find_runs(df).collect())
    assert got == want
    assert runs.find_runs(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        runs.find_runs(df, least_periods=1)


def test_registered_query(spark):
    from hearth.llm.queries import QUERIES

    sf, sha = "/root/testdata/sf0.001", lambda s: hashlib.sha256(s.encode()).hexdigest()
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op13_runs"](spark, sf).collect()}
    assert got.keys() == text.keys()
    planted = 0
    for i, t in text.items():
        w, h = words(t), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and w:
            planted += 1
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))]
        if len(w) > 2500:
            continue
        found, r = brute_runs(w), got[i]
        best = max(found, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2])) if found else None
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *(best or (None,) * 3)), i
        assert r.exponent_milli == (1000 * best[1] // best[2] if best else None)
        assert r.runs_sha256 == sha("".join(f"{s},{k},{q}\n" for s, k, q in found)) and r.collapsed_sha256 == sha(collapsed(w, found))
    assert planted > 10 and any(r.n_runs for r in got.values())
