import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hearth.llm import phrases
from tests.llm.helpers import documents, frame
from tests.oracle_compare import compare, duck

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10, top=2000, inside=50):
    """Rows of the result from (lang, text), counted without any proposal."""
    count, total = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            count.update((lang, tuple(words[i : i + k])) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    found = {}
    for (lang, p), a in count.items():
        if len(p) > 1 and a >= least:
            cuts = [(1_000_000 * a * a // (count[lang, p[:k]] * count[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found[lang, p] = (score, a, count[lang, p[:k]], count[lang, p[k:]])
    gone = {(lang, p[i : i + 2]) for (lang, p), x in found.items() if len(p) == 3 for i in (0, 1) if 100 * x[1] >= inside * found[lang, p[i : i + 2]][1]}
    out = []
    for lang in {k[0] for k in found}:
        best = sorted((-x[0], -x[1], " ".join(p).encode(), x) for (a, p), x in found.items() if a == lang and (a, p) not in gone)
        out += [(lang, i + 1, p.decode(), x[1], x[2], x[3], total[lang], x[0]) for i, (_, _, p, x) in enumerate(best[:top])]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def prose(n=400, seed=5):
    """Few words, many repeated passages, every kind of separator."""
    rnd = random.Random(seed)
    bag = [f"w{i}" for i in range(60)] + ["É", "New", "York", "x\x01y", "\x1c"]
    weights = [1 / (i + 1) for i in range(len(bag))]
    known = [rnd.choices(bag, weights, k=rnd.randint(2, 6)) for _ in range(30)]
    out = []
    for _ in range(n):
        words = []
        for _ in range(rnd.randint(0, 12)):
            words += rnd.choice(known) if rnd.random() < 0.4 else rnd.choices(bag, weights, k=3)
            words.append(rnd.choice(["", ".", ",", "\n", "\t", "a;b", "\x0b"]))
        out.append((rnd.choice(["en", "fr", None, "und"]), " ".join(words) if rnd.random() < 0.95 else None))
    return out


@pytest.mark.parametrize("share, sample_least", [(0.1, 2), (1.0, 10), (1.0, 25), (0.0, 1)])
def test_against_brute_force(spark, share, sample_least):
    rows = prose()
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    got = rows_of(phrases.mine(df, share=share, sample_least=sample_least))
    assert len(got) > 100 and got == brute(rows)


def test_passes_follow_the_border(spark):
    df = spark.createDataFrame(prose(), "lang string, text string")
    assert phrases.count_phrases(df, share=1.0, sample_least=10)[1] == 1  # the whole table proposes
    assert phrases.count_phrases(df, share=0.0)[1] == 3  # nothing proposed: words, then pairs, then triples


def test_top_and_inside(spark):
    rows = prose()
    df = spark.createDataFrame(rows, "lang string, text string")
    assert rows_of(phrases.mine(df, top=7, inside=20, least=5)) == brute(rows, 5, 7, 20)


def test_ties_are_ordered_by_bytes(spark):
    rows = [("en", f"{a} {b}.") for a, b in (("é", "z"), ("z", "é"), ("\U0001f98a", "～"), ("～", "\U0001f98a")) for _ in range(12)]
    df = spark.createDataFrame(rows, "lang string, text string")
    assert rows_of(phrases.mine(df)) == brute(rows)


def test_awkward_rows(spark):
    rows = documents() * 3
    df = frame(spark, rows).withColumn("a.b", F.lit(1)).withColumn("phrase", F.lit("p"))
    assert rows_of(phrases.mine(df)) == brute([(r[2], r[1]) for r in rows])
    assert phrases.mine(frame(spark, [])).count() == 0
    assert phrases.mine(spark.createDataFrame([(None, None), (None, "")], "lang string, text string")).count() == 0


def test_small_blocks(spark, monkeypatch):
    rows = prose(150)
    texts = {}
    for lang, text in rows:
        texts.setdefault(lang or "und", []).append(text or "")
    want = Counter()
    for lang, ts in texts.items():
        for t in ts:
            for size, found, n in phrases.Block(lang, [t]).counts(None, None):
                want.update({(lang, size, p): k for p, k in zip(found.to_pylist(), n.tolist(), strict=True)})
    got = Counter()
    for lang, ts in texts.items():
        for size, found, n in phrases.Block(lang, ts).counts(None, None):
            got.update({(lang, size, p): k for p, k in zip(found.to_pylist(), n.tolist(), strict=True)})
    assert got == want


def test_registered_query(spark):
    from hearth.llm.queries import ORACLE, QUERIES

    sf = "/root/testdata/sf0.001"
    assert compare(spark, duck(sf), "op12_phrases", QUERIES["op12_phrases"], ORACLE["op12_phrases"], sf)["ok"]
