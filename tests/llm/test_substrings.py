from collections import Counter

from hearth.llm import substrings
from tests.llm.helpers import documents, frame, words


def brute(rows, window):
    texts = [words(r[1]) for r in rows]
    seen = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for r, w in zip(rows, texts, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((r[0], len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return Counter(out)


def test_against_brute_force(spark):
    for window in (4, 35):
        got = substrings.remove_repeats(frame(spark), window=window).collect()
        assert Counter((r.id, r.n_words, r.n_removed, r.kept) for r in got) == brute(documents(), window)
        for r in got:
            spans = [(s.begin, s.stop) for s in r.removed]
            assert sum(b - a for a, b in spans) == r.n_removed
            assert all(x[1] < y[0] for x, y in zip(spans, spans[1:], strict=False))  # maximal


def test_registered_query(spark):
    import hashlib

    from hearth.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = Counter((i, n, k, hashlib.sha256(t.encode()).hexdigest()) for (i, n, k, t), m in brute(rows, 35).items() for _ in range(m))
    assert Counter(tuple(r) for r in QUERIES["op7_substrings"](spark, sf).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()) == want


def test_words_that_collide_modulo_a_power_of_two(spark):
    """Two windows that differ only in two Thue-Morse words of 4,096 letters are not the same."""
    a = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))
    b = a.translate(str.maketrans("ab", "ba"))
    head = [f"w{i}" for i in range(34)]
    rows = [(i, " ".join([*head, w]), *[None] * 6) for i, w in enumerate((a, b))]
    assert {r.n_removed for r in substrings.remove_repeats(frame(spark, rows)).collect()} == {0}
    long = "x" * (1 << 21)
    rows = [(i, " ".join([*head, *["pad"] * i, long]), *[None] * 6) for i in (0, 1)] + [(2, " ".join([*head, long]), *[None] * 6)]
    got = {r.id: r.n_removed for r in substrings.remove_repeats(frame(spark, rows)).collect()}
    assert got == {0: 35, 1: 0, 2: 35}


def test_one_row_many_times(spark):
    """A row that holds most of the table falls into no group whole, and others that share its windows are cut too."""
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(1, text, *[None] * 6)] * 3000 + [(1, "short", *[None] * 6)] * 5 + [(2, text + " more", *[None] * 6), (3, None, *[None] * 6), (3, None, *[None] * 6)]
    got = Counter((r.id, r.n_words, r.n_removed, r.kept) for r in substrings.remove_repeats(frame(spark, rows)).collect())
    assert got == brute(rows, 35)


def test_empty_table(spark):
    assert substrings.remove_repeats(frame(spark, [])).count() == 0


def test_sql(spark):
    from hearth.llm.queries import ORACLE, QUERIES
    from tests.oracle_compare import compare, duck

    sf = "/root/testdata/sf0.01"
    assert compare(spark, duck(sf), "op7_substrings", QUERIES["op7_substrings"], ORACLE["op7_substrings"], sf)["ok"]
