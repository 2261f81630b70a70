from collections import Counter, defaultdict

from hearth.llm import mixing
from tests.llm.helpers import documents, frame, words


def test_targets_share_out_again():
    assert mixing.targets([("a", 10), ("b", 900), ("c", 1000)]) == [20.0, 1800.0, 1045.0]
    assert mixing.targets([]) == [] and mixing.targets([("a", 0)]) == [0.0]
    sizes = [(f"s{i:02d}", 100 * (i % 7 + 1)) for i in range(20)]
    got = mixing.targets(sizes)
    assert abs(sum(got) - 1.5 * sum(s for _, s in sizes)) < 1e-6
    assert all(t <= 2 * s for t, (_, s) in zip(got, sizes, strict=True))
    free = [t / (5, 2, 1)[i % 3] for i, (t, (_, s)) in enumerate(zip(got, sizes, strict=True)) if t < 2 * s]
    assert max(free) - min(free) < 1e-6  # the others share by weight


def test_rows_and_targets(spark):
    got = mixing.Mix(frame(spark), block=16).taken().collect()
    rows = documents()
    assert Counter((r.id, r.source, r.size) for r in got) == Counter((r[0], r[3], len(words(r[1]))) for r in rows)
    by = defaultdict(list)
    for r in got:
        by[r.source].append(r)
    order = sorted(by, key=lambda s: (s is None, (s or "").encode()))
    want = mixing.targets([(s, sum(r.size for r in by[s])) for s in order])
    for s, t in zip(order, want, strict=True):
        assert {r.target for r in by[s]} == {t} and {r.source_size for r in by[s]} == {sum(r.size for r in by[s])}
        assert abs(sum(r.taken for r in by[s]) - t) <= 3 * 16
        assert all(r.taken <= 2 * r.size for r in by[s])


def test_every_slot_has_its_block(spark):
    """Each slot's segments are the next block of tokens of its source."""
    mix = mixing.Mix(frame(spark), block=16)
    size = {r.sid: r.source_size for r in mix.documents.collect()}
    slots = {r.slot: r for r in mix.slots.collect()}
    for sid in size:
        ranks = sorted((r.slot, r["rank"]) for r in slots.values() if r.sid == sid)
        assert [k for _, k in ranks] == list(range(len(ranks)))
    got = defaultdict(list)
    for r in mix.segments().collect():
        at = r.start + r.epoch * size[r.sid]
        got[r.slot].append((at + r.begin, at + r.stop))
    for slot, r in slots.items():
        begin, stop = 16 * r["rank"], min(16 * (r["rank"] + 1), 2 * size[r.sid])
        parts = sorted(got[slot])
        if begin < stop:
            assert parts[0][0] == begin and parts[-1][1] == stop
            assert all(x[1] == y[0] for x, y in zip(parts, parts[1:], strict=False))


def test_reruns_agree_whatever_the_partitions(spark):
    a = mixing.Mix(frame(spark).repartition(1)).taken().collect()
    b = mixing.Mix(frame(spark).repartition(7)).taken().collect()
    assert Counter(a) == Counter(b)


def test_one_row_many_times(spark):
    """Copies of one row, some with other columns, are taken as often as the mix says, and part in the shuffled order."""
    text = "five words are in here"
    rows = [(1, text, "en", "a", 1, None, None, None)] * 9000 + [(1, text, "fr", "a", 1, None, None, None)] * 500
    rows += [(i, text + " and more", "en", "b", 1, None, None, None) for i in range(2, 4000)]
    docs = frame(spark, rows).repartition(8)
    mix = mixing.Mix(docs, block=16)
    got = mix.taken().collect()
    assert Counter((r.id, r.size) for r in got) == Counter((r[0], len(words(r[1]))) for r in rows)
    assert max(r["count"] for r in mix.documents.groupBy("sid", "piece").count().collect()) < 2 * mixing.PIECE_ROWS
    copies = [r for r in got if r.id == 1]
    assert abs(sum(r.taken for r in copies) - copies[0].target) <= 48 and all(r.taken <= 10 for r in copies)
    out = mixing.mixed_documents(docs, block=16)
    times = Counter((r.doc_id, r.lang) for r in out.collect())
    assert times[(1, "en")] + times[(1, "fr")] == sum(int(r.taken / r.size + 0.5) for r in copies)
    per = [times[(1, "en")] / 9000, times[(1, "fr")] / 500]
    assert all(int(sum(times[(1, x)] for x in ("en", "fr")) / 9500) <= p <= 1 + int(sum(times[(1, x)] for x in ("en", "fr")) / 9500) for p in per)


def test_column_names_with_dots(spark):
    docs = frame(spark).withColumnRenamed("h", "a.b")
    assert mixing.mixed_documents(docs).columns == docs.columns


def test_stage_repeats_rows(spark):
    docs = frame(spark)
    taken = mixing.Mix(docs).taken().collect()
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    want = Counter()
    for r in taken:
        if r.size:
            want[(r.id, r.text_hash)] += int(r.taken / r.size + 0.5)
    got = Counter((r[0], r[1]) for r in out.selectExpr("doc_id", "xxhash64(text)").collect())
    assert got == +want


def test_empty_table(spark):
    assert mixing.Mix(frame(spark, [])).taken().count() == 0
    assert mixing.mixed_documents(frame(spark, [])).count() == 0
