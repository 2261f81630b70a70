import random
from itertools import combinations

import regex
from pyspark.sql import functions as F

from hearth.llm import lines
from tests.llm.helpers import documents, frame, groups


def form(line):
    return [w for w in regex.split(r"[^\p{L}\p{N}]+", line.lower()) if w]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def places_of(rows, hashes):
    """{(id is null, id, text hash, line): normal form} of every line with a word."""
    out = {}
    for r, h in zip(rows, hashes, strict=True):
        for i, line in enumerate((r[1] or "").split("\n")):
            if form(line):
                out[(r[0] is None, r[0] or 0, h, i)] = " ".join(form(line))
    return out


def brute(forms):
    """The group of each form, by comparing all by edit similarity and nothing else."""
    forms = sorted(set(forms))
    near = [(a, b) for a, b in combinations(range(len(forms)), 2) if abs(len(forms[a]) - len(forms[b])) <= max(len(forms[a]), len(forms[b])) * 0.2 + 1e-9]
    alike = [(a, b) for a, b in near if distance(forms[a], forms[b]) <= int(max(len(forms[a]), len(forms[b])) * 0.2 + 1e-9)]
    return dict(zip(forms, groups(len(forms), alike), strict=True))


def edited():
    """Lines of 40 words with a word spelt otherwise."""
    base = [f"{w}{i}" for i, w in enumerate(["red", "green", "blue", "dark"] * 10)]
    rows = []
    for k in range(60):
        words = list(base)
        words[k % 40] += "s" if k < 40 else "es"
        rows.append((2000 + k, " ".join(words), None, None, None, None, None, None))
    return rows


def found(spark, rows):
    """The places of ``rows``, and the result by place."""
    docs = frame(spark, rows)
    places = places_of(rows, [r[0] for r in docs.selectExpr("xxhash64(text)").collect()])
    got = {(r.id is None, r.id or 0, r.text_hash, r.line): r for r in lines.fuzzy_lines(docs).collect()}
    assert got.keys() == places.keys()
    return places, got


def test_groups_against_edit_similarity(spark):
    """Equal forms are in one group, groups join only what edit similarity joins, and near copies are found."""
    rows = [r for r in documents() if len(r[1] or "") < 2000][:25] + edited()
    places, got = found(spark, rows)
    truth = brute(places.values())
    of_form, members = {}, {}
    for p, f in places.items():
        assert of_form.setdefault(f, got[p].group) == got[p].group
        members.setdefault(got[p].group, set()).add(truth[f])
    assert all(len(x) == 1 for x in members.values())
    near = {of_form[places[p]] for p in places if 2000 <= p[1] < 2060}
    assert len(near) == 1  # sixty versions of a line, one group


def test_first_of_each_group_is_kept(spark):
    places, got = found(spark, [r for r in documents() if len(r[1] or "") < 40_000] + edited())
    first = {}
    for p in sorted(places):
        first.setdefault(got[p].group, p)
    assert {p for p, r in got.items() if r.kept} == set(first.values())


def test_rows_of_two_words_stay_below_all_pairs(spark):
    """Lines over the same words share a hash: they are compared with the first, then only between groups."""
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice("01") for _ in range(40)), *[None] * 6) for i in range(300)]
    places, got = found(spark, rows)
    assert len({got[p].group for p in places}) < 300


def test_stage_drops_the_lines(spark):
    docs = frame(spark)
    out = lines.drop_repeated_lines(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    holders = {}
    for r in out.collect():
        for line in (r.text or "").split("\n"):
            if form(line):
                holders.setdefault(" ".join(form(line)), set()).add((r.doc_id, r.text))
    assert all(len(x) == 1 for x in holders.values())  # repeated only in rows equal in id and text
    assert sum(r.text is None for r in out.collect()) == sum(r[1] is None for r in documents())


def test_plan_has_no_python(spark):
    plan = lines.fuzzy_lines(frame(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_table(spark):
    assert lines.fuzzy_lines(frame(spark, [])).count() == 0
    assert lines.drop_repeated_lines(frame(spark, [])).count() == 0


def test_pairs_by_words_or_letters(spark):
    """A pair is linked by its edit distance, whichever way it is decided: by words replaced, by few words that differ, or by letters."""
    rnd = random.Random(2)
    base = [f"word{i}" for i in range(30)]
    lines_ = [base, base[3:], base[:10] + ["new", "ones"] + base[10:], base[1:15] + ["long" * 20] + base[15:], base[::-1], ["x"], ["x", "y"]]
    lines_ += [[w[::-1] if rnd.random() < p else w for w in base if rnd.random() > p / 4] for p in (0.1, 0.2, 0.3, 0.5) for _ in range(4)]
    lines_ += [[f"{w}{i}" for i in range(n) for w in "ab"] for n in (600, 603)]  # more words than letters stand for
    texts = [" ".join(x) for x in lines_]
    forms = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "k1 long, form string, length int")
    pairs = [(i, j) for i, j in combinations(range(len(texts)), 2) if abs(len(texts[i]) - len(texts[j])) < 100]
    got = {tuple(r) for r in lines.verified(spark.createDataFrame(pairs, "a long, b long"), forms, 0.8).collect()}
    near = {(i, j) for i, j in pairs if len(texts[i]) < 1000 and distance(texts[i], texts[j]) <= int(max(len(texts[i]), len(texts[j])) * 0.2 + 1e-9)}
    assert got == near | {(len(texts) - 2, len(texts) - 1)} and len(near) > 20 and len(near) < len(pairs) - 20


def test_text_is_hashed_and_split_once_a_document(spark):
    plan = lines._lines(frame(spark).select(F.col("doc_id").alias("id"), "text"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("posexplode") < plan.index("xxhash64(text")  # below the generator, not once a line above
    needed = spark.createDataFrame([(k, 1, 0, k) for k in range(3)], "k1 long, id long, th long, pos int")
    docs = spark.createDataFrame([(1, "One, two\nTHREE\n4 five")], "id long, text string")
    found = lines._in_documents(docs, needed.withColumn("th", F.lit(docs.select(F.xxhash64("text")).first()[0])))
    assert sorted(map(tuple, found.collect())) == [(0, "one two", 7), (1, "three", 5), (2, "4 five", 6)]
