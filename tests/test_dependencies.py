import random
from itertools import combinations

import pytest

from hearth.operators.dependencies import discover_dependencies

SCHEMA = "id long, type string, subtype string, zip string, city string, flag boolean, x double"
COLUMNS = ["id", "type", "subtype", "zip", "city", "flag", "x"]


def brute(rows, columns, most):
    at = {c: COLUMNS.index(c) for c in columns}

    def holds(s, c):
        seen = {}
        return all(seen.setdefault(tuple(r[at[x]] for x in s), r[at[c]]) == r[at[c]] for r in rows)

    out, found = set(), set()
    for k in range(1, most + 1):
        for s in combinations(columns, k):
            parts = [p for j in range(1, k) for p in combinations(s, j)]
            if any((p, c) in found for p in parts for c in s if c not in p):
                continue
            for c in columns:
                if c not in s and not any((p, c) in found for p in parts) and rows and holds(s, c):
                    out.add((",".join(s), c, len({tuple(r[at[x]] for x in s) for r in rows})))
        found |= {(tuple(d.split(",")), c) for d, c, _ in out}
    return out


def table(seed, n=80):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        kind = rnd.choice(["A", "B", None])
        sub = None if kind is None else kind + rnd.choice(["1", "2"])
        zip_code, city = rnd.choice(["1", "2", "3", None]), rnd.choice(["x", "y", None])
        rows.append((i, kind, sub, zip_code, city, {"x": True, "y": False}.get(city), None if zip_code is None else float(len(sub or "")) + int(zip_code)))
    return rows + rows[:5]


@pytest.mark.parametrize("one_in", [1, 3])
@pytest.mark.parametrize("seed", [0, 1])
def test_against_all_sets(spark, seed, one_in):
    rows = table(seed)
    for columns in (COLUMNS, COLUMNS[1:], COLUMNS[1:4]):
        got = discover_dependencies(spark.createDataFrame(rows, SCHEMA), columns, one_in=one_in).collect()
        assert {tuple(r) for r in got} == brute(rows, columns, 2) and len(got) == len(set(got))


def test_three_columns_and_null_places(spark):
    rows = [(i, a, b, c, str((a, b, c)), None, None) for i, (a, b, c) in enumerate((a, b, c) for a in ("p", None) for b in ("p", None) for c in ("p", "q", None))] * 2
    columns = ["type", "subtype", "zip", "city"]
    got = {tuple(r) for r in discover_dependencies(spark.createDataFrame(rows, SCHEMA), columns, most=3).collect()}
    assert got == brute(rows, columns, 3) and ("type,subtype,zip", "city", 12) in got


def test_subtype_type_is_found_and_zip_city_is_not(spark):
    from hearth.registry import cleaned

    columns = ["listing_id", "item_type", "item_subtype", "zipcode", "city"]
    got = {(r.determinant, r.dependent) for r in discover_dependencies(cleaned(spark, "/root/testdata/sf0.001"), columns).collect()}
    assert {("listing_id", "city"), ("item_subtype", "item_type")} <= got and ("zipcode", "city") not in got


def test_empty_and_constant(spark):
    assert discover_dependencies(spark.createDataFrame([], SCHEMA), COLUMNS).count() == 0
    rows = [(i, "A", None, None, None, None, None) for i in range(3)]
    got = {tuple(r) for r in discover_dependencies(spark.createDataFrame(rows, SCHEMA), ["id", "type"]).collect()}
    assert got == {("id", "type", 3)}


def test_values_collapse_before_the_shuffle(spark, monkeypatch):
    """The grouping by values has a partial aggregate on the map side, and hashes are aggregated in code-generated maps."""
    from pyspark.sql import functions as F

    from hearth.operators import dependencies

    plans = []
    collect = type(spark.range(1)).collect

    def spy(frame):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return collect(frame)

    monkeypatch.setattr(type(spark.range(1)), "collect", spy)
    rows = spark.range(1000).select((F.col("id") % 3).alias("a"), (F.col("id") % 6).alias("b"))
    dependencies.discover_dependencies(rows, ["a", "b"])
    assert plans and all("partial_min" in p and "SortAggregate" not in p for p in plans)
