"""Small tables with the awkward cases, and plain versions of the shared rules."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# ``extra`` names clash with those that the operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, h string, row string"


def words(text):
    return WORD.findall(text or "")


def documents(seed=3, n=60):
    """Rows with nulls in every column, empty, blank and long texts, copies, near copies and repeated rows."""
    rnd = random.Random(seed)
    bag = ["alpha", "béta", "gamma", "delta", "eps", "zeta,", "eta.", "theta", "ιώτα", "kappa", "λ", "mu#", "Nu", "xi"]
    lines = [" ".join(rnd.choice(bag) for _ in range(rnd.randint(6, 30))) + "." for _ in range(40)]
    rows = []
    for i in range(n):
        text = "\n".join(rnd.choice(lines) if rnd.random() < 0.3 else " ".join(rnd.choice(bag) for _ in range(rnd.randint(3, 40))) for _ in range(rnd.randint(1, 8)))
        rows.append([i * 3, text, rnd.choice(["en", "fr", None]), rnd.choice(["a", "b", "ç", "z", None]), len(text)])
    rows += [[1000, rows[0][1], "en", "a", 1], [1001, rows[0][1] + " more", None, "b", None], [1002, rows[5][1].replace("alpha", "omega", 1), "fr", "a", 5]]
    rows += [[1003, None, None, None, None], [1004, "", "en", "a", 0], [1005, " \t\n\x0b ", "en", "b", 5], [1006, "one", "en", "b", 3], [1007, "ONE", "en", "b", 3], [1008, "one two", "fr", "a", 7]]
    rows += [[None, rows[1][1], "en", "a", 1], [None, "a null id and some words that are its own, seven of them", "en", "a", 1], [None, None, None, None, None]]
    rows += [rows[2], rows[2], rows[2], [1003, None, None, None, None]]
    rows += [[1010, " ".join(rnd.choice(bag) for _ in range(30_000)), "en", "z", 1], [1011, "x" * 50_000, "en", "z", 1], [1012, "\n" * 3000 + "end", None, "a", 1]]
    return [(*r, str(k % 3) if k % 4 else None, "h", None) for k, r in enumerate(rows)]


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA)


def groups(n, linked):
    """The least member of each node's group; ``linked``: pairs of 0..n-1."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]
