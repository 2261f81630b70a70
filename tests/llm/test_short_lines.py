"""Lines of any length with a word are grouped when equal."""

from hearth.llm import lines
from tests.llm.helpers import frame


def test_short_lines(spark):
    texts = ["Read more\nown first line", "read MORE!\n\n--\nOne", "one\nread mores", None]
    docs = frame(spark, [(i, t, *[None] * 6) for i, t in enumerate(texts)])
    got = {(r.id, r.line): r.kept for r in lines.fuzzy_lines(docs).collect()}
    assert got == {(0, 0): True, (0, 1): True, (1, 0): False, (1, 3): True, (2, 0): False, (2, 1): True}
    left = {r.doc_id: r.text for r in lines.drop_repeated_lines(docs).collect()}
    assert left == {0: texts[0], 1: "\n--\nOne", 2: "read mores", 3: None}
