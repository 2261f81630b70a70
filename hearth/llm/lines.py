"""Fuzzy line deduplication with DataFrame functions only.

Lines are normalised (lower case, words of letters and digits). Equal lines
are one line from then on. Each gets a 64-bit SimHash of its distinct words;
hashes are cut into five blocks, and lines meet if two blocks agree (ten ways
to pick the two) and all in all at most MAX_BITS bits differ. All lines within
three bits meet, since three bits can't lie in four blocks; lines further
apart meet the more likely the fewer bits differ. Pairs are verified by edit
similarity. Of each connected group one occurrence stays: the first by id,
text hash and line number.

Many versions of one line make many pairs, and most say nothing new. So first
one line stands for each hash, each hash is compared with two others it meets
(the least and the greatest that come first in a block), and groups are formed. Then blocks
that hold several groups give the pairs between different groups that were not
compared yet, which are verified in turn. The groups are those of all pairs.

Counting the bits: 21 sums hold three counters of 21 bits each, and one more
sum the last bit, so that Spark adds up 22 columns instead of 64, and compares
three counters at once. That holds for lines of up to half a million words;
the hash of a longer line is still the same for the same words.

Edit distances are taken of what is left between the first and the last words
that differ, which doesn't change them. Where so few words differ that the
longest of them would still be near enough, letters are not compared.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.components import components
from hearth.llm.text import once, quoted
from hearth.session import scratch_path

MAX_BITS = 10
# First bit and width of each block; two of five agree if at most three bits differ.
BLOCKS = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]
LANE = 21
_EVERY_LANE = 1 | 1 << LANE | 1 << 2 * LANE
_HALF_LANES = ((1 << LANE - 2) - 1) * _EVERY_LANE
FILTER_BITS = 22
# Letters that stand for the words of a pair, to count the words that differ.
LETTERS = [chr(0x4E00 + i) for i in range(1000)]


def normal_words(line: Column) -> Column:
    return F.array_remove(F.split(F.lower(line), r"[^\p{L}\p{N}]+"), "")


def _lines(docs: DataFrame) -> DataFrame:
    """(id, th, pos, k1, k2, words) of the lines of (id, text) with a word; k1, k2: two hashes of the words."""
    # the text's hash comes first: beside the generator it would be taken again for each line
    rows = docs.select("id", F.xxhash64("text").alias("th"), "text").select("id", "th", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    rows = rows.select("id", "th", "pos", once(normal_words(F.col("line"))).alias("words")).where(F.size("words") > 0)
    return rows.select("id", "th", "pos", F.xxhash64("words").alias("k1"), F.xxhash64(F.lit(1), "words").alias("k2"), "words")


def simhashes(lines: DataFrame) -> DataFrame:
    """``lines`` (id, th, pos, k1, k2, words) with ``sim`` for words: a bit is 1 if over half the hashes of the distinct words have it.

    Each word counts once: else the few most frequent words of a language would
    decide the hashes of its long lines, and unlike lines would meet.
    """
    each = lines.select("id", "th", "pos", "k1", "k2", F.explode(F.array_distinct("words")).alias("word")).select("id", "th", "pos", "k1", "k2", F.xxhash64("word").alias("h"))
    bit = lambda i: F.shiftrightunsigned("h", i)
    sums = [F.sum(bit(i).bitwiseAND(F.lit(_EVERY_LANE))).alias(f"s{i}") for i in range(LANE)]
    summed = each.groupBy("id", "th", "pos", "k1", "k2").agg(F.count("*").alias("n"), F.sum(bit(63)).alias("s63"), *sums)
    # in every lane 2 * counter + 2^20 - 1 - n reaches bit 20 if 2 * counter > n
    n = F.col("n").bitwiseAND(F.lit((1 << LANE - 2) - 1))
    short = ((1 << LANE - 1) - 1 - n) * F.lit(_EVERY_LANE)
    over = [F.shiftleft(F.shiftrightunsigned(F.shiftleft(F.col(f"s{i}").bitwiseAND(F.lit(_HALF_LANES)), 1) + F.col("short"), LANE - 1).bitwiseAND(F.lit(_EVERY_LANE)), i) for i in range(LANE)]
    last = F.when(2 * F.col("s63") > F.col("n"), F.lit(-(1 << 63))).otherwise(F.lit(0)).cast("long")
    summed = summed.select("*", once(short).alias("short"))
    return summed.select("id", "th", "pos", "k1", "k2", reduce(lambda a, b: a.bitwiseOR(b), [*over, last]).alias("sim"))


def block_keys(sim: Column) -> Column:
    """One key for each two blocks: the number of the choice, and the bits of both."""
    part = lambda b: F.shiftrightunsigned(sim, b[0]).bitwiseAND(F.lit((1 << b[1]) - 1))
    keys = [F.lit(k << 32) + part(a) * F.lit(1 << 13) + part(b) for k, (a, b) in enumerate(combinations(BLOCKS, 2))]
    return F.array(*keys)


def _close(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= MAX_BITS


def shared_blocks(sims: DataFrame) -> DataFrame:
    """(key, sim) of the distinct hashes ``sim`` that share two blocks with a close one. A hash is found by the first
    match in its block, so that many versions of a line make no pairs here."""
    placed = sims.select(F.explode(block_keys(F.col("sim"))).alias("key"), "sim")
    other = placed.select(F.col("key").alias("key_b"), F.col("sim").alias("sb"))
    return placed.join(other, (F.col("key") == F.col("key_b")) & (F.col("sim") != F.col("sb")) & _close("sim", "sb"), "left_semi")


def first_pairs(lines: DataFrame, held: DataFrame) -> DataFrame:
    """Pairs (a, b) of line keys: each line with the first of its hash, and the first line of each hash with those of the
    least and the greatest close hash that are first in a block. ``lines``: (k1, sim), ``held``: (key, sim)."""
    held = held.join(held.groupBy("key").agg(F.min("sim").alias("first")), "key")
    close = held.where((F.col("first") != F.col("sim")) & _close("first", "sim")).groupBy("sim").agg(F.array(F.min("first"), F.max("first")).alias("others"))
    close = close.select("sim", F.explode(F.array_distinct("others")).alias("other"))
    least = lines.groupBy("sim").agg(F.min("k1").alias("least"))
    own = lines.join(least, "sim").where("k1 <> least").select(F.col("least").alias("a"), F.col("k1").alias("b"))
    a, b = least.select(F.col("sim").alias("other"), F.col("least").alias("a")), least.select("sim", F.col("least").alias("b"))
    return own.unionByName(close.join(a, "other").join(b, "sim").select("a", "b"))


def other_pairs(lines: DataFrame, held: DataFrame) -> DataFrame:
    """The candidate pairs (a, b) whose lines are in different groups so far. ``lines``: (k1, sim, component), ``held``: (key, sim)."""
    groups = lines.select("sim", "component").distinct()
    # under one hash, and in one block
    within = groups.select(F.col("sim").alias("key"), "sim", "component", F.lit(True).alias("whole"))
    members = within.unionByName(held.select("key", "sim").join(groups, "sim").withColumn("whole", F.lit(False)))
    several = members.groupBy("key", "whole").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key", "whole")
    left = members.join(several, ["key", "whole"])
    side = lambda x: left.select(*([F.col(c).alias(f"{c}_{x}") for c in ("key", "whole")] if x == "b" else ["key", "whole"]), F.col("sim").alias(f"s{x}"), F.col("component").alias(f"c{x}"))
    meet = (F.col("key") == F.col("key_b")) & (F.col("whole") == F.col("whole_b")) & (F.col("ca") < F.col("cb")) & _close("sa", "sb")
    both = side("a").join(side("b"), meet).select("sa", "ca", "sb", "cb").distinct()
    named = lambda x: lines.select(F.col("sim").alias(f"s{x}"), F.col("component").alias(f"c{x}"), F.col("k1").alias(x))
    return both.join(named("a"), ["sa", "ca"]).join(named("b"), ["sb", "cb"]).select("a", "b")


def _spaced(words: Column) -> Column:
    """The words, each followed by a space."""
    return F.concat(F.array_join(words, " "), F.lit(" "))


def verified(pairs: DataFrame, forms: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose forms (k1, form: words joined by spaces, length) have at least the edit similarity 1 - distance / longer length."""
    a = forms.select(F.col("k1").alias("a"), F.col("form").alias("fa"), F.col("length").alias("la"))
    b = forms.select(F.col("k1").alias("b"), F.col("form").alias("fb"), F.col("length").alias("lb"))
    both = pairs.join(a, "a").join(b, "b").withColumn("most", F.floor(F.greatest("la", "lb") * (1 - similarity) + 1e-9).cast("int"))
    both = both.where("abs(la - lb) <= most")
    both = both.select("a", "b", "most", once(F.split("fa", " ")).alias("wa"), "fb").select("a", "b", "most", "wa", once(F.split("fb", " ")).alias("wb"))
    same = lambda x, y: F.array_position(F.zip_with(x, y, lambda u, v: u.eqNullSafe(v)), F.lit(False))
    fewer = F.least(F.size("wa"), F.size("wb"))
    # the first word that differs (0: none), from the front and from behind
    both = both.select("*", once(same(F.col("wa"), F.col("wb"))).alias("front"), fewer.alias("fewer"))
    both = both.withColumn("first", F.when(F.col("front") == 0, F.col("fewer")).otherwise(F.col("front") - 1).cast("int"))
    both = both.select("*", once(same(F.reverse("wa"), F.reverse("wb"))).alias("back"))
    behind = F.when(F.col("back") == 0, F.col("fewer")).otherwise(F.col("back") - 1).cast("int")
    both = both.withColumn("last", F.least(behind, F.col("fewer") - F.col("first")))
    middle = lambda w: once(F.slice(F.col(w), F.col("first") + 1, F.size(w) - F.col("first") - F.col("last")))
    both = both.select("a", "b", "most", "wb", "first", "last", middle("wa").alias("ma"))
    both = both.select("a", "b", "most", "ma", middle("wb").alias("mb"))
    # word for word replacement is no shorter than the distance: where it is short enough, that is all
    letters = F.zip_with("ma", "mb", lambda x, y: F.when(x == y, 0).otherwise(F.greatest(F.length(x), F.length(y))))
    replaced = F.when(F.size("ma") == F.size("mb"), F.aggregate(letters, F.lit(0), lambda n, x: n + x))
    both = both.select("*", once(replaced).alias("replaced"))
    enough = F.coalesce(F.col("replaced") <= F.col("most"), F.lit(False))
    # a word more, less or replaced is no further than the longest word with its space
    both = both.select("a", "b", "most", "ma", "mb", once(enough).alias("enough"), once(F.when(~enough, F.array_union("ma", "mb"))).alias("known"))
    letter = lambda x: F.get(F.array(*map(F.lit, LETTERS)), F.array_position(F.col("known"), x).cast("int") - 1)
    few = F.size("known").between(1, len(LETTERS))  # beyond, letters are compared at once
    spelt = lambda w: once(F.when(few, F.array_join(F.transform(w, letter), "")))
    both = both.select("*", spelt("ma").alias("sa"), F.array_max(F.transform("known", F.length)).alias("longest")).select("*", spelt("mb").alias("sb"))
    both = both.select("*", once(F.coalesce(F.expr("levenshtein(sa, sb, most div (longest + 1))") >= 0, F.lit(False))).alias("alike"))
    both = both.select("a", "b", "most", "enough", "alike", _spaced(F.col("ma")).alias("ta"), _spaced(F.col("mb")).alias("tb"))
    distance = F.when(F.col("enough") | F.col("alike"), 0).otherwise(F.expr("levenshtein(ta, tb, most)"))
    return both.select("a", "b", "most", once(distance).alias("distance")).where("distance >= 0 AND distance <= most").select("a", "b")


def _in_documents(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """(k1, form, length) of ``needed`` (k1, id, th, pos), from their documents, each of which is split once.

    Documents first pass a bit table of the hashes asked for, of
    2^FILTER_BITS bits whatever the input, so that most others are not
    shuffled; the join decides.
    """
    at = lambda h: F.pmod(h, F.lit(1 << FILTER_BITS))
    bits = needed.select(at(F.col("th")).alias("bit")).groupBy(F.shiftright("bit", 6).alias("word"))
    bits = bits.agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS int))")).alias("bits"))
    texts = docs.select("id", "text", F.xxhash64("text").alias("th")).withColumn("word", F.shiftright(at(F.col("th")), 6))
    asked = F.col("bits").bitwiseAND(F.expr("shiftleft(1L, cast(pmod(th, 64) AS int))")) != 0
    texts = texts.join(F.broadcast(bits), "word").where(asked).select("id", "text", "th")
    needed = needed.groupBy("id", "th").agg(F.collect_list(F.struct("k1", "pos")).alias("places"))
    found = texts.join(needed, texts["id"].eqNullSafe(needed["id"]) & (texts["th"] == needed["th"]))
    found = found.select("places", once(F.split("text", "\n", -1)).alias("lines")).select("lines", F.explode("places").alias("place"))
    found = found.select("place.k1", F.get("lines", F.col("place.pos")).alias("line")).groupBy("k1").agg(F.max("line").alias("line"))
    return found.select("k1", once(F.array_join(normal_words(F.col("line")), " ")).alias("form")).select("k1", "form", F.length("form").alias("length"))


def fuzzy_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8) -> DataFrame:
    """(id, text_hash, line, group long, kept) of the lines with a word; ``line`` counts from 0.

    ``group`` names the connected group, ``kept`` is true for its first
    occurrence by id (null last), text hash and line. Lines equal in normal
    form are always in one group. Lines without a word, empty texts and null
    texts have no rows. Rows equal in id and text are one document; other
    columns are ignored; an empty table gives no rows. Lines of any length are
    hashed whole, and compared whole.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "lines")
    docs = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"))
    simhashes(_lines(docs)).write.parquet(f"{path}/lines")
    lines = spark.read.parquet(f"{path}/lines")
    place = F.struct(F.col("id").isNull().alias("last"), "id", "th", "pos")
    lines.groupBy("k1", "k2").agg(F.max("sim").alias("sim"), F.count("*").alias("n"), F.min(place).alias("place")).write.parquet(f"{path}/distinct")
    distinct = spark.read.parquet(f"{path}/distinct")
    shared_blocks(distinct.select("sim").distinct()).write.parquet(f"{path}/held")
    held = spark.read.parquet(f"{path}/held")
    # the lines that may have a candidate, and their words, from one document each
    shared = held.select("sim").union(distinct.groupBy("sim").count().where("count > 1").select("sim")).distinct()
    distinct.join(shared, "sim").select("k1", "sim", "place.id", "place.th", "place.pos").write.parquet(f"{path}/asked")
    asked = spark.read.parquet(f"{path}/asked")
    _in_documents(docs, asked).write.parquet(f"{path}/forms")
    forms = spark.read.parquet(f"{path}/forms")
    # groups from two pairs a hash; then the pairs between different groups that were not compared
    ordered = lambda pairs: pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    ordered(first_pairs(asked, held)).write.parquet(f"{path}/pairs-1")
    tried = spark.read.parquet(f"{path}/pairs-1")
    verified(tried, forms, similarity).write.parquet(f"{path}/links-1")
    found = spark.read.parquet(f"{path}/links-1")
    components(found).write.parquet(f"{path}/members-1")
    members = spark.read.parquet(f"{path}/members-1")
    grouped = asked.join(members, asked["k1"] == members["node"], "left").select("k1", "sim", F.coalesce("component", "k1").alias("component"))
    ordered(other_pairs(grouped, held)).join(tried, ["a", "b"], "left_anti").write.parquet(f"{path}/pairs-2")
    verified(spark.read.parquet(f"{path}/pairs-2"), forms, similarity).write.parquet(f"{path}/links-2")
    more = spark.read.parquet(f"{path}/links-2")
    if not more.isEmpty():  # links between groups join groups, whose names are those of their least lines
        end = lambda x: grouped.select(F.col("k1").alias(x), F.col("component").alias(f"c{x}"))
        joined = components(more.join(end("a"), "a").join(end("b"), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        joined = joined.select(F.col("node").alias("old"), F.col("component").alias("new"))
        members = grouped.join(joined, F.col("component") == F.col("old"), "left").select(F.col("k1").alias("node"), F.coalesce("new", "component").alias("component"))
    # lines that are alone, once, are their own groups; the others have a first occurrence
    named = distinct.join(members, distinct["k1"] == members["node"], "left").where("component IS NOT NULL OR n > 1")
    named = named.select("k1", "k2", "place", F.coalesce("component", "k1").alias("group"))
    first = named.groupBy("group").agg(F.min("place").alias("first"))
    named.join(first, "group").select("k1", "k2", "group", "first").write.parquet(f"{path}/groups")
    out = lines.join(spark.read.parquet(f"{path}/groups"), ["k1", "k2"], "left")
    kept = F.col("first").isNull() | (F.col("first") == place)
    return out.select("id", F.col("th").alias("text_hash"), F.col("pos").alias("line"), F.coalesce("group", "k1").alias("group"), kept.alias("kept"))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8) -> DataFrame:
    """``docs`` without the lines that ``fuzzy_lines`` does not keep; a document may be left with an empty text, and null texts stay null."""
    path = scratch_path(docs.sparkSession, "lines-gone")
    found = fuzzy_lines(docs, id_col, text_col, similarity).where("NOT kept")
    found.groupBy("id", "text_hash").agg(F.collect_set("line").alias("gone")).write.parquet(path)
    gone = docs.sparkSession.read.parquet(path)
    whole = F.col(quoted(text_col))
    rows = docs.select(F.struct(*map(quoted, docs.columns)).alias("row"), F.col(quoted(id_col)).alias("doc"), whole.alias("whole"), F.xxhash64(whole).alias("h"))
    rows = rows.join(gone, rows["doc"].eqNullSafe(gone["id"]) & (rows["h"] == gone["text_hash"]), "left")
    left = F.array_join(F.filter(F.split("whole", "\n", -1), lambda _, i: ~F.array_contains("gone", i)), "\n")
    text = F.when(F.col("gone").isNull(), F.col("whole")).otherwise(left).alias(text_col)
    return rows.select(*(text if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns))
