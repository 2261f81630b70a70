import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from hearth.llm import merges
from tests.llm.helpers import documents, frame

FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(FILE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    with open(FILE, "rb") as f:
        return merges.Ranks(f.read(), merges.char_classes())


def each(own, texts):
    return [ids[a:b].tolist() for ids, ends in own.encode(texts) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def test_random_texts(library, own):
    rnd, letters = random.Random(1), "ab eo tnhis   \n\t'' 'll're'd'S é梦的\U0001f98a\x00\xa0  ١٢17.,!\x1c\x85½Ⅷ́"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(8000)]
    assert each(own, texts) == [library.encode_ordinary(t) for t in texts]


def test_runs_and_long_words(library, own):
    texts = ["a" * 5000, " " * 333, "ab" * 777, "aba" * 500, "的" * 500, "\U0001f98a" * 40, "x\n" * 100, "", "x" * 1000 + " y"]
    texts += ["'s 'the we'll I'd x're", "''s", " 's", "\t's", "it's", "'", "'l", "'ll", "<|endoftext|>"]
    assert each(own, texts) == [library.encode_ordinary(t) for t in texts]


def test_characters_of_every_kind(library, own):
    """Letters, numbers and blanks are the library's, of its Unicode version."""
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}1 {chr(c)}\n" for c in points[i : i + 500]) for i in range(0, 0x20000, 500)]
    assert each(own, texts) == [library.encode_ordinary(t) for t in texts]


def test_new_pairs_of_lower_rank_are_merged_stepwise():
    """Ranks not made by training: "abc" stands before "bc", from which it is reached."""
    ranks = {bytes([i]): i for i in range(256)} | {b"abc": 256, b"bc": 257, b"aa": 258, b"abca": 259, b"cab": 260, b"ca": 261}
    content = b"\n".join(base64.b64encode(t) + b" " + str(r).encode() for t, r in ranks.items())
    own = merges.Ranks(content, merges.char_classes())
    library = tiktoken.Encoding("odd", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("abc") for _ in range(rnd.randint(1, 14))) for _ in range(2000)]
    assert len(own.replay([t.encode() for t in set(texts)])[2]) > 100
    assert each(own, texts) == [library.encode_ordinary(t) for t in texts]


def test_ranks_must_be_complete():
    with pytest.raises(ValueError):
        merges.Ranks(base64.b64encode(b"a") + b" 0", merges.char_classes())


def test_any_ids_decode(library, own):
    ids = np.random.default_rng(1).integers(0, 50_256, 5000)
    assert own.decode(ids)[0] == library.decode_bytes(ids.tolist())


def test_table(spark, library):
    docs = frame(spark).withColumn("a.b", F.lit(1))
    for packed in (False, True):
        rows = merges.decode(merges.encode(docs, FILE, packed=packed), FILE)
        assert rows.columns == [*docs.columns, "ids", "decoded"]
        got = rows.collect()
        assert len(got) == docs.count()
        for r in got:
            ids = library.encode_ordinary(r.text or "")
            assert (np.frombuffer(r.ids, "<u4").tolist() if packed else list(r.ids)) == ids
            assert bytes(r.decoded) == (r.text or "").encode()
    assert merges.encode(frame(spark, []), FILE).count() == 0
    assert [bytes(r.decoded) for r in merges.decode(spark.createDataFrame([(None,)], "ids array<int>"), FILE).collect()] == [b""]


def test_blocks_follow_the_bytes(spark, library, monkeypatch):
    monkeypatch.setattr(merges, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(merges, "PIECE_BYTES", 300)
    texts = [r[1] or "" for r in documents()]
    with open(FILE, "rb") as f:
        own = merges.Ranks(f.read(), merges.char_classes())
    assert each(own, texts) == [library.encode_ordinary(t) for t in texts]


def test_registered_query(spark, library):
    from hearth.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op11_byte_pairs"](spark, sf).collect():
        ids = library.encode_ordinary(text[r.doc_id] or "")
        packed = np.array(ids, "<u4").tobytes()
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(packed).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((text[r.doc_id] or "").encode()).hexdigest()
