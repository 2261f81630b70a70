import random

import public_tokenizers
import pytest
import sentencepiece

from hearth.llm import pieces
from tests.llm.helpers import documents, frame

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def own():
    with open(MODEL, "rb") as f:
        return pieces.Pieces(f.read())


def test_random_texts(library, own):
    rnd, letters = random.Random(1), "ab eo tnhis   \n\t▁é梦的\U0001f98a\x00<>0x/s"
    for _ in range(4000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40)))
        ids = library.encode(text, add_eos=True)
        assert own.encode(text) == ids and own.decode(ids) == library.decode(ids), text


def test_runs_and_long_words(library, own):
    for text in ["a" * 5000, " " * 333, "ab" * 777, "的" * 500, "\U0001f98a" * 40, "x\n" * 100, "▁▁ ▁", "</s><s><unk><0x41>"]:
        assert own.encode(text) == library.encode(text, add_eos=True), text[:20]


def test_any_ids_decode_like_the_library(library, own):
    rnd = random.Random(2)
    for _ in range(3000):
        ids = [rnd.choice([rnd.randrange(3, 32000), rnd.randrange(3, 259), 1, 2]) for _ in range(8)]
        assert own.decode(ids) == library.decode(ids), ids


def test_full_memories_start_anew(library, own, monkeypatch):
    monkeypatch.setattr(pieces, "WORDS_KEPT", 3)
    monkeypatch.setattr(pieces, "PAIRS_KEPT", 5)
    for r in documents()[:40]:
        assert own.encode(r[1] or "") == library.encode(r[1] or "", add_eos=True)


def test_table(spark, library):
    docs = frame(spark)
    rows = pieces.decode(pieces.encode(docs, MODEL), MODEL)
    assert rows.columns == [*docs.columns, "ids", "decoded"]
    got = rows.collect()
    assert len(got) == docs.count()
    for r in got:
        ids = library.encode(r.text or "", add_eos=True)
        assert list(r.ids) == ids and r.decoded == library.decode(ids)
    assert pieces.encode(frame(spark, []), MODEL).count() == 0


def test_registered_query(spark, library):
    import hashlib

    from hearth.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in QUERIES["op8_pieces"](spark, sf).collect():
        ids = library.encode(text[r.doc_id] or "", add_eos=True)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))
