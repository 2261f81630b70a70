"""The pipeline on a small table, each stage held against a plain version on its own input."""

import hashlib
from collections import Counter

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from hearth.llm import mixing, quality
from hearth.llm.lines import fuzzy_lines
from tests.llm.helpers import documents, frame, words
from tests.llm.test_simhash import brute as brute_components

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stages(spark, docs, path):
    """(input, output) of each stage, through Parquet like run()."""
    out = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, None).write.parquet(f"{path}/{k}")
        out.append((docs, spark.read.parquet(f"{path}/{k}")))
        docs = out[-1][1]
    return out


def test_each_stage(spark, tmp_path):
    rows = [r for r in documents() if len(r[1] or "") < 40_000]
    frame(spark, rows).select(*COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    (s1, s2, s3, s4, s5) = stages(spark, docs, tmp_path / "stages")
    for before, after in (s1, s2, s3, s4):
        assert after.columns == COLUMNS and before.columns == COLUMNS

    kept = Counter((r.id, r.text_hash) for r in quality.judge(docs).where("kept").collect())
    assert Counter(tuple(r) for r in s1[1].select("doc_id", F.xxhash64("text")).collect()) == kept

    before = s2[0].select(*COLUMNS, F.xxhash64("text").alias("h")).collect()
    gone = {(r.id, r.text_hash, r.line) for r in fuzzy_lines(s2[0]).where("NOT kept").collect()}  # held against brute force in test_lines
    lines = []
    for r in before:
        left = [x for i, x in enumerate(r.text.split("\n")) if (r.doc_id, r.h, i) not in gone]
        lines.append((r.doc_id, "\n".join(left), len("\n".join(left))))
    assert Counter((r.doc_id, r.text, r.n_chars) for r in s2[1].collect()) == Counter(lines)

    groups = {c for _, _, c in brute_components(s3[0].collect())}
    assert sorted(r.doc_id or -1 for r in s3[1].collect()) == sorted(c or -1 for c in groups)

    times = Counter()
    for r in mixing.Mix(s4[0]).taken().collect():
        if r.size:
            times[r.id] += int(r.taken / r.size + 0.5)
    assert Counter(r.doc_id for r in s4[1].collect()) == +times
    assert all(n <= 2 for n in times.values())

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = s5[1].collect()
    assert len(got) == s5[0].count()
    for r in got:
        ids = library.encode(r.text or "", add_eos=True)
        assert (list(r.ids), r.n_tokens, r.ids_sha256, r.decoded_sha256) == (ids, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))


def test_run_reads_the_documents(spark, tmp_path):
    rows = [(i, f"{w} " * 4 + f"plain text number {i} with enough words of its own to be kept here, {w}{i} {w}{i + 1}.", "en", w, 10) for i, w in enumerate(["ab", "cd", "ef", "gh"] * 3)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} <= set(range(12)) and got and all(words(r.text) for r in got)


def test_empty_table(spark, tmp_path):
    frame(spark, []).select(*COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_the_stages():
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and corpus_pipeline.ORACLE_SQL is None
