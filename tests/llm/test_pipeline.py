"""The pipeline's stages on a small table, each against what it must do."""
import hashlib
import random
import re
from collections import Counter

import pytest
import public_tokenizers
import sentencepiece

import corpus_pipeline as P
from tests.conftest import SF001
from tests.llm.helpers import DOCS, corpus, words


def labelled():
    """Texts of which a fourth hold words that earn the label toxic, and their labels."""
    rng, rows, labels = random.Random(2), [], []
    for i in range(1000, 1400):
        bad = i % 4 == 0
        w = words(rng, 40) + (rng.sample(["idiot", "moron", "scum", "trash"], 3) if bad else [])
        rng.shuffle(w)
        rows.append((i, " ".join(w), "en", "s1", 1))
        labels.append((i, 1, int(bad)))
    return rows, labels


def stages(spark, docs, folder):
    out = [docs.collect()]
    for _, stage in P.STAGES:
        found = stage(spark, docs, folder)
        out.append(found.collect())
        docs = spark.createDataFrame(out[-1], found.schema)
    return out


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("labelled"))
    rows, labels = labelled()
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(folder + "/labels.parquet")
    return stages(spark, spark.createDataFrame(corpus(120) + rows, DOCS), folder)


def test_columns_and_rows(steps):
    for rows in steps[:-1]:
        assert list(rows[0].asDict()) == P.COLUMNS
    gone = Counter((r.doc_id, r.text) for r in steps[0]) - Counter((r.doc_id, r.text) for r in steps[1])
    toxic = {i for i, _, y in labelled()[1] if y}
    assert not [i for i, _ in gone if i not in toxic]  # clean documents stay
    assert len(gone) >= 0.95 * len(toxic)
    texts = Counter(r.text for r in steps[2] if r.text)
    assert max(texts.values()) == 1  # one row of each group of copies, repeated rows among them


def test_repeats_are_cut(steps):
    seen = set()
    rows = {r.doc_id: r for r in steps[3] if r.doc_id is not None}  # rows of one id are one document
    for _, r in sorted(rows.items()):
        w = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        before = {x.doc_id: x.text for x in steps[2]}[r.doc_id]
        if (r.text or "") == (before or ""):
            for i in range(len(w) - 12):
                assert tuple(w[i:i + 13]) not in seen
        b = re.findall(r"[^\x20\x09-\x0D]+", before or "")
        seen |= {tuple(b[i:i + 13]) for i in range(len(b) - 12)}


def test_mixed_and_encoded(steps):
    before = Counter((r.doc_id, r.text) for r in steps[3])
    mixed = Counter((r.doc_id, r.text) for r in steps[4])
    assert all(n <= 2 * before[k] for k, n in mixed.items())  # a row at most twice
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    ids = lambda t: hashlib.sha256(",".join(map(str, library.encode(t or ""))).encode()).hexdigest()
    assert Counter((r.doc_id, r.ids_sha256) for r in steps[5]) == Counter((r.doc_id, ids(r.text)) for r in steps[4])


def test_run(spark):
    got = P.run(spark, SF001)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "covered_bytes"] and got.count() > 100


def test_empty_table_and_texts(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(folder + "/labels.parquet")
    assert all(rows == [] for rows in stages(spark, spark.createDataFrame([], DOCS), folder))
    steps = stages(spark, spark.createDataFrame([(i, None, None, None, None) for i in range(5)], DOCS), folder)
    assert len(steps[1]) == 5 and steps[4] == []  # nothing to take from texts without words


def test_without_labels_all_documents_stay(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(folder + "/labels.parquet")
    docs = spark.createDataFrame(corpus(20), DOCS)
    assert Counter(P.reject_toxic(spark, docs, folder).collect()) == Counter(docs.collect())
