"""The codec against the library, and the normaliser against its own."""
import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from tests.llm.helpers import DOCS, corpus
from threadscope.llm import piece_codec as C

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "a", " a", "a ", "  a  b ", "\n", "▁a ▁ b", "a▁b", "<s>", "<0x0A>", "<unk> x", "日本語 😀 x", "\0 a",
       "\t\t a\r\n", "x\u0301 é", " " * 40 + "x", "☃☃ ☃\n☃", "1234"]


def random_texts(n, alphabet, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 30))) for _ in range(n)]


def test_library_gives_the_same():
    with open(MODEL, "rb") as f:
        codec = C.codec(f.read())
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text in ODD + random_texts(800, ["a", "b", " ", "\n", "▁", "é", "😀", "the", " and", "1", "\0", "  "]):
        ids, starts, ends = codec.encode(text)
        assert ids == library.encode(text)
        assert codec.decode(ids) == library.decode(ids)
        spans = [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]
        assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == spans


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "identity"])
@pytest.mark.parametrize("settings", [{}, {"add_dummy_prefix": False}, {"remove_extra_whitespaces": False}])
def test_normaliser(rule, settings):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, **settings)
    m = pb.ModelProto()
    m.ParseFromString(library.serialized_model_proto())
    codec, spec = object.__new__(C.Codec), m.normalizer_spec
    codec.dummy, codec.squeeze, codec.suffix = spec.add_dummy_prefix, spec.remove_extra_whitespaces, False
    codec.mark, codec.map = C.SPACE, C.CharMap(spec.precompiled_charsmap)
    texts = ["ｈｅｌｌｏ ㌔　abc  ﬁ", "e\u0301 a\u0300\u0301x", "㍿ ﾊﾞ", "  \u3000 a", "각 각", "\ufeffa", "ﷺ"]
    for text in texts + random_texts(300, ["a", " ", "ｈ", "㌔", "　", "ﬁ", "e\u0301", "\u0300", "ﾊ", "ﾞ", "\u200b", "  "]):
        norm, align = codec.normalise(text)
        want, offsets = library.normalize(text, with_offsets=True)
        byte = [0]
        for c in text:
            byte.append(byte[-1] + len(c.encode()))
        places = [len(norm[:i].encode()) for i in range(len(norm) + 1)]
        assert norm == want and [int(align[p]) for p in places] == [byte[o] for o in offsets]


def test_tables(spark):
    rows = corpus(20)
    df = spark.createDataFrame([(*r, "x") for r in rows], DOCS + ", ids string")
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    out = C.decode(C.encode(df, MODEL), MODEL).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.ids == library.encode(r.text or "") and r.decoded == library.decode(r.ids)
        raw = (r.text or "").encode()
        assert b"".join(raw[s:e] for s, e in zip(r.starts, r.ends, strict=True)) == raw
    digests = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in C.round_trip(df, MODEL).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert digests == {(r.doc_id, len(r.ids), sha(",".join(map(str, r.ids))), sha(r.decoded)) for r in out}
    assert C.round_trip(df.limit(0), MODEL).count() == 0
