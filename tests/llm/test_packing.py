"""Packing: the tokenizer itself, a search for the fewest sequences, and places."""
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.helpers import DOCS, corpus
from threadscope.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")


def counts_of(lengths, capacity):
    return np.bincount(np.array(lengths, int), minlength=capacity + 1)


def fewest(lengths, capacity):
    """Number of sequences of the best packing, by trying all."""
    lengths, best = sorted(lengths, reverse=True), [len(lengths)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for r in {r for r in rooms if r >= lengths[i]}:
            at = rooms.index(r)
            go(i + 1, [*rooms[:at], r - lengths[i], *rooms[at + 1:]])
        go(i + 1, [*rooms, capacity - lengths[i]])

    go(0, [])
    return best[0]


def all_sequences(counts, capacity):
    fixed, rest = P.reduce(counts, capacity)
    return [*fixed, *P.best_fit(rest, capacity)]


def test_dominating_sets_lose_nothing():
    rng = random.Random(8)
    for trial in range(150):
        capacity = rng.choice([10, 17, 30])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        fixed, rest = P.reduce(counts_of(lengths, capacity), capacity)
        left = list(itertools.chain.from_iterable([i] * int(n) for i, n in enumerate(rest)))
        used = list(itertools.chain.from_iterable(list(s) * t for t, s in fixed))
        assert sorted(left + used) == sorted(lengths) and all(sum(s) <= capacity for _, s in fixed)
        assert sum(t for t, _ in fixed) + fewest(left, capacity) == fewest(lengths, capacity), (trial, lengths, capacity)


def test_every_piece_has_its_own_place():
    rng = random.Random(9)
    for capacity in (1, 16, 64):
        lengths = [min(capacity, int(rng.expovariate(8 / capacity)) + 1) for _ in range(400)]
        counts = counts_of(lengths, capacity)
        table = P.places(all_sequences(counts, capacity))
        taken = {}
        for length in np.flatnonzero(counts).tolist():
            own = table[table[:, 0] == length]
            for nth in range(int(counts[length])):
                at = np.searchsorted(own[:, 1], nth, "right") - 1
                sequence, offset = own[at, 2] + nth - own[at, 1], own[at, 3]
                assert nth - own[at, 1] < own[at, 4]
                taken.setdefault(int(sequence), []).append((int(offset), length))
        assert sorted(taken) == list(range(len(taken)))
        for parts in taken.values():
            parts.sort()
            assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
            assert sum(n for _, n in parts) <= capacity
        assert len(taken) <= -(-sum(lengths) // capacity) + 2


def test_best_fit_many_at_a_time_equals_one_by_one():
    rng = random.Random(10)
    for _ in range(30):
        lengths = [rng.choice([3, 4, 5, 7, 11, 20]) for _ in range(60)]
        rooms = []
        for n in sorted(lengths, reverse=True):
            fits = [r for r in rooms if r >= n]
            if fits:
                rooms.remove(min(fits))
            rooms.append((min(fits) if fits else 32) - n)
        got = P.best_fit(counts_of(lengths, 32), 32)
        assert sorted(32 - sum(s) for t, s in got for _ in range(t)) == sorted(rooms)


def test_words_encode_as_the_tokenizer():
    texts = ["", " \t\n", "Hello, World's  best 123 tests!?", "ΣΊΣΥΦΟΣ naïve éa ́x y z", "a\x1cb\x85c",
             "≠ =\u0338 <\u0338x ÀÉß×÷ É́x .…. don't I'LLs ''s'x -'re 5²½ a1b2 İ. ǅ é… ÿ'd",
             "<|endoftext|> mid<|startoftext|>dle", "日本語 текст ☃☃ 'LL it's", "x" * 5000, "가 ᆨ", "a \x00 b", "…" * 50]
    tokenizer = Tokenizer.from_file(PATH)
    words = P.Words(PATH)
    rng = random.Random(12)
    signs = "aé'sſKß1²<|=\u0338\u0301\u0327 \t\x1c\x85.…ÀİIT中"
    texts += ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(3000)]
    raw = [t.encode() for t in texts]
    at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    for _ in range(2):  # the second time from memory
        ids, cut = words.encode(np.frombuffer(b"".join(raw), np.uint8), at)
        for i, t in enumerate(texts):
            assert ids[cut[i]:cut[i + 1]].tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("capacity", [7, 64, 2048])
def test_documents_against_the_tokenizer(spark, capacity):
    rows = [(*r, "part", 7) for r in corpus()]
    df = spark.createDataFrame(rows, DOCS + ", part string, length int").repartition(4)
    tokenizer = Tokenizer.from_file(PATH)
    want = []
    for r in rows:
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0]
        for n, s in enumerate(range(0, len(ids), capacity)):
            blob = np.array(ids[s:s + capacity], "<u4").tobytes()
            want.append((r[0], n, s, len(blob) // 4, zlib.crc32(blob)))
    packed = P.pack_documents(df, PATH, capacity=capacity, extra=[("crc", F.crc32("ids"))])
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids", "crc", "sequence_id", "offset"]
    got = packed.collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.crc) for r in got), key=repr) == sorted(want, key=repr)
    whole = {}
    for r in got:
        assert zlib.crc32(r.ids) == r.crc
        whole.setdefault(r.sequence_id, []).append((r.offset, bytes(r.ids)))
    for r in P.sequences(packed).collect():
        assert b"".join(b for _, b in sorted(whole[r.sequence_id])) == bytes(r.ids)
        assert len(r.ids) == 4 * r.length <= 4 * capacity
    for parts in whole.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(len(b) // 4 for _, b in parts[:i]) for i in range(len(parts))]
    assert len(whole) <= -(-sum(r.length for r in got) // capacity) * 1.25 + 1


def test_empty_table(spark):
    assert P.pack_documents(spark.createDataFrame([], DOCS), PATH).count() == 0
