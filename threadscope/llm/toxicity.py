"""Toxicity from the nearest labelled examples.

A bounded sample of labelled texts gives the examples, and all their terms the
vocabulary. Terms are weighted by TF-IDF, with document frequencies counted
over all texts, times how much the term goes with one of the labels among the
examples; that factor has a floor above 0, so no term is left out. The
examples are ordered by likeness and cut into blocks. An inverted index holds
the postings of the rarer terms, and of every common term the weights block by
block with the largest of each block. A text's postings give every example its
score over the rarer terms; that and the blocks' largest weights bound the
score of each block, and only blocks that can hold one of the k nearest are
multiplied, so the cosines are exact. The nearest examples vote with a weight
that falls with their distance; a logistic curve, fitted on the examples'
votes on each other, makes the share of toxic votes a probability.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadscope.llm.common import free_name, mix, prepare, slices, span_hashes, stored, text_bytes, word_spans

#: Examples of each label (a documented bound of the fit).
MAX_EXAMPLES = 4096
#: Examples of a block.
BLOCK = 64
#: A term that one of so many examples has is common; terms at most that count as common.
COMMON, MAX_COMMON = 32, 1024
#: Terms by which the examples are ordered.
HEAVY = 256
#: Texts that are scored at a time, postings of theirs that are looked up at a time, and blocks of each text that are multiplied first.
TEXTS, POSTINGS, FIRST = 128, 1 << 17, 3
#: Bytes of text of which the terms are taken at a time.
BYTES = 1 << 19
#: Postings of the examples that are put in order at a time.
ENTRIES = 1 << 18
#: Weights are multiples of 1 / UNIT.
UNIT = 2.0 ** 25

#: All bytes but ASCII letters, digits and those of longer characters end a word.
_ENDS = np.ones(256, bool)
_ENDS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_U = np.uint64


def terms(column: pa.Array, prefix: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms of the texts, and the row of each: the words in lower
    case, and the first ``prefix`` bytes of longer words, as terms of their own."""
    raw, at = text_bytes(pc.utf8_lower(column.cast(pa.large_string()).fill_null("")))
    starts, ends, words_at = word_spans(raw, at, _ENDS)
    row = np.repeat(np.arange(len(at) - 1), np.diff(words_at))
    whole = span_hashes(raw, starts, ends)
    longer = np.flatnonzero(ends - starts > prefix)
    stems = mix(span_hashes(raw, starts[longer], starts[longer] + prefix), 99)
    return np.concatenate([whole, stems]), np.concatenate([row, row[longer]])


class Vocabulary:
    """Sorted hashes of the terms. The leading bits of a hash say where those that begin so lie."""

    def __init__(self, hashes: np.ndarray):
        self.hashes, self.first = hashes, None

    def __len__(self):
        return len(self.hashes)

    def __reduce__(self):
        return Vocabulary, (self.hashes,)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, -1 of those that are not in it."""
        if self.first is None:
            bits = max(1, int(len(self.hashes)).bit_length() + 1)
            self.shift = _U(64 - bits)
            self.first = np.searchsorted(self.hashes >> self.shift, np.arange((1 << bits) + 1, dtype=_U)).astype(np.int32)
        bucket = (hashes >> self.shift).astype(np.int64)
        place, found = self.first[bucket], np.full(len(hashes), -1, np.int64)
        n, open_ones = self.first[bucket + 1] - place, np.arange(len(hashes))
        while True:
            some = n > 0
            open_ones, place, n = open_ones[some], place[some], n[some]
            if not len(open_ones):
                return found
            hit = self.hashes[place] == hashes[open_ones]
            found[open_ones[hit]] = place[hit]
            place, n = place + 1, np.where(hit, 0, n - 1)


def _counts(hashes: np.ndarray, rows: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place in the vocabulary, times) of the terms that are in it."""
    found = vocabulary.find(hashes)
    hit = found >= 0
    key, n = np.unique(rows[hit] * max(len(vocabulary), 1) + found[hit], return_counts=True)
    return key // max(len(vocabulary), 1), key % max(len(vocabulary), 1), n


def _runs(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... (n of them) of all runs, one after the other."""
    return np.repeat(start - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum())) if len(n) else np.zeros(0, np.int64)


def _parts(n: int) -> list[slice]:
    """The places 0 to n in turn: what is worked out of them at a time stays small."""
    return [slice(low, low + ENTRIES) for low in range(0, n, ENTRIES)]


def by_term(row: np.ndarray, term: np.ndarray, weight: np.ndarray, examples: int, terms_n: int
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The postings by term: the example of each, of two bytes where these suffice; their number of
    each term; and their weights, as integers of the unit 1 / UNIT where that is exact."""
    n = np.zeros(terms_n, np.int64)
    for part in _parts(len(term)):
        n += np.bincount(term[part], minlength=terms_n)
    exact = weight.dtype == np.int32 or all((w <= 1).all() and (np.round(w * UNIT) == w * UNIT).all()
                                            for w in (weight[part] for part in _parts(len(weight))))
    rows = np.empty(len(row), np.uint16 if examples <= 1 << 16 else np.int32)
    weights = np.empty(len(row), np.int32 if exact else np.float64)
    free = np.cumsum(n) - n  # the next free place of each term
    for part in _parts(len(term)):
        order = np.argsort(term[part], kind="stable")
        own, times = np.unique(term[part], return_counts=True)
        at = _runs(free[own], times)
        rows[at] = row[part][order]
        weights[at] = weight[part][order] if weight.dtype == weights.dtype else np.round(weight[part][order] * UNIT)
        free[own] += times
    return rows, n.astype(np.int32), weights


def likeness(examples: int, row: np.ndarray, n: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """An order of the examples in which those alike are near each other: halved
    again and again along the direction in which their heaviest terms differ most.
    ``row``, ``n``, ``weight``: see ``by_term``."""
    heavy = np.argsort(-n, kind="stable")[:HEAVY]
    cut = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
    matrix = np.zeros((examples, len(heavy)), np.float32)
    for place, term in enumerate(heavy.tolist()):
        own = weight[cut[term]:cut[term + 1]]
        matrix[row[cut[term]:cut[term + 1]], place] = own / UNIT if own.dtype == np.int32 else own
    order, todo = np.arange(examples), [(0, examples)]
    while todo:
        low, high = todo.pop()
        if high - low <= BLOCK:
            continue
        own = matrix[order[low:high]]
        own -= own.mean(axis=0)
        direction = np.abs(own).sum(axis=0)
        for _ in range(8):  # power iterations; any direction gives a right order
            direction = own.T @ (own @ direction)
            direction /= max(float(np.sqrt((direction * direction).sum())), 1e-20)
        half = low + (-(-(high - low) // BLOCK) // 2) * BLOCK
        order[low:high] = order[low:high][np.argsort(own @ direction, kind="stable")]
        todo += [(low, half), (half, high)]
    return order


class BlockMaxIndex:
    """Vectors of the examples by term, with weights that are multiples of
    1 / UNIT. ``order``: the example at each place of the blocks."""

    def __init__(self, examples: int, row: np.ndarray, term: np.ndarray, weight: np.ndarray, terms_n: int):
        """Weights of four-byte integers are in the unit 1 / UNIT."""
        postings = by_term(row, term, weight, examples, terms_n)
        self._hold(examples, *postings, likeness(examples, *postings), True)

    def _hold(self, examples: int, row: np.ndarray, n: np.ndarray, weight: np.ndarray, order: np.ndarray, kept: bool) -> None:
        self.postings, self.order, self.kept = (examples, row, n, weight), order, kept  # kept: to be pickled again
        self.built = False

    def __reduce__(self):
        """Pickled as postings alone: a broadcast lies on every disk."""
        return _unpickled, (*self.postings, self.order.astype(np.int32))

    def _build(self) -> None:
        examples, row, n, weight = self.postings
        if not self.kept:
            self.postings = None
        self.unit = 1 / UNIT if weight.dtype == np.int32 else 1.0  # weights stay as they are held
        self.blocks = max(1, -(-examples // BLOCK))
        at = np.empty(examples, row.dtype)
        at[self.order] = np.arange(examples)
        common = np.argsort(-n, kind="stable")[:MAX_COMMON]
        common = common[n[common].astype(np.int64) * COMMON >= max(examples, 1)]
        self.place = np.full(len(n), -1, np.int32)  # row of the matrix
        self.place[common] = np.arange(len(common))
        start = np.cumsum(n, dtype=np.int64) - n
        self.matrix = np.zeros((self.blocks, len(common), BLOCK), weight.dtype)
        for place, term in enumerate(common.tolist()):
            own = slice(start[term], start[term] + n[term])
            where = at[row[own]]
            self.matrix[where // BLOCK, place, where % BLOCK] = weight[own]
        self.top = np.ascontiguousarray(self.matrix.max(axis=2).T) * self.unit
        rare = np.repeat(self.place < 0, n)
        self.row, self.weight = at[row[rare]], weight[rare]
        self.cut = np.concatenate([[0], np.cumsum(np.where(self.place < 0, n, 0), dtype=np.int64)])
        self.built, self.multiplied, self.met = True, 0, 0

    def search(self, row: np.ndarray, term: np.ndarray, weight: np.ndarray, texts: int, k: int
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, example, cosine) of the k examples of the highest cosine above 0
        of each text, ties to the smaller example; by text and falling cosine.
        ``row``, ``term``, ``weight``: the texts' terms, by row."""
        if not self.built:
            self._build()
        cut = np.searchsorted(row, np.arange(texts + 1))
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for first in range(0, texts, TEXTS):
            last = min(first + TEXTS, texts)
            part = slice(cut[first], cut[last])
            i, e, s = self._nearest(row[part] - first, term[part], weight[part], last - first, k)
            out.append((i + first, e, s))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def _nearest(self, row, term, weight, texts, k):
        width = self.blocks * BLOCK
        often = self.place[term] >= 0
        left = np.zeros((texts, len(self.top)))
        left[row[often], self.place[term[often]]] = weight[often]
        row, term, weight = row[~often], term[~often], weight[~often]
        n = self.cut[term + 1] - self.cut[term]
        score, past, low = np.zeros(texts * width), np.concatenate([[0], np.cumsum(n)]), 0
        while low < len(term):
            high = max(low + 1, int(np.searchsorted(past, past[low] + POSTINGS, "right")) - 1)
            own = n[low:high]
            at = _runs(self.cut[term[low:high]], own)
            np.add.at(score, np.repeat(row[low:high] * width, own) + self.row[at], np.repeat(weight[low:high], own) * self.weight[at])
            low = high
        score *= self.unit
        score = score.reshape(texts, self.blocks, BLOCK)
        bound = score.max(axis=2) + left @ self.top

        def multiply(chosen: np.ndarray) -> None:
            block, text = np.nonzero(chosen.T)
            cut = np.searchsorted(block, np.arange(self.blocks + 1))
            for b in np.flatnonzero(np.diff(cut)):
                own = text[cut[b]:cut[b + 1]]
                score[own, b] += left[own] @ (self.matrix[b] * self.unit)

        few = min(FIRST, self.blocks)
        best = np.argpartition(-bound, few - 1, axis=1)[:, :few]
        done = np.zeros((texts, self.blocks), bool)
        np.put_along_axis(done, best, True, axis=1)
        multiply(done)
        seen = np.take_along_axis(score, best[:, :, None], axis=1).reshape(texts, -1)
        kth = np.partition(seen, seen.shape[1] - k, axis=1)[:, seen.shape[1] - k] if seen.shape[1] >= k else np.zeros(texts)
        # A block whose bound is the k-th score may hold a tie.
        more = ~done & (bound > 0) & (bound >= kth[:, None] - 1e-9)
        multiply(more)
        done |= more
        self.multiplied, self.met = self.multiplied + int(done.sum()), self.met + done.size
        score[~done] = 0
        flat = score.reshape(texts, width)
        least = np.partition(flat, width - k, axis=1)[:, width - k] if width >= k else np.zeros(texts)
        i, j = np.nonzero((flat >= least[:, None]) & (flat > 0))
        example, cosine = self.order[j], flat[i, j]
        by = np.lexsort((example, -cosine, i))
        by = by[np.arange(len(by)) - np.searchsorted(i[by], i[by]) < k]
        return i[by], example[by], cosine[by]

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """``search`` of a single text."""
        return self.search(np.zeros(len(term), np.int64), term, weight, 1, k)[1:]


def _unpickled(examples: int, row: np.ndarray, n: np.ndarray, weight: np.ndarray, order: np.ndarray) -> BlockMaxIndex:
    index = BlockMaxIndex.__new__(BlockMaxIndex)
    index._hold(examples, row, n, weight, order.astype(np.int64), False)
    return index


def _vectors(row, term, times, idf, rows_n):
    """Sublinear TF-IDF weights of unit length. They are multiples of 1 / UNIT,
    so that sums of products are exact in any order: equal texts score alike."""
    weight = (1 + np.log(times)) * idf[term]
    length = np.sqrt(np.bincount(row, weight * weight, minlength=rows_n))
    return np.round(weight / length[row] * UNIT) / UNIT


def _logit(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


class Model:
    """What the fit leaves: vocabulary, idf, index, labels and vote weights."""

    def __init__(self, vocabulary, idf, index, ids, toxic, share, prior, k):
        self.vocabulary, self.idf, self.index, self.ids = vocabulary, idf, index, ids
        # An example stands for as many labelled rows as its label has for each example.
        self.toxic, self.share, self.prior, self.k = toxic, share, prior, k
        self.slope, self.offset, self.shared = 1.0, 0.0, None

    def broadcast(self, spark):
        """This model in the workers' memory, once for fit and scores, before it is calibrated."""
        if self.shared is None:
            self.shared = spark.sparkContext.broadcast(self)
        return self.shared

    def __getstate__(self):
        return self.__dict__ | {"shared": None}

    def nearest(self, column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, example, cosine) of the k nearest examples of each text."""
        hashes, rows = terms(column)
        row, term, times = _counts(hashes, rows, self.vocabulary)
        weight = _vectors(row, term, times, self.idf, len(column)) if len(row) else np.zeros(0)
        return self.index.search(row, term, weight, len(column), k)

    def score(self, column: pa.Array, slope: float, offset: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The scores of the texts, and (row, example, cosine) of their nearest examples."""
        row, example, cosine = self.nearest(column, self.k)
        vote = self.vote(row, example, cosine, len(column))
        return 1 / (1 + np.exp(-(slope * _logit(vote) + offset))), row, example, cosine

    def calibrate(self, votes: np.ndarray) -> None:
        """Logistic curve from the votes of each example's nearest other examples
        to its label, by Newton's steps with a small ridge that keeps it finite."""
        x = np.stack([_logit(votes), np.ones(len(votes))])
        at, start = np.array([1.0, 0.0]), np.array([1.0, 0.0])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(at @ x, -30, 30)))
            slope = x @ (self.share * (self.toxic - p)) - (at - start)
            at = at + np.linalg.solve((x * (self.share * p * (1 - p))) @ x.T + np.eye(2), slope)
        if np.isfinite(at).all() and at[0] > 0.1:
            self.slope, self.offset = float(at[0]), float(at[1])

    def vote(self, row: np.ndarray, example: np.ndarray, cosine: np.ndarray, texts: int) -> np.ndarray:
        """Shares of toxic among the votes, before they are calibrated. A vote weighs cosine / (distance + 0.1)
        times the example's share; one vote of the prior keeps scores of few or
        far examples near it."""
        votes = self.share[example] * cosine / (1.1 - np.minimum(cosine, 1.0))
        toxic = np.bincount(row, votes * (self.toxic[example] > 0), minlength=texts)
        return (toxic + self.prior) / (np.bincount(row, votes, minlength=texts) + 1.0)


def held_out(id_col: Column, folds: int = 5) -> Column:
    """Whether crc32 of the id as text falls into fold 0 (a null id: no)."""
    return F.coalesce(F.crc32(id_col.cast("string")) % folds == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
        train: Column | None = None, max_examples: int = MAX_EXAMPLES, k: int = 7, least: float = 0.03) -> Model:
    """Fit on the labelled rows of ``labels`` that ``train`` (a condition on its
    id) keeps. Of each label, the ``max_examples`` ids with the smallest hash
    of the id are examples; an id that is labelled more than once counts as
    toxic if any of its labels is, null labels do not count, and of several
    texts of one id the least is the example. Without any example, every text
    scores 0.5. All terms of the examples are indexed; a term's weight is its
    TF-IDF times its correlation (phi) with the label, but ``least`` at least.
    """
    spark = prepare(docs)
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").cast("int").alias("y"))
    known = known.filter("id is not null and y is not null")
    if train is not None:
        known = known.filter(train)
    known = known.groupBy("id").agg((F.max("y") > 0).cast("int").alias("y"))
    total = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    few = [known.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(max_examples) for y in (0, 1)]
    chosen = stored(few[0].union(few[1]), "toxicity-ids")  # 2 * max_examples ids at most
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    examples = (texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("y").alias("y"), F.min("text").alias("text")))
    examples = stored(examples, "toxicity-examples")

    def count_terms(batches):
        for batch in batches:
            for part in slices(batch, "text", BYTES):
                h, r = terms(part.column(2))
                y = part.column(1).to_numpy()
                order = np.lexsort((r, h))
                h, r = h[order], r[order]
                new = np.append(True, (h[1:] != h[:-1]) | (r[1:] != r[:-1]))[:len(h)]
                term, place = np.unique(h[new], return_inverse=True)
                toxic = np.bincount(place, y[r[new]], minlength=len(term))
                n = np.bincount(place, minlength=len(term))
                yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(toxic.astype(np.int64)),
                                                  pa.array((n - toxic).astype(np.int64))], ["term", "toxic", "clean"])

    seen = {r.y: r.n for r in examples.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic_n, clean_n = seen.get(1, 0), seen.get(0, 0)
    counted = examples.select("id", "y", "text").mapInArrow(count_terms, "term long, toxic long, clean long")
    # One row a term: the texts of the examples bound them.
    counted = counted.groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b")).toArrow()
    vocabulary = counted["term"].to_numpy().view(_U)
    order = np.argsort(vocabulary)
    vocabulary, a, b = vocabulary[order], *(counted[c].to_numpy()[order].astype(float) for c in ("a", "b"))
    # Phi of (term, label) over the examples; a term of all examples or none says nothing.
    spread = toxic_n * clean_n * (a + b) * (toxic_n + clean_n - a - b)
    phi = np.abs(a * (clean_n - b) - b * (toxic_n - a)) / np.sqrt(np.maximum(spread, 1.0))
    vocabulary = Vocabulary(vocabulary)
    held = spark.sparkContext.broadcast(vocabulary)

    def count_docs(batches):
        n, df = 0, np.zeros(len(held.value), np.int64)
        for batch in batches:
            n += batch.num_rows
            for part in slices(batch, "text", BYTES):
                h, r = terms(part.column(0))
                df += np.bincount(_counts(h, r, held.value)[1], minlength=len(df))
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"place": np.append(-1, some), "n": np.append(n, df[some])})

    sums = (texts.select("text").mapInArrow(count_docs, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
            .toArrow())  # one row a term
    df = np.zeros(len(vocabulary) + 1, np.int64)  # the last: all texts
    df[sums["place"].to_numpy()] = sums["n"].to_numpy()
    idf = (np.log((1 + df[-1]) / (1.0 + df[:-1])) + 1) * (np.maximum(phi, least) if toxic_n and clean_n else 1.0)
    del counted, sums, order, a, b, spread, phi, df  # the driver's memory is small

    def vectors(batches):
        for batch in batches:
            for part in slices(batch, "text", BYTES):
                h, r = terms(part.column(2))
                row, term, times = _counts(h, r, held.value)
                cut = np.searchsorted(row, np.arange(part.num_rows + 1))
                units = np.round(_vectors(row, term, times, held_idf.value, part.num_rows) * UNIT).astype(np.int32) if len(row) else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(term, pa.int32())),
                     pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(units, pa.int32()))], ["id", "y", "terms", "units"])

    kind = T.StructType([chosen.schema["id"], T.StructField("y", T.IntegerType()),
                         T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("units", T.ArrayType(T.IntegerType()))])
    held_idf = spark.sparkContext.broadcast(idf)
    # At most 2 * max_examples rows.
    rows = examples.select("id", "y", "text").mapInArrow(vectors, kind).toArrow().sort_by("id").combine_chunks()
    held.destroy()
    held_idf.destroy()
    n = np.diff(rows["terms"].combine_chunks().offsets.to_numpy()) if rows.num_rows else np.zeros(0, np.int64)
    row = np.repeat(np.arange(rows.num_rows, dtype=np.int32), n)
    term, units = (rows[c].combine_chunks().flatten().to_numpy() for c in ("terms", "units"))
    index = BlockMaxIndex(rows.num_rows, row, term, units, len(vocabulary))
    toxic = rows["y"].to_numpy().astype(np.int64) if rows.num_rows else np.zeros(0, np.int64)
    share = np.where(toxic > 0, total.get(1, 0) / max(toxic_n, 1), total.get(0, 0) / max(clean_n, 1))
    share = share / share.min() if len(share) else share
    # The prior is that of the texts that no example reaches: of such examples, and one of the mean of all.
    bare = n == 0
    mean = total.get(1, 0) / (total.get(1, 0) + total.get(0, 0)) if rows.num_rows else 0.5
    prior = (float((share * toxic)[bare].sum()) + mean) / (float(share[bare].sum()) + 1.0)
    ids = rows["id"].to_numpy() if rows.num_rows else np.zeros(0, np.int64)
    model = Model(vocabulary, idf, index, ids, toxic, share, prior, k)
    del rows, n, row, term, units
    pa.default_memory_pool().release_unused()
    if toxic_n and clean_n:
        known_model = model.broadcast(spark)

        def votes(batches):
            model = known_model.value
            where = {i: at for at, i in enumerate(model.ids.tolist())}
            for batch in batches:
                for part in slices(batch, "text", BYTES):
                    me = np.array([where[i] for i in part.column(0).to_pylist()])
                    row, example, cosine = model.nearest(part.column(1), k + 1)
                    other = example != me[row]  # the nearest k without the example itself
                    row, example, cosine = row[other], example[other], cosine[other]
                    first = np.arange(len(row)) - np.searchsorted(row, row) < k
                    yield pa.RecordBatch.from_pydict({"at": me, "vote": model.vote(row[first], example[first], cosine[first], len(me))})

        # At most 2 * max_examples numbers.
        found = examples.select("id", "text").repartition("id").mapInArrow(votes, "at long, vote double").toArrow()
        order = np.argsort(found["at"].to_numpy())
        model.calibrate(found["vote"].to_numpy()[order])
    return model


def score(docs: DataFrame, model: Model, text: str = "text", evidence: int = 5) -> DataFrame:
    """``docs`` with score (0 to 1), predicted (1 from a score of 0.5 on),
    evidence (ids of the nearest examples) and evidence_cosine. Only the text
    is an input: equal texts have equal scores. Null and empty texts, and
    those without a term of any example, have the score of such examples.
    Columns of those names are replaced; all rows and other columns stay."""
    spark = prepare(docs)
    names = ["score", "predicted", "evidence", "evidence_cosine"]
    docs = docs.drop(*(c for c in names if c != text))
    held, slope, offset = model.broadcast(spark), model.slope, model.offset  # of bounded size, see fit
    fields, source = list(docs.schema.fields), text
    if [f.dataType for f in fields if f.name == text] != [T.StringType()]:  # else the texts are sent once
        source = free_name(docs, "_source")
        docs = docs.withColumn(source, F.col(f"`{text}`").cast("string"))
    place = docs.columns.index(source)
    schema = T.StructType([*fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
                           T.StructField("evidence", T.ArrayType(T.LongType())),
                           T.StructField("evidence_cosine", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for batch in batches:
            for part in slices(batch, source, 1 << 20):
                found, row, example, cosine = held.value.score(part.column(place), slope, offset)
                shown = np.arange(len(row)) - np.searchsorted(row, row) < evidence
                cut = pa.array(np.searchsorted(row[shown], np.arange(part.num_rows + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(fields)], pa.array(found), pa.array((found >= 0.5).astype(np.int32)),
                     pa.ListArray.from_arrays(cut, pa.array(held.value.ids[example[shown]], pa.int64())),
                     pa.ListArray.from_arrays(cut, pa.array(cosine[shown]))],
                    [*part.schema.names[:len(fields)], *names])

    return docs.mapInArrow(run, schema)
