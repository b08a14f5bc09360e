"""Small tables with the awkward cases that every operator must take."""
import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def corpus(n=60, seed=3):
    """Rows of DOCS: random texts, exact and near copies, shared passages, null
    and empty texts, a long one, a repeated row, null ids and sources."""
    rng = random.Random(seed)
    rows, base = [], []
    passage = words(rng, 20)
    for i in range(n):
        w = words(rng, rng.choice([3, 12, 13, 40, 90, 200]))
        if i % 7 == 3 and base:
            w = list(base[rng.randrange(len(base))])  # an exact copy
        elif i % 7 == 5 and base:
            w = list(base[rng.randrange(len(base))])  # a near copy
            w[len(w) // 2] = f"edit{i}"
        elif i % 6 == 1:
            w[5:5] = passage
        base.append(w)
        text = (" " if i % 3 else "\n").join(w)
        rows.append((i, text, "en", f"s{i % 4}" if i % 9 else None, len(text)))
    long = " ".join(words(rng, 6000))
    rows += [(n, None, None, None, None), (n + 1, "", "en", "s1", 0), (n + 2, " \t\n\x0b", "en", "s1", 4),
             (n + 3, long, "fr", "s2", len(long)), rows[0], (None, rows[2][1], "en", "s0", 1),
             (n + 4, "naïve ☃ 日本 words", "en", "s3", 1), (n + 5, "alone", "en", "", 1)]
    return rows
