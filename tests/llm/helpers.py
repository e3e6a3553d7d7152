"""Small tables with every awkward case, and plain versions of what the operators compute."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use inside; a user's table may have them too.
CLASHING = "score double, n long, fp string, size long, i long, copies long, predicted int, root long, node long"


def awkward(spark, extra=False):
    """Nulls in every column, blank, empty and long texts, repeated rows, one id with two texts."""
    long = "word " * 30_000
    rows = [
        (1, None, "en", "a", None), (2, "", None, "a", 0), (3, " \n\t ", "en", None, 4), (4, long, "en", "b", len(long)),
        (5, "x" * 100_000, "en", "b", 100_000), (None, "no id here at all", "en", "c", 17), (None, None, None, None, None),
        (7, "same row twice in here", "en", "c", 22), (7, "same row twice in here", "en", "c", 22),
        (8, "one id", "en", "c", 6), (8, "one id but another text", "en", "c", 23), (9, "É\u00a0ü \x1c 日本 ½ 😀", "fr", "a", 14),
        (10, "same row twice in here", "en", "c", 22),
    ]
    if not extra:
        return spark.createDataFrame(rows, DOCS)
    return spark.createDataFrame([r + (0.5, 1, "f", 2, 3, 4, 5, 6, 7) for r in rows], f"{DOCS}, {CLASHING}")


def empty(spark):
    return spark.createDataFrame([], DOCS)


def groups(links, ids):
    """Smallest id of each one's component."""
    root = {i: i for i in ids}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = top(a), top(b)
        root[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def prose(seed, words, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))
