"""Small tables with awkward rows."""

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, node long, key string, row string, n_words string, doc string, version string"


def frame(spark, texts, ids=None):
    """Documents with columns whose names operators use themselves."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "s", None if t is None else len(t), 1, "k", "r", "w", "d", "v") for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, COLUMNS)


def prose(seed, n, size=400):
    """n words that hardly repeat in fives."""
    rng = random.Random(seed)
    vocabulary = ["".join(random.Random(k).choices("abcdefghijklmnop", k=3 + k % 6)) for k in range(size)]
    return [rng.choice(vocabulary) for _ in range(n)]


def text(words):
    """Words in sentences and lines."""
    out = []
    for k, w in enumerate(words):
        out.append(w + ("." if k % 9 == 8 else ""))
    return "\n".join(" ".join(out[k : k + 30]) for k in range(0, len(out), 30))


AWKWARD = [None, "", " \t\n ", "a", "\u00c9t\u00e9 \u00df", "x" * 3000, "one two three four", "!!! ??? ...", "\x00 zero \x01 one"]
