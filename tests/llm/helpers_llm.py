"""Small tables with every edge case, and plain forms of the operators to hold them against."""

import random

LONG = " ".join(f"w{i % 997}" for i in range(30_000))
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string, content string, chunk bigint, key bigint, _row string"


def documents(spark, seed=3, n=60):
    """Nulls in any column, empty and very long texts, ties and repeated rows, extra columns with clashing names."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4)))
    base = ["\n".join(" ".join(word() for _ in range(rng.randint(3, 14))) for _ in range(rng.randint(1, 9))) for _ in range(12)]
    rows = []
    for i in range(n):
        text = rng.choice(base)
        if rng.random() < 0.5:
            words = text.split(" ")
            words[rng.randrange(len(words))] = word()
            text = " ".join(words)
        rows.append((i, text, "en", rng.choice(["a", "b", "b", "b", "ü", None])))
    rows += [(100, None, None, None), (101, "", "en", "a"), (102, "  \n\t ", "en", "a"), (103, LONG, "en", "long"), (104, LONG + " tail", "en", "long")]
    rows += [(105, "x y", "en", "a"), (106, "X  y", "en", "a"), (107, "one two three four five", None, "b"), (None, base[0], "en", "a"), (None, None, None, None)]
    rows += [rows[0], rows[0], (1, base[3], "en", "b"), (108, "\x1c odd\x85 space\xa0here", "en", "b"), (109, "Straßé \U0001f642 漢字 ²½", "en", "b")]
    return spark.createDataFrame([(*r, 7, "d", "c", 5, 6, "r") for r in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, size=5):
    w = words(text)
    return {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def roots(n, pairs):
    """Root of each of ``n`` nodes under ``pairs``."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]
