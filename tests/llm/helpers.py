"""Small inputs and plain reimplementations for the corpus operators."""

import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_LOW = str.maketrans({c: chr(c + 32) for c in range(65, 91)})

#: Columns beside doc_id, text and source, named like the operators' own.
EXTRA = "lang string, score double, node long, region long, size long, key string, label int, taken long"


def words(text):
    return WORDS.findall((text or "").translate(_LOW))


def documents(spark, rows):
    """rows: (doc_id, text, source), with further columns whose names clash."""
    data = [(i, t, s, "en", 1.0, 7, 7, 7, "k", 1, 1) for i, t, s in rows]
    return spark.createDataFrame(data, f"doc_id long, text string, source string, {EXTRA}")


def pages(rng, n, vocabulary=400, low=1, high=120):
    """Texts of random words, some repeated with a word or two changed."""
    out = []
    for i in range(n):
        if out and rng.random() < 0.5:
            copy = out[rng.randrange(len(out))].split(" ")
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = f"w{rng.randrange(vocabulary)}"
            out.append(" ".join(copy))
        else:
            out.append(" ".join(f"w{rng.randrange(vocabulary)}" for _ in range(rng.randint(low, high))))
    return out
