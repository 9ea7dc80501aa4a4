"""Small tables with everything that operators must take: missing cells, empty, blank and long texts,
ties, repeated rows, and columns whose names operators use themselves."""

import random

CLASHING = "id long, class string, score string, copies int, n int, token string, hub string, `a.b` int"
DOCUMENTS = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
EXTRA = (7, "c", "s", 2, 3, "t", "h", 1)


def prose(seed, words, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def rows():
    long = prose(1, 30_000)
    texts = [
        (1, prose(2, 80)), (2, prose(3, 60) + "\n" + prose(4, 50)), (3, prose(2, 80)), (4, None), (5, ""),
        (6, " \n\t "), (7, "one"), (8, long), (None, prose(5, 70)), (10, prose(6, 5)), (10, prose(7, 30)),
        (11, "ünïcode — \u00a0 “quoted” 日本語 " + prose(8, 20)), (12, "a"), (13, "x" * 5000), (-4, prose(9, 90)),
    ]
    out = [(i, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"src{k % 3}", None, *EXTRA) for k, (i, t) in enumerate(texts)]
    return [*out, out[1], out[1], out[3]]


def documents(spark, more=()):
    return spark.createDataFrame([*rows(), *more], DOCUMENTS)
