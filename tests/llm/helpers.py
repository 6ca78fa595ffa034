"""Small documents with every awkward case, and brute-force versions of the operators."""

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def passage(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(60)) for _ in range(n))


def frame(spark, rows):
    """doc_id, text and columns whose names clash with results."""
    full = [(i, t, "en", "s", 1, "x", 2.5) for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_words int, spans string, score double")


def awkward():
    """Null ids and texts, blanks, copies, repeated rows, odd white space, one very long text."""
    base = passage(1, 60)
    return [
        (1, base),
        (2, None),
        (3, ""),
        (4, " \t\n "),
        (5, base),
        (6, base.replace(" ", "\t \n")),
        (7, base + " " + passage(2, 9)),
        (7, base + " " + passage(2, 9)),
        (8, passage(3, 5)),
        (9, "one"),
        (10, "naïve ÉTÉ   日本 " + passage(4, 30)),
        (None, base),
        (None, None),
        (11, passage(5, 20_000)),
        (12, passage(6, 20) + " " + base[: len(base) // 2] + " " + passage(7, 20)),
        (13, "\x0b".join(base.split()[:30]) + "\x0c" + "\r\n".join(base.split()[30:]) + "\r"),
        (14, base.replace(" ", "\u00a0")),
    ]
