"""Small documents with all the odd cases: nulls, empty and long texts, ties, repeats, clashing column names."""

import random
import re

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "row_no long, size long, n long, kept string, key string, component string, text_key string, length string, _id long"
)
OWN = ["doc_id", "text", "lang", "source", "n_chars"]
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def frame(spark, rows):
    """Documents (doc_id, text[, source]) with clashing further columns."""
    full = []
    for r in rows:
        doc_id, text, source = (*r, "src")[:3]
        full.append((doc_id, text, "en", source, len(text) if text is not None else None, 1, 2, 3, "x", "y", "z", "w", "v", 9))
    return spark.createDataFrame(full, SCHEMA)


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"{r.choice(WORDS)}{r.randrange(vocabulary)}" for _ in range(n))


def odd_rows():
    base = prose(1, 60)
    return [
        (1, base),
        (2, base + " "),
        (3, "  " + base.replace(" ", "\t", 3)),
        (4, base.replace(" ", " extra ", 1)),
        (5, None),
        (6, ""),
        (7, " \n\t"),
        (8, "Word"),
        (9, "word"),
        (10, prose(2, 30_000)),
        (10, prose(3, 20)),
        (11, prose(4, 45), None),
        (11, prose(4, 45), None),
        (None, prose(5, 30), ""),
        (None, None),
        (12, base),
        (13, "ÉCOLE ñandú  x\x0by\x1cz"),
    ]


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})
