"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, extra columns."""

import random

WORDS = [a + b for a in ("ka", "lo", "mi", "re", "tu", "so", "ne", "vi") for b in ("ba", "do", "fe", "gi", "hu", "jy", "pol", "rst", "qua", "zen")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def text(rng, sentences=8, words=9):
    return " ".join(sentence(rng, rng.randint(3, 2 * words)) for _ in range(sentences))


def documents(spark, rows, **more):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


AWKWARD = [(None, "a b c d e f"), (1, None), (2, ""), (3, " \n\t "), (4, "x"), (5, "ß é\x00   日本"), (6, "a b c d e f"), (6, "a b c d e f")]
