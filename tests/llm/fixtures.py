"""Small tables with every awkward row the operators promise to handle."""

from __future__ import annotations

import random


#: Extra columns whose names the operators use inside.
CLASHES = ("whole", "bits", "size", "place", "kept", "cleaned", "row_key_a", "times", "target", "spot", "list", "root", "part", "ids", "short", "plain")


def words(rng: random.Random, n: int) -> str:
    stock = ["the", "river", "stone", "carries", "light", "over", "small", "houses", "while", "people", "talk", "about", "weather", "and", "bread"]
    return " ".join(rng.choice(stock) + (rng.choice("abcdefgh") if rng.random() < 0.5 else "") for _ in range(n)) + "."


def awkward(seed: int = 1) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars) with nulls in any column, empty and very long texts, ties and repeats."""
    rng = random.Random(seed)
    text = [words(rng, 60 + n) for n in range(12)]
    rows = [(n, t, "en", f"s{n % 3}", len(t)) for n, t in enumerate(text)]
    rows += [(20, None, "en", "s0", 0), (21, "", "fr", "s1", 0), (22, " \n\t", None, "s1", 3), (None, text[0] + "x", "en", "s2", 5),
             (None, text[1].upper(), "fr", None, 5), (25, words(rng, 30_000), "fr", None, 1), (26, text[3] + "\n\n" + text[4], "fr", "s0", 9),
             (27, text[2], "en", "s2", None), (28, text[2].replace(" ", "  "), "en", "s0", 7), (29, text[2], "en", "s2", 1)]
    rows += [(30, text[5], "fr", "s1", 4)] * 3 + [(31, "Öl, ñandú! ß x", "de", "s4", 9), (32, "日本語 の 文", "ja", "s4", 6), (33, "12 34 %", "fr", "s4", 6)]
    return rows


def table(spark, rows: list[tuple], clashes: bool = True):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    if clashes:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("x") for c in CLASHES})
    return df


