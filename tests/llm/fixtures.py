"""Small tables with the cases that every operator must stand."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, _t string, fp long, size string, key string, h string"


def prose(rng: random.Random, n: int, letters: str = "abcdefgh") -> str:
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(300)]
    return " ".join(rng.choice(words) + rng.choice(["", "", "", ",", ".", ".\n"]) for _ in range(n))


def edited(rng: random.Random, text: str, n: int) -> str:
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = "EDIT" + str(rng.randrange(100))
    return " ".join(words)


def texts() -> list[str | None]:
    rng = random.Random(7)
    some = [prose(rng, rng.randint(5, 200), "abcdefgh" if i % 2 else "ijklmnopé") for i in range(40)]
    near = [edited(rng, some[3], 1) for _ in range(8)] + [edited(rng, some[5], 2) for _ in range(5)]
    shared = prose(rng, 80)
    holders = [prose(rng, 40) + "\n" + shared + "\n" + prose(rng, 30) for _ in range(4)]
    odd = [None, None, "", "", " \n\t ", "\n\n", "one", "Two words", "ÀÉÎ über straße", "😀 emoji 👍🏽 x", "a" * 5000, ("word " * 20000).strip()]
    lines = ["same line here\nother " + str(i) + "\n  SAME line HERE \t\nshort" for i in range(4)]
    return some + near + [some[0]] * 6 + holders + odd + lines


def rows() -> list[tuple]:
    out = [(i * 7 % 1009, t, ("en", "fr", None)[i % 3], ("a", "b", None, "é", "z")[i % 5] if i % 2 else "hot", None if t is None else len(t), "x", None, i, "s", "k", "h") for i, t in enumerate(texts())]
    return out + [out[2], out[2], (None, "row without an id", "en", "a", 17, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None, None)]


def docs(spark, which=None):
    return spark.createDataFrame(rows() if which is None else which, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def got(df, *cols):
    """Rows as sorted tuples; None sorts first."""
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
