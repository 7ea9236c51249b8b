"""Small fixtures shared by the tests of the text operators."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng: random.Random, n: int) -> str:
    words = ["".join(rng.choice("abcdeéßñ") for _ in range(rng.randint(1, 7))) for _ in range(n)]
    return " ".join(words).capitalize() + "."


def awkward_rows():
    """Nulls in every column, empty and blank texts, a very long text, repeated rows and equal texts under several ids."""
    rng = random.Random(3)
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, " \t\n\r\x0b\x0c ", "en", None, 7), (None, "a text without id. It has words enough for rules.", "en", "s", None),
            (None, None, None, None, None), (4, "é", "fr", "s", 1), (5, "one two", "en", "s", 7), (5, "one two", "en", "s", 7),
            (6, "\n\n\n", "de", "s", 3), (7, "　 nbsp are word characters here", "en", "s", 1), (8, "🙂 😀 \x00 end", "en", "s", 1)]
    body = "\n".join(sentence(rng, 12) for _ in range(6))
    rows += [(k, body, "en", "s", len(body)) for k in (20, 21, 21, 22)]
    rows.append((30, "\n".join(sentence(rng, 20) for _ in range(3000)), "en", "s", None))
    return rows


def awkward(spark, clash: bool = True):
    """The awkward rows; ``clash`` adds columns named like the operators' own."""
    df = spark.createDataFrame(awkward_rows(), SCHEMA)
    if clash:
        for name in ("id", "n", "key", "items", "kept", "n_words", "n_tokens", "score", "component", "bucket", "span", "word", "_text", "removed"):
            df = df.selectExpr("*", f"'x' as `{name}`")
    return df


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
