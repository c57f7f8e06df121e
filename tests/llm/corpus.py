"""Small corpora for the operators' tests, and brute-force counterparts."""

import random
import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    made = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 9))) for _ in range(vocabulary)]
    return " ".join(rng.choice(made) for _ in range(n))


def odd_rows():
    """Nulls in every column, empty and blank texts, ties, repeated rows, other scripts, a long text."""
    long = prose(1, 6000)
    return [
        (1, prose(2, 120), "en", "a", 1),
        (2, prose(2, 120), "en", "a", 1),
        (2, prose(2, 120), "en", "a", 1),
        (3, prose(3, 90) + "\nLine again.\nLine again.\n" + prose(4, 60), "fr", None, None),
        (4, None, None, None, None),
        (5, "", "en", "b", 0),
        (6, " \t\n\x0b\f\r ", "en", "b", 7),
        (None, prose(5, 70), "de", "a", 3),
        (None, prose(2, 120), "de", "a", 3),
        (7, long, "en", "a", 9),
        (8, prose(6, 30) + " " + " ".join(long.split()[1000:1100]), "en", "a", 2),
        (9, "Ünï çödé 漢字 И́ван　x\x1cy ퟿ it's DON'T 12 #$%", "xx", "c", 4),
        (10, "la " * 3000, "en", "a", 5),
        (11, prose(2, 120).upper(), "en", "a", 6),
        (12, "one two", "en", "a", 2),
    ]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(df):
    return [tuple(row) for row in df.collect()]
