"""Each statistic rejects texts by itself, beside clean ones of the same group."""

import random

import corpus
import pytest

from tidemark.llm import quality_rules


def clean(i):
    words = corpus.prose(i, 120).split()
    return "\n".join(" ".join(words[k : k + 12]) for k in range(0, 120, 12)) + "."


def dup_lines(i):
    # Lines of four words: no window of eight stands twice as the lines between differ.
    words = corpus.prose(1000 + i, 120).split()
    same = " ".join(words[:4])
    return "\n".join(x for k in range(4, 120, 10) for x in (same, " ".join(words[k : k + 10]))) + "."


def repeats(i):
    words = corpus.prose(2000 + i, 120).split()
    words[60:76] = words[20:36]
    return "\n".join(" ".join(words[k : k + 12]) for k in range(0, 120, 12)) + "."


def symbols(i):
    rng = random.Random(i)
    return "".join(c + rng.choice("#*$%&|<>") if rng.random() < 0.2 else c for c in clean(3000 + i))


def marks(i):
    rng = random.Random(i)
    return "".join(c + rng.choice(",;:") if rng.random() < 0.25 else c for c in clean(4000 + i))


def word_length(i):
    return clean(5000 + i).replace(" ", "x", 90)


@pytest.mark.parametrize("junk", [dup_lines, repeats, symbols, marks, word_length])
def test_one_statistic_alone_rejects(spark, junk):
    rows = [(i, clean(i), "en", "a", 1) for i in range(150)]
    rows += [(1000 + i, junk(i), "en", "a", 1) for i in range(10)]
    docs = spark.createDataFrame(rows, corpus.SCHEMA)
    found = quality_rules.quality(docs).collect()
    assert not any(r.base_failed for r in found)
    if junk is dup_lines:
        assert all(r.n_repeat_words == 0 for r in found)
    kept = {r.doc_id for r in found if r.kept}
    assert not any(i >= 1000 for i in kept)
    assert len(kept) >= 145
