"""Texts of hundreds of thousands of words, and runs of a million characters, through the operators that hold words in order."""

import random

import numpy as np
import pytest

from tessera.llm import lm_scoring, sentencepiece_lattice, substring_dedup

RNG = random.Random(11)
RUN = "".join(RNG.choices("abcdefgh0123", k=1_000_000))
MANY = [f"w{RNG.randrange(3000)}" for _ in range(400_000)]
TEXTS = {1: RUN, 2: " ".join(MANY), 3: " ".join(["new"] * 3 + MANY[200_000:200_080] + ["tail"]), 4: "x " + RUN + " y", 5: " ".join(MANY[::-1]), 6: "a b c"}


@pytest.fixture(scope="module")
def long_docs(spark):
    return spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string").cache()


def test_lm_of_long_texts(long_docs):
    shape = lm_scoring.Shape(4, 16, 4, 2, 4, 4)
    got = {r.doc_id: r for r in lm_scoring.pseudo_likelihood(long_docs, shape).collect()}
    assert {k: r.n_words for k, r in got.items()} == {k: len(t.split()) for k, t in TEXTS.items()}
    assert all(np.isfinite(r.log_probability) and r.log_probability < 0 for r in got.values())


def test_substrings_of_long_texts(long_docs):
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.report(long_docs, window=50).collect()}
    first = {}
    want = {}
    for k, t in TEXTS.items():  # ids ascend
        w, gone = t.split(), set()
        windows = [hash(tuple(w[i : i + 50])) for i in range(len(w) - 49)]
        for i, h in enumerate(windows):
            if first.setdefault(h, k) < k:
                gone.update(range(i, i + 50))
        want[k] = len(w), len(gone)
    assert got == want and want[3] == (84, 80)


def test_sentencepiece_of_long_texts(long_docs):
    p = sentencepiece_lattice.processor()
    rows = sentencepiece_lattice.round_trips(long_docs.where("doc_id not in (1, 4)")).collect()
    assert len(rows) == 4 and all(list(r.ids) == p.encode(TEXTS[r.doc_id]) and r.round_trip for r in rows)


def test_sentencepiece_of_a_long_run(spark):
    """A word of 20,000 characters is one group of the lattice: its edges are folded by one task."""
    p = sentencepiece_lattice.processor()
    row = sentencepiece_lattice.round_trips(spark.createDataFrame([(1, RUN[:20_000])], "doc_id long, text string")).first()
    assert list(row.ids) == p.encode(RUN[:20_000]) and row.round_trip
