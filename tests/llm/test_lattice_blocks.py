"""Round trips by blocks: words move once a block, texts are read once."""

import random

import pyarrow as pa
import pytest

from tessera.llm import sentencepiece_lattice

RNG = random.Random(5)
WORDS = ["".join(RNG.choices("abcdefghijklmnop", k=7)) for _ in range(3_000)]
TEXTS = {k: " ".join(RNG.choices(WORDS, k=500)) for k in range(400)}


@pytest.fixture(scope="module")
def many(spark):
    return spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string").repartition(2).cache()


def test_occurrences_do_not_move(spark, many):
    """Without broadcast words, each of 200,000 occurrences was a row of two shuffles: several times the texts."""
    many.count()
    moved = lambda: spark.sparkContext._jsc.sc().statusStore().executorList(False).apply(0).totalShuffleWrite()
    before = moved()
    got = sentencepiece_lattice.round_trips(many, hot=0).collect()
    assert len(got) == len(TEXTS) and all(r.round_trip for r in got)
    assert moved() - before < sum(map(len, TEXTS.values()))


@pytest.mark.parametrize("block", [1, 20_000])
def test_blocks_in_a_partition(many, block):
    p = sentencepiece_lattice.processor()
    some = many.where("doc_id < 40").coalesce(1)
    assert {r.doc_id: list(r.ids) for r in sentencepiece_lattice.round_trips(some, block=block).collect()} == {k: p.encode(TEXTS[k]) for k in range(40)}


def test_texts_that_differ_when_read_again(spark):
    """Two reads of one row gave other words each, so the row's words didn't meet."""

    def drawn(batches):
        import os

        for b in batches:
            text = [" ".join(os.urandom(3).hex() for _ in range(1 + os.urandom(1)[0])) for _ in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text)], names=["doc_id", "text"])

    rows = sentencepiece_lattice.round_trips(spark.range(20).mapInArrow(drawn, "doc_id long, text string"), hot=0).collect()
    assert len(rows) == 20 and all(r.round_trip for r in rows)
