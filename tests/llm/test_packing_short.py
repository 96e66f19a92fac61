"""Little padding whatever the lengths: plans for pieces of one short length, and a small table of short documents."""
import pytest

from estatelens.llm import packing


@pytest.mark.parametrize("length", [1, 9, 17, 30, 63, 64])
def test_padding_of_short_pieces(length):
    n = 400_000
    inner, bundles = packing._plan({length: n}, packing.BUNDLE)
    _, sequences = packing._plan({packing.BUNDLE // packing.UNIT: bundles}, packing.CAPACITY // packing.UNIT)
    assert sum(last - first for first, last, _, _ in inner[length]) == n
    assert 1 - n * length / (sequences * packing.CAPACITY) <= 0.02


def test_short_and_long_pieces_share_sequences(spark):
    rows = [(i, "" if i % 3 else "word " * (i % 40)) for i in range(3000)] + [(5000 + i, "some text " * (20 * i)) for i in range(60)] + [(9000, None)]
    got = packing.packed(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    total = 0
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
        total += at
    assert {r["doc_id"] for r in got} == {r[0] for r in rows}
    assert total == sum(r["doc_tokens"] for r in got if r["start"] == 0) and sorted(by) == list(range(len(by)))
    assert 1 - total / (len(by) * packing.CAPACITY) <= 0.05
