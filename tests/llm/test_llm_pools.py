"""Pools of one tier only."""

import pytest
from test_llm_models import BPE, check_packing

from tidemark.llm import packing


@pytest.mark.parametrize(("length", "tier"), [(1500, 2048), (1025, 2048), (2047, 2048), (700, 1024), (300, 512)])
def test_a_pool_of_one_tier_empties(length, tier):
    packer = packing.Packer(packing.TIERS)
    made, given = [], 0
    for pool in range(5):
        for doc in range(40):
            made += packer.route(40 * pool + doc, 0, length)
            given += length
        made += packer.fill()
        waiting = sum(size for line in packer.waiting.values() for size, _, _ in line)
        assert waiting < sum(packing.TIERS)
        assert waiting + sum(size for size, _ in made) == given
    assert sum(size == tier for size, _ in made) * tier > 0.9 * given
    assert len(packer.fill(last=True)) <= 40


def test_packing_documents_of_one_tier(spark):
    rows = [(i, "word " * (1400 + i)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    pieces = packing.pack(docs, BPE, pool=5000).collect()
    check_packing(rows, pieces, packing.TIERS)
    assert sum(r.length for r in pieces if r.tier == 2048) > 0.9 * sum(r.length for r in pieces)
