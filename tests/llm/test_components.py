import random

import pytest

from countlens.llm import components as components_module
from countlens.llm.components import components
from tests.llm import helpers as hp


def check(spark, edges, n):
    classes = hp.Union(n)
    for x, y in edges:
        classes.join(x, y)
    least = classes.least(list(range(n)))
    touched = {v for x, y in edges if x != y for v in (x, y)}
    got = components(spark.createDataFrame(edges, "x long, y long")).collect()
    assert {(r["node"], r["component"]) for r in got} == {(v, least[v]) for v in touched}
    assert len(got) == len(touched)


@pytest.mark.parametrize("block", [100_000, 25])
def test_random_chain_star_and_loops(spark, monkeypatch, block):
    """In one block, and in several that star rounds join."""
    monkeypatch.setattr(components_module, "BLOCK_EDGES", block)
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(70, i) for i in range(71, 95)]
    check(spark, chain + star + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(5, 5), (1, 2), (2, 1)], 170)


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0


@pytest.mark.parametrize("block", [19, 20, 21, 39, 40, 41])
def test_blocks_about_the_number_of_nodes(spark, monkeypatch, block):
    """N = 20 nodes that are no roots and R = 20 roots, so that rounds cross from several blocks to one."""
    monkeypatch.setattr(components_module, "BLOCK_EDGES", block)
    written = []

    def stored(df, name):
        written.append(name)
        assert len(written) < 30, "rounds don't end"
        return stored_before(df, name)

    stored_before = components_module.stored
    monkeypatch.setattr(components_module, "stored", stored)
    check(spark, [(2 * i, 2 * i + 1) for i in range(20)] * 3, 40)


def test_rounds_that_end_in_one_block(spark, monkeypatch):
    """More raw edges than a block holds, and fewer nodes: each root comes once."""
    monkeypatch.setattr(components_module, "BLOCK_EDGES", 20)
    check(spark, [(x, y) for x in range(10) for y in range(x)], 10)
