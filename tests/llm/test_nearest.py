"""Collision counting of many queries together against counting by hand, and what it costs."""

from __future__ import annotations

import time

import numpy as np

from vitalgrid.llm.nearest import CERTAINTY, GROWTH, START, THRESHOLD, Block

K = 20
rng = np.random.default_rng(11)


def unit(n: int, dim: int = 64) -> np.ndarray:
    v = rng.standard_normal((n, dim))
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def one_by_one(block: Block, query_id: int, query: np.ndarray) -> tuple[list[int], np.ndarray]:
    """One query: what lies in each window is listed, the lists are counted."""
    at, n = query @ block.lines[:-1], len(block.ids)
    order = np.argsort(block.vectors @ block.lines[:-1] + np.outer(block.gap, block.lines[-1]), axis=0, kind="stable").T
    radius, score = START * block.largest, block.vectors @ query
    while True:
        low = [np.searchsorted(s, x - radius) for s, x in zip(block.sorted, at)]
        high = [np.searchsorted(s, x + radius, side="right") for s, x in zip(block.sorted, at)]
        listed = np.concatenate([o[a:b] for o, a, b in zip(order, low, high)])
        whole = all(a == 0 for a in low) and all(b == n for b in high)
        hit = np.flatnonzero(whole | (np.bincount(listed, minlength=n) >= np.ceil(THRESHOLD * len(at))))
        hit = hit[block.ids[hit] != query_id]
        best = hit[np.lexsort((block.ids[hit], -score[hit].round(9)))[:K]]
        reach = np.inf if len(best) < K else max(query @ query + block.largest**2 - 2 * score[best[-1]], 0) ** 0.5
        if whole or reach * CERTAINTY <= radius:
            return block.ids[best].tolist(), score[best]
        radius *= GROWTH


def block_of(vectors: np.ndarray) -> Block:
    ids = rng.permutation(len(vectors)).astype(np.int64)
    largest = float(np.linalg.norm(vectors, axis=1).max())
    block = Block(ids, vectors, largest)
    block.gap = np.sqrt(np.maximum(largest**2 - (block.vectors**2).sum(axis=1), 0))
    return block


def test_queries_together_find_what_each_finds_alone():
    for vectors in (unit(3000), unit(700) * rng.uniform(0.1, 5, (700, 1)), unit(12), np.repeat(unit(30), 40, axis=0)):
        block = block_of(vectors)
        asked = np.arange(0, len(vectors), max(1, len(vectors) // 50))
        got = block.search(block.ids[asked], block.vectors[asked], K)
        for at, (best, score) in zip(asked, got, strict=True):
            ids, exact = one_by_one(block, block.ids[at], block.vectors[at])
            assert block.ids[best].tolist() == ids
            assert np.allclose(score, exact, rtol=0, atol=1e-9)


def test_a_query_costs_less_than_listing_its_windows():
    block = block_of(unit(8192))
    listed = [rng.integers(0, 8192, 6000) for _ in block.sorted]

    def seconds(work) -> float:
        began = time.process_time()
        work()
        return time.process_time() - began

    searched = min(seconds(lambda: block.search(block.ids[:128], block.vectors[:128], K)) for _ in range(3))
    # Four rounds fill 60 % of every line, and each listed place was counted and gathered once.
    counted = min(seconds(lambda: [np.bincount(np.concatenate(listed), minlength=8192) for _ in range(128)]) for _ in range(3))
    assert searched < 4 * counted
