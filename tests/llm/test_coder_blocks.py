from __future__ import annotations

import numpy as np
import pytest

from agrilake.llm import token_coder
from agrilake.llm.token_coder import _Models, decode_block, encode_block


def test_models_learn_after_many_steps_not_after_each(monkeypatch):
    calls, learn = [], _Models.learn
    monkeypatch.setattr(_Models, "learn", lambda self, *a: (calls.append(len(a[0])), learn(self, *a))[1])
    ids = np.random.default_rng(2).integers(0, 3000, 1 << 18).astype("<u4")
    block = encode_block([ids], 3000)
    assert sum(calls) == len(ids) and len(calls) < 30  # 256 steps
    written, calls[:] = list(calls), []
    assert np.array_equal(decode_block(block)[0], ids)
    assert calls == written


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 511, 513, 70_001, 4096 * 256 - 1, 4096 * 256 + 4095])
@pytest.mark.parametrize("vocabulary", [1, 2, 40, 1 << 18])
def test_blocks_of_any_size_and_vocabulary(n, vocabulary):
    draw = np.random.default_rng(n)
    ids = (draw.random(n) ** 8 * vocabulary).astype("<u4")
    back = decode_block(encode_block([ids[: n // 3], ids[:0], ids[n // 3 :]], vocabulary))
    assert [len(d) for d in back] == [n // 3, 0, n - n // 3]
    assert np.array_equal(np.concatenate(back), ids)


def test_one_sure_id_costs_almost_nothing():
    block = encode_block([np.zeros(1 << 20, "<u4")], 1)
    assert len(block) < 100_000


def test_find_inverts_interval_at_both_ends():
    draw = np.random.default_rng(3)
    models = _Models(60, 4000, reads=True)
    for _ in range(12):
        models.mix(4000)
        ids = np.where(draw.random(4000) < 0.5, models.g1, draw.integers(0, 60, 4000) % draw.integers(1, 61, 4000))
        low, size = models.interval(ids)
        assert (size > 0).all() and (low + size <= 1 << token_coder.SHARES + token_coder.COUNTS).all()
        for at in (low, low + size - 1, low + size // 2):
            assert np.array_equal(models.find(at), ids)
        models.learn(ids, models.p1, models.slot, models.e1, models.e2)
        models.last2[:], models.last1[:] = models.last1, ids
