import numpy as np
import pyarrow as pa
import pytest

from dayferry.llm import toxicity as tx
from dayferry.llm.slots import Slots

MOST = 2**64 - 1


@pytest.mark.parametrize("edges", [[], [0], [MOST], [0, 1, MOST - 1, MOST], [5 << 60]])
@pytest.mark.parametrize("n", [0, 1, 1000])
def test_slots_against_a_dictionary(n, edges):
    rng = np.random.default_rng(n)
    spread = rng.integers(0, MOST, n, np.uint64, endpoint=True)
    crowded = np.uint64(5 << 60) + np.arange(n // 4, dtype=np.uint64) * np.uint64(2)  # all in one slot
    keys = np.unique(np.concatenate([spread, crowded, np.array(edges, np.uint64)]))
    values = rng.random(len(keys)) + 1
    known = dict(zip(keys.tolist(), values.tolist()))
    near = np.concatenate([keys, keys + np.uint64(1), keys - np.uint64(1), np.array([0, MOST, 5 << 60], np.uint64)])
    found, there = Slots(keys, values)(near)
    assert found.tolist() == [known.get(k, 0.0) for k in near.tolist()]
    assert there.tolist() == [k in known for k in near.tolist()]


def test_a_word_is_worked_out_once_for_all_its_cases_and_marks():
    score, asked = tx.Scorer(np.zeros(0, np.uint64), np.zeros(0)), []
    words = score.words
    score.words = lambda some: asked.extend(some) or words(some)
    score(pa.array([b"The the, (THE) the. -- ... Ab_", "\xc9t\xe9 \xe9t\xe9! the".encode(), None], pa.binary()))
    score(pa.array([b"the?"], pa.binary()))
    assert sorted(asked) == ["", "ab", "the", "été"]


def test_cores_of_many_tokens_are_those_of_each():
    tokens = ["", "a", "_A_", "'tis", "x--", "\0A\x1f", "A\x7f", "--", "É.", "«ab»", "İ", "no’", "٣", "x\x85", "a　b　", "ǅ_"]
    assert tx.cores(pa.array(tokens, pa.string())).to_pylist() == [tx.core(t) for t in tokens]
    assert len(tx.cores(pa.array([], pa.string()))) == 0
