from collections import Counter

import numpy as np

from dayferry.llm import ctw


def test_counts_are_sorted_parts():
    rng = np.random.default_rng(3)
    parts = [rng.integers(0, 50, n).astype(np.uint64) for n in (200, 1, 90)]
    counted = [ctw._counted(p) for p in parts]
    for values, (keys, n) in zip([*parts, np.concatenate(parts)], [*counted, ctw._merged(counted)]):
        assert keys.tolist() == sorted(set(values.tolist()))
        assert dict(zip(keys.tolist(), n.tolist())) == Counter(values.tolist())
    assert [len(x) for x in ctw._counted(parts[0][:0])] == [0, 0]
