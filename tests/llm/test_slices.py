import numpy as np
import pyarrow as pa

from dayferry.llm import ctw
from dayferry.llm.tokens import in_slices


def test_slices_are_bounded_by_rows_and_bytes_and_whole():
    texts = [b"x" * n for n in (0, 10, 500, 30, 2000, 1, 1, 1, 0)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.binary())], names=["id", "text"])
    for rows, size in ((1, 10**6), (3, 10**6), (100, 40), (100, 600), (100, 10**6)):
        parts = list(in_slices([batch, batch.slice(0, 0), batch.slice(3)], rows, size))
        assert pa.Table.from_batches(parts).to_pydict() == pa.Table.from_batches([batch, batch.slice(3)]).to_pydict()
        for part in parts:
            held = sum(len(t or b"") for t in part.column(1).to_pylist())
            assert part.num_rows == 1 or (part.num_rows <= rows and held <= size)


def test_strings_of_long_texts_come_in_parts():
    texts = pa.array(["", "abc " * 50, "é", "q" * 7, "  a   b ", "x" * 300])
    whole = [x for x in ctw._strings_of(texts, 5)]
    assert len(whole) == 1
    for most in (1, 3, 4, 5, 6, 17, 100):
        parts = list(ctw._strings_of(texts, 5, most))
        assert np.concatenate([f for f, _, _ in parts]).tolist() == whole[0][0].tolist()
        owners = np.concatenate([np.repeat(t, np.diff(np.append(s, len(f)))) for f, t, s in parts])
        assert owners.tolist() == np.repeat(whole[0][1], np.diff(np.append(whole[0][2], len(whole[0][0])))).tolist()
        assert max(len(f) for f, _, _ in parts) <= max(most, 1)


def test_a_worker_forgets_what_other_operators_remember():
    from dayferry.llm import workers

    gone = []
    workers.takes_over("one", lambda: gone.append("one"))
    workers.takes_over("one", lambda: gone.append("one"))
    assert gone == []
    workers.takes_over("two", lambda: gone.append("two"))
    workers.takes_over("two", lambda: gone.append("two"))
    assert gone == ["one"]
    workers.takes_over("one", lambda: None)
    assert gone == ["one", "two"]
