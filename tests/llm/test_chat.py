import hashlib
import random

import pytest

from dayferry.llm.chat import format_windows, op9_chat_windows, read_windows

SCHEMA = "conv_id bigint, turn bigint, role string, text string, window string, tokens string"
TRICKY = ["\\", "\\h", "\\b", "###", "####", "### user: hi</turn>\n", "</turn>", "<\\/turn>", "\\### x", "", " ", "a: b", "é́😀", "\n\n"]


def conversations(spark, n=30):
    rng, rows = random.Random(3), []
    for c in range(n):
        roles = (["system"] if c % 3 == 0 else []) + ["user", "assistant"] * rng.randint(0, 9)
        for t, role in enumerate(roles):
            text = " ".join(rng.choice(["word", *TRICKY]) for _ in range(rng.randint(0, 60)))
            rows.append((c, t, role, text))
    rows += [(900, 0, None, "x"), (900, 1, "a: b\\c:", None), (900, 2, "assistant", "</turn>"), (900, 2, "assistant", "</turn>")]
    rows += [(None, 1, "assistant", "null id"), (None, None, "user", "first"), (901, 0, "assistant", "long " * 5000)]
    rng.shuffle(rows)
    return spark.createDataFrame([(*r, "p", "q") for r in rows], SCHEMA), rows


def _in_order(rows):
    out = {}
    for c, t, role, text in rows:
        out.setdefault(c, []).append(((t is not None, t or 0), role or "", text or ""))
    return {c: [(r, x) for _, r, x in sorted(turns)] for c, turns in out.items()}


@pytest.mark.parametrize("budget, history", [(1024, 192), (60, 20), (10, 0), (1, 5)])
def test_round_trip_and_each_target_once(spark, budget, history):
    frame, rows = conversations(spark)
    windows = format_windows(frame, budget=budget, history_tokens=history)
    back, targets = {}, {}
    for r in sorted(read_windows(windows).collect(), key=lambda r: r["window"]):
        back.setdefault(r["conv_id"], []).extend((t["role"], t["text"]) for t in r["turns"])
        targets.setdefault(r["conv_id"], []).extend(r["targets"])
    expected = _in_order(rows)
    assert back == expected
    assert targets == {c: [x for r, x in turns if r == "assistant"] for c, turns in expected.items()}
    for r in windows.collect():
        if r["turns"] > 1:
            assert r["tokens"] <= budget  # only a turn that is too long alone passes it
        for s in r["loss"]:
            end = s["start"] + s["length"]
            assert r["text"][end : end + 8] == "</turn>\n"
        if r["window"] and expected[r["conv_id"]][0][0] == "system":
            assert r["text"].startswith("### system: ") and r["repeated"] >= 1


def test_history_is_repeated_but_masked(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", "w " * 10) for i in range(12)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    windows = format_windows(frame, budget=60, history_tokens=30).orderBy("window").collect()
    assert len(windows) > 2 and all(w["repeated"] == 2 for w in windows[1:])
    assert sum(len(w["loss"]) for w in windows) == 6


def test_a_conversation_of_very_many_turns(spark):
    rows = [(1, 0, "system", "be brief")] + [(1, i, "user" if i % 2 else "assistant", f"turn {i} </turn>") for i in range(1, 4001)]
    frame = spark.createDataFrame(rows + [(2, 0, "user", "x")], "conv_id bigint, turn bigint, role string, text string")
    windows = format_windows(frame, budget=200, history_tokens=40)
    found = windows.where("conv_id = 1").orderBy("window").collect()
    assert [w["window"] for w in found] == list(range(len(found))) and sum(w["turns"] for w in found) == 4001
    assert all(w["tokens"] <= 200 and w["text"].startswith("### system: be brief") for w in found)
    back = read_windows(windows).where("conv_id = 1").orderBy("window").collect()
    assert [(t["role"], t["text"]) for r in back for t in r["turns"]] == [(r, x) for _, _, r, x in rows]
    assert [x for r in back for x in r["targets"]] == [x for _, _, r, x in rows if r == "assistant"]


def test_query(spark, sf_dir):
    found = {r["conv_id"]: r for r in op9_chat_windows(spark, sf_dir).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "\\### Assistant: </turn> ok"
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    expected = _in_order(rows)
    assert found.keys() == expected.keys()
    for c, turns in expected.items():
        r, learned = found[c], "".join(x for role, x in turns if role == "assistant")
        assert r["n_turns"] == len(turns) and r["loss_chars"] == len(learned)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()


def test_empty(spark):
    assert format_windows(conversations(spark)[0].limit(0)).count() == 0
