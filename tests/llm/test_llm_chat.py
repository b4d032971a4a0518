"""Preference rendering against plain Python."""

import random
from collections import defaultdict

import pytest

from claimsdq.llm.chat import conversations, format_preferences, pairs_by_last_answer

COLUMNS = "conv_id long, turn int, role string, text string, prompt string, chosen string, at string"


def make(seed, n=30):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(r.randint(1, 6)):
            rows.append((c, t, r.choice(["user", "assistant", "assistant", "system", None]),
                         r.choice(["same", "héllo\nthere", "", None, "x" * 50, str(r.random())])))
    rows += [(None, 0, "user", "no id"), (None, 0, "user", "no id"), (None, 1, "assistant", "nor this"), (-1, 0, "assistant", "m"),
             (-2, 0, "assistant", "n"), (n + 5, 0, "assistant", "alone"), (n + 7, None, "user", "no turn"),
             (n + 7, 1, "user", "tie b"), (n + 7, 1, "user", "tie a")]
    r.shuffle(rows)
    return [(*row, "clash", "clash", "clash") for row in rows]


def turn(role, text):
    return f"<|im_start|>{role}\n{text}<|im_end|>\n"


def side(turns):
    out, spans = "", []
    for role, text in turns:
        start = len(out) + len(f"<|im_start|>{role}\n")
        out += turn(role, text)
        if role == "assistant":
            spans.append((start, len(out)))
    return out, spans


def plain(rows):
    conv = defaultdict(list)
    for n, (c, t, role, text, *_) in enumerate(rows):
        conv[("alone", n) if c is None else c].append((t is not None, t or 0, role or "unknown", text or ""))
    conv = {c: [x[2:] for x in sorted(v)] for c, v in conv.items()}
    last = {c: max((i for i, x in enumerate(v) if x[0] == "assistant"), default=None) for c, v in conv.items()}
    out = {}
    for c, v in conv.items():
        mate = None if isinstance(c, tuple) else c ^ 1
        if last[c] is None:
            other = list(v)
        elif mate in conv and last[mate] is not None:
            other = v[:last[c]] + [("assistant", conv[mate][last[mate]][1])]
        else:
            other = v[:last[c]]
        n = 0
        while n < min(len(v), len(other)) and v[n] == other[n]:
            n += 1
        (a, a_loss), (b, b_loss) = side(v[n:]), side(other[n:])
        out[c] = (n, side(v[:n])[0], a, b, a_loss, b_loss, bool(a_loss and b_loss))
    return sorted(((None if isinstance(c, tuple) else c, *x) for c, x in out.items()), key=str)


def as_rows(df):
    return {r.pair_id: (r.prompt_turns, r.prompt, r.chosen, r.rejected, [tuple(s) for s in r.chosen_loss],
                        [tuple(s) for s in r.rejected_loss], r.usable) for r in df.collect()}


def test_matches_plain_rendering(spark):
    for seed in (1, 2):
        rows = make(seed)
        turns = spark.createDataFrame(rows, COLUMNS).repartition(3)
        got = format_preferences(pairs_by_last_answer(turns))
        got = [(r.pair_id, r.prompt_turns, r.prompt, r.chosen, r.rejected, [tuple(s) for s in r.chosen_loss],
                [tuple(s) for s in r.rejected_loss], r.usable) for r in got.collect()]
        assert sorted(got, key=str) == plain(rows)


def test_prompt_is_rendered_once_and_both_sides_rebuild(spark):
    turns = spark.createDataFrame(make(3), COLUMNS)
    pairs = pairs_by_last_answer(turns)
    pairs = pairs.filter("pair_id IS NOT NULL")
    full = {r.pair_id: "".join(turn(t.role, t.text) for t in r.chosen) for r in pairs.collect()}
    for r in format_preferences(pairs).collect():
        assert r.prompt + r.chosen == full[r.pair_id]


def test_given_pairs_with_empty_and_missing_sides(spark):
    t = "array<struct<turn:bigint,role:string,text:string>>"
    rows = [("p", [(0, "user", "q"), (1, "assistant", "good")], [(0, "user", "q"), (1, "assistant", "bad")]),
            ("same", [(0, "user", "q")], [(0, "user", "q")]), ("none", None, None), ("half", [(0, "assistant", "a")], None)]
    got = as_rows(format_preferences(spark.createDataFrame(rows, f"pair_id string, chosen {t}, rejected {t}")))
    assert got["p"] == (1, turn("user", "q"), turn("assistant", "good"), turn("assistant", "bad"), [(22, 37)], [(22, 36)], True)
    assert got["same"] == (1, turn("user", "q"), "", "", [], [], False)
    assert got["none"] == (0, "", "", "", [], [], False)
    assert got["half"][3:] == ("", [(22, 34)], [], False)


def test_empty_table_and_no_python(spark):
    turns = spark.createDataFrame([], COLUMNS)
    out = format_preferences(pairs_by_last_answer(turns))
    assert out.count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_keys_of_other_types(spark):
    rows = [("a", 0, "user", "q"), ("a", 1, "assistant", "x"), (None, 0, "user", "q")]
    turns = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    with pytest.raises(TypeError, match="whole-number"):
        pairs_by_last_answer(turns)
    assert sorted((str(r.conv_id), len(r.turns)) for r in conversations(turns).collect()) == [("None", 1), ("a", 2)]
    small = spark.createDataFrame([(5, 0, "assistant", "x"), (4, 0, "assistant", "y")], "conv_id int, turn int, role string, text string")
    got = pairs_by_last_answer(small)
    assert dict(got.dtypes)["pair_id"] == "int" and {r.pair_id: r.rejected[0].text for r in got.collect()} == {5: "y", 4: "x"}


def test_turns_are_scanned_once_and_null_keys_share_no_group(spark, tmp_path):
    spark.createDataFrame(make(4) + [(None, 0, "user", "x", *["clash"] * 3)] * 50, COLUMNS).write.parquet(f"{tmp_path}/t")
    out = pairs_by_last_answer(spark.read.parquet(f"{tmp_path}/t"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 2       # keyed rows and the others, by a pushed filter each
    assert out.filter("pair_id IS NULL").count() == 53 and "Join" not in plan
