from growthlab.llm import preferences


def render(role, text):
    return f"<|im_start|>{role}\n{text}<|im_end|>\n"


def test_prefix_prompt_and_masks(spark):
    turns = [
        (1, 0, "system", "s"), (1, 1, "user", "hi"), (1, 2, "assistant", "good é"), (1, 3, "user", "thx"), (1, 4, "assistant", "np"),
        (2, 0, "system", "s"), (2, 1, "user", "hi"), (2, 2, "assistant", "bad"),
        (3, 0, "user", "same"), (3, 1, "assistant", "a"), (4, 0, "user", "same"), (4, 1, "assistant", "a"),
        (5, None, None, None), (5, 0, "assistant", "x"), (6, 0, "assistant", "x"),
        (7, 0, "user", "rep"), (7, 0, "user", "rep"), (8, 0, "user", "rep"),
        (None, 0, "user", "nobody"),
    ]
    turns = spark.createDataFrame([(*t, "q") for t in turns], "conv_id long, turn long, role string, text string, prompt string")
    pairs = [(1, 1, 2), (2, 3, 4), (3, 5, 6), (4, 7, 8), (5, 1, None), (6, None, None), (7, 99, 2), (1, 1, 2)]
    pairs = spark.createDataFrame(pairs, "pair_id long, chosen_id long, rejected_id long")
    out = {r.pair_id: r for r in preferences.preference_records(turns, pairs).collect()}
    assert sorted(out) == [1, 2, 3, 4, 5, 6, 7]
    one = out[1]
    assert one.prompt == render("system", "s") + render("user", "hi") and one.prompt_turns == 2
    assert one.chosen == render("assistant", "good é") + render("user", "thx") + render("assistant", "np")
    assert [one.chosen[a:b] for a, b in one.chosen_train] == ["good é<|im_end|>", "np<|im_end|>"]
    assert [one.rejected[a:b] for a, b in one.rejected_train] == ["bad<|im_end|>"]
    assert out[2].prompt_turns == 2 and out[2].chosen == out[2].rejected == "" and out[2].chosen_train == []
    assert out[3].prompt == "" and out[3].chosen.startswith(render("unknown", "")) and out[3].rejected == render("assistant", "x")
    assert out[4].prompt == "" and out[4].chosen == render("user", "rep") * 2 and out[4].rejected == render("user", "rep")
    assert out[5].rejected == "" and out[5].prompt == "" and out[6].prompt == out[6].chosen == ""
    assert out[7].chosen == "" and out[7].rejected.count("<|im_start|>") == 3
    assert preferences.preference_records(turns.limit(0), pairs).where("chosen <> ''").count() == 0
    assert preferences.preference_records(turns, pairs.limit(0)).count() == 0
