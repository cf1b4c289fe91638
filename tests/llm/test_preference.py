from collections import defaultdict

from presslens.llm.preference import format_preferences

SCHEMA = "pair_id long, side string, turn long, role string, text string, part string, step long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", 1) for r in rows], SCHEMA)


def chat(pair, side, *turns):
    return [(pair, side, i, role, text) for i, (role, text) in enumerate(turns)]


def parts(df):
    out = defaultdict(str)
    learned = defaultdict(str)
    for r in sorted(df.collect(), key=lambda r: (r["turn"] is None, r["turn"] or 0)):
        out[r["pair_id"], r["part"]] += r["rendered"]
        learned[r["pair_id"], r["part"]] += r["rendered"][r["learn_from"]:r["learn_to"]]
    return dict(out), dict(learned)


def turn(role, text):
    return f"<|im_start|>{role}\n{text}<|im_end|>\n"


def test_prefix_is_rendered_once_and_completions_are_masked(spark):
    a, b, c = ("system", "s"), ("user", "q"), ("assistant", "same")
    out, learned = parts(format_preferences(frame(spark, [
        *chat(1, "chosen", a, b, c, ("user", "x"), ("assistant", "good"), ("user", "thanks")),
        *chat(1, "rejected", a, b, c, ("user", "x"), ("assistant", "bad")),
        *chat(2, "chosen", b, ("assistant", "1")), *chat(2, "rejected", ("user", "other"), ("assistant", "1")),
        *chat(3, "chosen", b, c), *chat(3, "rejected", b, c),
        *chat(4, "chosen", b, c), *chat(4, "rejected", b, c, ("user", "more"), ("assistant", "late")),
    ])))
    assert out == {
        (1, "prompt"): turn(*a) + turn(*b) + turn(*c) + turn("user", "x"),
        (1, "chosen"): turn("assistant", "good") + turn("user", "thanks"), (1, "rejected"): turn("assistant", "bad"),
        (2, "chosen"): turn(*b) + turn("assistant", "1"), (2, "rejected"): turn("user", "other") + turn("assistant", "1"),
        (3, "prompt"): turn(*b) + turn(*c), (4, "prompt"): turn(*b) + turn(*c),
        (4, "rejected"): turn("user", "more") + turn("assistant", "late")}
    assert {k: v for k, v in learned.items() if v} == {
        (1, "chosen"): "good<|im_end|>", (1, "rejected"): "bad<|im_end|>", (2, "chosen"): "1<|im_end|>",
        (2, "rejected"): "1<|im_end|>", (4, "rejected"): "late<|im_end|>"}


def test_agreement_after_a_difference_is_no_prefix(spark):
    out, _ = parts(format_preferences(frame(spark, [
        *chat(1, "chosen", ("user", "a"), ("assistant", "x"), ("user", "b")),
        *chat(1, "rejected", ("user", "a"), ("assistant", "y"), ("user", "b"))])))
    assert out[1, "prompt"] == turn("user", "a")
    assert out[1, "chosen"].endswith(turn("user", "b")) and out[1, "rejected"].endswith(turn("user", "b"))


def test_awkward_turns(spark):
    df = format_preferences(frame(spark, [
        (1, "chosen", 0, None, None), (1, "rejected", 0, None, ""),  # null is not empty
        (2, "chosen", None, "user", "u"), (2, "rejected", None, "user", "u"),  # no number, no prefix
        (3, "chosen", 5, "user", "u"), (3, "chosen", 5, "user", "u"), (3, "rejected", 5, "user", "u"),  # repeated
        (4, "chosen", 0, "assistant", "only"), (None, "chosen", 0, "user", "n"), (None, "rejected", 0, "user", "n"),
        (5, "chosen", 0, "user", "w " * 200_000), (5, "rejected", 0, "user", "w " * 200_000)]))
    got = sorted((r["pair_id"] or 0, r["part"], len(r["rendered"]), r["learn_to"]) for r in df.collect())
    blank, u = len(turn("", "")), len(turn("user", "u"))
    assert got == sorted([(1, "chosen", blank, 0), (1, "rejected", blank, 0), (2, "chosen", u, 0), (2, "rejected", u, 0),
                          (3, "prompt", u, 0), (3, "prompt", u, 0), (4, "chosen", len(turn("assistant", "only")), len(turn("assistant", "only")) - 1),
                          (0, "prompt", u, 0), (5, "prompt", len(turn("user", "w " * 200_000)), 0)])
    assert format_preferences(frame(spark, [])).count() == 0


def test_main_path_is_native(spark):
    plan = format_preferences(frame(spark, chat(1, "chosen", ("user", "a"))))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
