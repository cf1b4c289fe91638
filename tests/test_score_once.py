"""Prompts scored once: a scorer that counts its calls, two runs, one failure in the middle."""

import os
from collections import Counter

import pandas as pd
import pytest

from presslens.operators.score import LexiconScorer, Scorer, answers, raw_scores, score_once


class Counting(Scorer):
    """Notes every prompt it answers in a file of its own; dies at one prompt as long as a mark is there."""

    def __init__(self, folder, dies_at=None):
        self.folder, self.dies_at = folder, dies_at

    def raw(self, texts: pd.Series) -> pd.Series:
        for t in texts:
            if t == self.dies_at and not os.path.exists(os.path.join(self.folder, "mended")):
                raise KeyboardInterrupt("the worker is gone")  # not an error of the row: the task ends
            if t == "never":
                raise ValueError("no answer")
            with open(os.path.join(self.folder, "calls"), "a") as f:
                f.write(repr(t) + "\n")
        return texts.map(lambda t: f"answer to {t}")


def _calls(folder):
    path = os.path.join(folder, "calls")
    return Counter(open(path).read().splitlines()) if os.path.exists(path) else Counter()


def test_one_call_a_prompt_over_two_runs_and_a_failure(spark, scratch):
    # a third of the rows have one prompt
    rows = [(i, "hot" if i % 3 == 0 else f"p{i % 40}") for i in range(300)] + [(900, None), (901, "")]
    df = spark.createDataFrame(rows, "id long, prompt string").repartition(5)
    ledger, scorer = f"{scratch}/ledger", Counting(scratch, "p13")
    with pytest.raises(Exception):
        score_once(df, scorer, ledger, partitions=24, backoff=0).collect()
    kept = [r["raw"].removeprefix("answer to ") for r in answers(spark, ledger, "model").collect()]
    assert _calls(scratch)["'p13'"] == 0 and kept  # what other tasks finished is there
    open(os.path.join(scratch, "mended"), "w").close()
    for _ in range(2):
        got = {(r["id"], r["model_raw"]) for r in score_once(df, scorer, ledger, partitions=24, backoff=0).collect()}
        assert got == {(i, f"answer to {p}") for i, p in rows}
    prompts = {repr(p) for _, p in rows}
    calls = _calls(scratch)
    assert set(calls) == prompts
    # kept answers are never called for again; only tasks that ran when the job was aborted may have been
    assert all(calls[repr(None if p == "None" else p)] == 1 for p in kept)
    assert max(calls.values()) <= 2 and sum(calls.values()) - len(prompts) <= len(prompts) - len(kept)


def test_failed_prompts_are_tried_again_and_models_apart(spark, scratch):
    df = spark.createDataFrame([(1, "a"), (2, "never"), (3, "a")], "id long, prompt string")
    ledger = f"{scratch}/ledger"
    for run in range(2):
        got = {r["id"]: r["m_raw"] for r in score_once(df, Counting(scratch), ledger, model="m", max_retries=1, backoff=0).collect()}
        assert got[1] == got[3] == "answer to a" and "no answer" in got[2]
        assert answers(spark, ledger, "m").count() == 1
    assert _calls(scratch) == {"'a'": 1}
    score_once(df, Counting(scratch), ledger, model="other", max_retries=1, backoff=0).collect()
    assert _calls(scratch) == {"'a'": 2}
    assert score_once(df.filter("false"), Counting(scratch), f"{scratch}/none").count() == 0


def test_a_scorer_states_its_call_size(spark):
    sizes = []

    class Sized(LexiconScorer):
        call_rows = 3

        def raw(self, texts):
            return super().raw(texts).map(lambda x: f"{len(texts)}")

    df = spark.createDataFrame([(i, f"t{i}") for i in range(7)], "id int, prompt string").coalesce(1)
    sizes = [r["m_raw"] for r in raw_scores(df, {"m": Sized([], [])}, "prompt").orderBy("id").collect()]
    assert sizes == ["3"] * 6 + ["1"]
    assert {r["m_raw"] for r in raw_scores(df, {"m": Sized([], [])}, "prompt", call_rows=7).collect()} == {"7"}
