import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from dayfold.operators import scoring
from conftest import rows

# The scorers below travel with their tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def make_scorer():
    def score(texts):
        if any("bad" in t for t in texts):
            raise ValueError("bad text")
        return [("1" if len(t) % 2 else "0", 0.25, 0.75) for t in texts]

    return score


def make_strict():
    def score(texts):
        if any("late" in t for t in texts):
            raise RuntimeError("")
        return [("1", 0.0, 1.0)] * len(texts)

    return score


def make_short():
    return lambda texts: [("1", 0.0, 1.0)] * max(1, len(texts) - 1)


DOCS = [(i, t) for i, t in enumerate(["a", "bb", "bad", " \t", None, "ccc", "late", "d", "eeee"])]


def test_score_retries_rows(frame):
    out = scoring.score(frame(DOCS, "i int, t string"), "t", make_scorer, batch_size=4, spread_by=["i"])
    done = scoring.results(out)
    assert rows(done, "i", "decoded_token", "classification") == [
        (0, "1", 1), (1, "0", 0), (5, "1", 1), (6, "0", 0), (7, "1", 1), (8, "0", 0),
    ]
    assert rows(scoring.failures(out)) == [(2, "bad", "bad text")]


def test_score_uses_the_template(frame):
    out = scoring.score(frame([(1, "aa")], "i int, t string"), "t", make_scorer, template="{content_text}!")
    assert rows(out, "t", "decoded_token") == [("aa", "1")]


def test_wrong_number_of_scores_goes_row_by_row(frame):
    out = scoring.score(frame(DOCS, "i int, t string"), "t", make_short, batch_size=8)
    assert scoring.failures(out).isEmpty() and scoring.results(out).count() == 7


@pytest.mark.parametrize("amount", [100, 1])
def test_resume(spark, frame, folder, amount):
    df, path = frame(DOCS, "i int, t string"), f"{folder}/out"
    run = lambda rows_, scorer: scoring.score_resumable(rows_, "t", scorer, ["i"], path, rows_per_save=amount)
    done, failed = run(df.filter("i < 6"), make_scorer)
    assert rows(done, "i") == [(0,), (1,), (5,)] and rows(failed, "i") == [(2,)]
    done, failed = run(df, make_strict)
    assert rows(done, "i") == [(0,), (1,), (2,), (5,), (7,), (8,)]
    assert rows(failed, "i", "error") == [(6, "RuntimeError")]
    # what the first run saved was not scored again
    assert dict(rows(done, "i", "prob_1"))[0] == 0.75 and dict(rows(done, "i", "prob_1"))[2] == 1.0
    done, failed = run(df, make_scorer)
    assert done.count() == 7 and failed.isEmpty()
    assert done.select("i").distinct().count() == 7


def test_resume_with_nothing_to_do(frame, folder):
    done, failed = scoring.score_resumable(
        frame([], "i int, t string"), "t", make_scorer, ["i"], f"{folder}/out", rows_per_save=2
    )
    assert done.isEmpty() and failed.isEmpty() and "prob_1" in done.columns


def test_all_amounts_are_saved_by_one_job(spark, frame, folder):
    """However many amounts there are to save, the number of Spark jobs is the same."""
    jobs, context = [], spark.sparkContext
    for amount in (50, 1):
        context.setJobGroup(f"save {amount}", "")
        try:
            done, _ = scoring.score_resumable(
                frame([(i, "a") for i in range(40)], "i int, t string"), "t", make_scorer, ["i"], f"{folder}/{amount}",
                rows_per_save=amount)
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)
        jobs.append(len(context.statusTracker().getJobIdsForGroup(f"save {amount}")))
        files = done.select(F.input_file_name()).distinct().count()
        assert done.count() == 40 and (files == 1 if amount == 50 else files > 10)
    assert jobs[0] == jobs[1] > 0


@pytest.mark.parametrize("left", [30, 1])
def test_a_second_run_deals_texts_once_and_copies_none(frame, folder, monkeypatch, capsys, left):
    """What is left goes straight from the input to its tasks, with a shuffle of the texts if it fills them."""
    seen, score, path = [], scoring.score, f"{folder}/out"
    monkeypatch.setattr(scoring, "score", lambda rows_, *a, **b: seen.append(rows_) or score(rows_, *a, **b))
    df = frame([(i, "bad" if i == 39 else "a") for i in range(40)] + [(None, "bb"), (39, "ccc")], "i int, t string")
    run = lambda rows_, make: scoring.score_resumable(rows_, "t", make, ["i"], path, rows_per_save=1)
    run(df.filter(F.col("i") < 40 - left), make_strict)
    done, failed = run(df, make_scorer)
    assert sorted(rows(done, "i", "t"), key=str) == sorted(
        [(i, "a") for i in range(39)] + [(39, "ccc"), (None, "bb")], key=str)
    # key 39 has a result, so its other row is no failure
    assert failed.isEmpty()
    kept = dict(rows(done, "i", "prob_1"))
    assert all(kept[i] == (1.0 if i < 40 - left else 0.75) for i in range(40))
    assert all(f"{folder}/out/" in f for f in seen[1].inputFiles())
    if left == 30:
        capsys.readouterr()
        seen[1].explain()
        plan = capsys.readouterr().out
        assert plan.count("Exchange hashpartitioning") == 2 and "Broadcast" not in plan
        second = done.filter("prob_1 = 0.75")
        assert second.count() == 31 and second.select(F.input_file_name()).distinct().count() > 10


@pytest.mark.parametrize("amount", [100, 1])
def test_only_rows_of_some_keys_are_scored(frame, folder, monkeypatch, capsys, amount):
    seen, score = [], scoring.score
    monkeypatch.setattr(scoring, "score", lambda rows_, *a, **b: seen.append(rows_) or score(rows_, *a, **b))
    df = frame([(i, "a") for i in range(20)] + [(None, "a"), (7, "bb")], "i int, t string")
    only = frame([("x", i) for i in [*range(5, 15), 5, 5, 99, None]], "s string, i int")
    run = lambda **more: scoring.score_resumable(df, "t", make_scorer, ["i"], f"{folder}/out", rows_per_save=amount, **more)
    done, _ = run(only=only)
    assert rows(done, "i", "t") == sorted([(i, "a") for i in range(5, 15)] + [(7, "bb")], key=repr)
    capsys.readouterr()
    seen[0].explain()
    assert ("ShuffledHashJoin" in capsys.readouterr().out) == (amount == 1)
    done, _ = run(only=only)
    assert done.count() == 11
    done, _ = run()
    assert done.count() == 22


def make_stopping():
    """A scorer whose process ends at one text, once other tasks have had their time."""
    import time

    def score(texts):
        if "stop" in texts:
            time.sleep(4)
            raise SystemExit(1)
        return [("1", 0.0, 1.0)] * len(texts)

    return score


def test_a_stopped_run_keeps_what_its_tasks_saved(spark, frame, folder):
    df, path = frame([(i, "stop" if i == 20 else "a") for i in range(40)], "i int, t string"), f"{folder}/out"
    with pytest.raises(Exception, match="(?i)worker|exit"):
        scoring.score_resumable(df, "t", make_stopping, ["i"], path, rows_per_save=1)
    saved, _ = scoring.load_scored(spark, path, df.schema)
    ids = [i for i, in rows(saved, "i")]
    assert len(ids) == len(set(ids)) >= 4 and 20 not in ids
    done, failed = scoring.score_resumable(df, "t", make_scorer, ["i"], path, rows_per_save=1)
    assert sorted(i for i, in rows(done, "i")) == [*range(40)] and failed.isEmpty()
    kept = dict(rows(done, "i", "prob_1"))
    assert {kept[i] for i in ids} == {1.0} and kept[20] != 1.0


def test_template_file(folder):
    with pytest.raises(FileNotFoundError):
        scoring.load_template(f"{folder}/none")
    with open(f"{folder}/t", "w") as f:
        f.write("x {content_text}")
    assert scoring.load_template(f"{folder}/t") == "x {content_text}"


def make_counting():
    import os

    def score(texts):
        with open(os.environ["COUNT_FILE"], "a") as f:
            f.write("x" * len(texts))
        return [("1", 0.0, 1.0)] * len(texts)

    return score


def test_each_text_is_scored_once(frame, folder, monkeypatch):
    """Filters on scores and a template do not make the scorer run again."""
    count = f"{folder}/count"

    def make():
        import os

        os.environ["COUNT_FILE"] = count
        return make_counting()

    out = scoring.score(frame([(i, f"t{i}") for i in range(20)], "i int, t string"), "t", make, batch_size=3)
    assert scoring.results(out).filter("prob_1 > 0.5 and decoded_token = '1'").count() == 20
    assert len(open(count).read()) == 20
