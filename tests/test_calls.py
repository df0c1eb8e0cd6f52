"""Concurrent model calls: how many at a time, how fast, and what becomes of failures."""

from __future__ import annotations

import threading
import time

import pytest
from pyspark.sql import functions as F

from lawloom import operators as op
from lawloom import plans, sinks
from lawloom.operators.calls import Calls, ask, ask_all


class Counter:
    """Counts the calls that run at a time, and the most there ever were."""

    def __init__(self):
        self.lock, self.running, self.most = threading.Lock(), 0, 0

    def __call__(self, messages):
        with self.lock:
            self.running += 1
            self.most = max(self.most, self.running)
        time.sleep(0.01)
        with self.lock:
            self.running -= 1
        return messages


@pytest.mark.parametrize("threads", [1, 2, 7])
def test_so_many_threads_and_no_more(threads):
    model = Counter()
    answers = list(ask_all(model, ((i, [str(i)]) for i in range(60)), Calls(threads)))
    assert sorted(answers) == sorted((i, f'["{i}"]', None) for i in range(60))
    assert model.most == threads


def test_requests_are_taken_only_when_needed():
    taken = []

    def requests():
        for i in range(1000):
            taken.append(i)
            yield i, []

    answers = ask_all(lambda messages: "x", requests(), Calls(threads=4))
    for _ in range(10):
        next(answers)
    assert len(taken) <= 10 + 2 * 4
    answers.close()


def test_a_slow_call_holds_up_no_other():
    def model(messages):
        time.sleep(0.6 if messages == ["0"] else 0.005)
        return "x"

    started = time.perf_counter()
    answers = list(ask_all(model, ((i, [str(i)]) for i in range(100)), Calls(threads=4)))
    assert len(answers) == 100 and answers[-1][0] == 0
    assert time.perf_counter() - started < 1.2


def test_tries_and_waits():
    failures = {"n": 0}

    def model(messages):
        failures["n"] += 1
        if failures["n"] < 3:
            raise OSError("busy")
        return "ok"

    assert ask(model, [], Calls(tries=3, wait=0.001)) == ("ok", None)
    failures["n"] = 0
    assert ask(model, [], Calls(tries=2, wait=0.001)) == (None, "OSError: busy")
    pauses = [Calls(wait=1, longest_wait=5).pause(k) for k in (1, 2, 3, 4, 9)]
    assert all(top / 2 <= p <= top for p, top in zip(pauses, (1, 2, 4, 5, 5)))
    for bad in ({"threads": 0}, {"tries": 0}, {"wait": -1}):
        with pytest.raises(ValueError):
            Calls(**bad)


def requests(spark, n, slots=4):
    texts = spark.range(0, n, 1, slots).select("id", F.col("id").cast("string").alias("text"))
    return op.build_requests(texts, "x", user_prefix="")


def test_calls_overlap(spark):
    """100 calls of 50 ms, 5 s one after the other, on 4 slots with 8 threads each."""

    def model(messages):
        time.sleep(0.05)
        return messages[-1]["content"]

    calls = Calls(threads=8)
    op.run_model(requests(spark, 8), model, calls=calls).collect()  # starts the workers
    started = time.perf_counter()
    got = op.run_model(requests(spark, 100), model, calls=calls).collect()
    taken = time.perf_counter() - started
    assert sorted(tuple(r) for r in got) == [(i, str(i), None) for i in range(100)]
    assert taken < 2.5


@pytest.mark.parametrize(("cap", "threads", "tasks"), [(8, 4, 2), (3, 8, 1), (7, 2, 3), (1, 1, 1)])
def test_the_cap_holds_for_tasks_times_threads(spark, cap, threads, tasks):
    out = op.run_model(requests(spark, 10), lambda messages: "x", cap, Calls(threads=threads))
    assert Calls(min(cap, threads)).tasks(cap) == tasks
    assert out.rdd.getNumPartitions() == tasks and out.count() == 10


def test_failures_are_rows_with_threads_too(spark):
    def model(messages):
        if int(messages[-1]["content"]) % 3 == 0:
            raise ValueError("no")
        return None

    got = {r.id: (r.response, r.error) for r in op.run_model(requests(spark, 9), model, calls=Calls(threads=3, tries=2, wait=0)).collect()}
    assert got == {i: (None, "ValueError: no") if i % 3 == 0 else ("null", None) for i in range(9)}
    assert op.run_model(requests(spark, 0), model, calls=Calls(threads=3)).count() == 0


def test_analyse_leaves_no_responses_behind(spark, tmp_path):
    before = set(_entries(spark))
    bills = spark.sql(
        "SELECT 1 id, 'PL' descricaoTipo, '2025-03-01' dataApresentacao, 'u' urlInteiroTeor, 'lei nova' textoInteiroTeorLimpo,"
        " array(named_struct('idDeputadoAutor', 7L, 'nomeAutor', 'A', 'siglaPartidoAutor', 'P', 'siglaUFAutor', 'SP')) autores"
    )
    merged = plans.analyse(
        bills, str(tmp_path / "db"), lambda m: "{}", lambda m: "{}", summary_calls=Calls(threads=3), topic_calls=Calls(threads=10), buckets=2
    )
    assert merged["authors"] == 1 and merged["proposition_summary"] == 0
    assert set(_entries(spark)) == before


def _entries(spark):
    from pathlib import Path

    folder = Path(sinks.shared_dir(spark))
    return [p.name for p in folder.iterdir()] if folder.exists() else []
