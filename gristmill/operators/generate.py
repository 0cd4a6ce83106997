"""Generation stages: a client is called in tasks, rows stay rows, and a failure is a value in a column.

A client is a picklable factory of an object with generate(prompts) -> texts. Ids of what it makes come from task and rollout,
so a retried task writes the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.text import stable_id
from gristmill.session import ready_for_python


class Client(Protocol):
    def generate(self, prompts: list[str]) -> list[str | Exception]: ...


class Scripted:
    """A client for tests: answers by the first of its keys that a prompt contains, or fails where the answer is an error."""

    def __init__(self, answers: dict[str, str | Exception], otherwise: str = ""):
        self.answers, self.otherwise = answers, otherwise

    def generate(self, prompts: list[str]) -> list[str | Exception]:
        return [next((a for k, a in self.answers.items() if k in p), self.otherwise) for p in prompts]


def rollout_rows(tasks: DataFrame, n: int, id_col: str = "id") -> DataFrame:
    """Each task n times: rollout_index and a stable rollout_id."""
    rows = tasks.withColumn("rollout_index", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return rows.withColumn("rollout_id", stable_id(F.col(id_col).cast("string"), F.col("rollout_index").cast("string")))


def generated(rows: DataFrame, client: Callable[[], Client], prompt: Column, name: str = "output", at_once: int = 32) -> DataFrame:
    """rows with the client's text and an error column; a failed prompt has a null text, others in its batch go on."""
    ready_for_python(rows.sparkSession)
    asked = rows.withColumn("__prompt", prompt)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = client()
        for pdf in batches:
            texts: list[str | None] = []
            errors: list[str | None] = []
            prompts = pdf.pop("__prompt").fillna("").tolist()
            for at in range(0, len(prompts), at_once):
                for got in c.generate(prompts[at : at + at_once]):
                    bad = isinstance(got, Exception)
                    texts.append(None if bad else got)
                    errors.append(f"{type(got).__name__}: {got}" if bad else None)
            pdf[name], pdf[f"{name}_error"] = pd.Series(texts, index=pdf.index, dtype=object), pd.Series(errors, index=pdf.index, dtype=object)
            yield pdf

    return asked.mapInPandas(run, rows.schema.add(name, "string").add(f"{name}_error", "string"))


def rounds(state: DataFrame, client: Callable[[], Client], prompt: Callable[[int], Column], step: Callable[[DataFrame, int], DataFrame], most: int) -> DataFrame:
    """A bounded loop: rows that aren't done get an answer, step turns it into the next state (with done); at most so many rounds."""
    for k in range(most):
        open_rows = state.filter(~F.col("done"))
        state = state.filter("done").unionByName(step(generated(open_rows, client, prompt(k)), k).select(*state.columns))
    return state


def judged(rows: DataFrame, clients: dict[str, Callable[[], Client]], prompt: Column) -> DataFrame:
    """rows with scores (array) of a panel of judges and their mean; a judge that fails or gives no number counts as null."""
    from gristmill.functions.parse import judge_score
    from gristmill.functions.verify import judge_average

    out = rows
    for name, client in clients.items():
        out = generated(out, client, prompt, f"__{name}")
    scores = F.array(*(judge_score(F.col(f"__{n}")) for n in clients))
    return out.withColumn("scores", scores).withColumn("score", judge_average(F.col("scores"))).select(*rows.columns, "scores", "score")
