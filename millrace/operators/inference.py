"""Rows to a model and back: one operator with injected clients, a retry policy and turn pairing.

A client is any callable (prompt, images) -> text; vendor protocols live outside.
``open_client`` is called once in each task and gives one client, or a list of them, one
for each host. Calls of a task run at the same time, up to a bound; answers go back to
the rows that asked. A row whose call fails to the end is dropped by ``answer_turns``
and null in ``ask``.
"""

from __future__ import annotations

import hashlib
import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import sequences
from millrace.operators import relational
from millrace.session import stored

Client = Callable[[str, list[str]], str]


@dataclass
class Retry:
    """``attempts`` for each call; ``budget``: how many calls in a row a host may fail before it is left out, if others are there."""

    attempts: int = 5
    wait: Callable[[int], float] = field(default=lambda i: 2.0**i)
    sleep: Callable[[float], None] = time.sleep
    budget: int = 3

    def call(self, client: Client, prompt: str, images: list[str]) -> str | None:
        return Hosts([client], self).call(prompt, images)


class Hosts:
    """Clients of several hosts in turn; one that fails too often in a row is asked only when no other is left."""

    def __init__(self, clients: list[Client], policy: Retry):
        self.clients, self.policy, self.lock, self.turn = clients, policy, threading.Lock(), 0
        self.failed = [0] * len(clients)

    def _pick(self, last: int | None) -> int:
        with self.lock:
            good = [i for i, n in enumerate(self.failed) if n < self.policy.budget] or list(range(len(self.clients)))
            other = [i for i in good if i != last] or good
            self.turn += 1
            return other[self.turn % len(other)]

    def call(self, prompt: str, images: list[str]) -> str | None:
        at = None
        for i in range(self.policy.attempts):
            at = self._pick(at)
            try:
                answer = self.clients[at](prompt, images)
            except Exception:
                with self.lock:
                    self.failed[at] += 1
                if i + 1 < self.policy.attempts:
                    self.policy.sleep(self.policy.wait(i))
            else:
                with self.lock:
                    self.failed[at] = 0
                return answer
        return None


def _hosts(open_client: Callable[[], Client | list[Client]], policy: Retry) -> Hosts:
    made = open_client()
    return Hosts(made if isinstance(made, list) else [made], policy)


def stub_client() -> Client:
    """Answers with the SHA-256 of the prompt."""
    return lambda prompt, images: hashlib.sha256(prompt.encode()).hexdigest()


def ask(
    df: DataFrame, open_client: Callable[[], Client | list[Client]], prompt: str = "prompt", images: str | None = None, out: str = "answer", retry: Retry | None = None, concurrency: int = 1
) -> DataFrame:
    """Adds the clients' answer to each row's prompt, or null. Only prompts and images go to Python; a null prompt isn't asked.

    ``concurrency``: how many calls a task has under way at most; a batch of rows is answered before the next is taken.
    """
    policy = retry or Retry()

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        hosts = _hosts(open_client, policy)
        one = lambda p, x: None if p is None else hosts.call(p, list(x) if x is not None else [])
        with ThreadPoolExecutor(concurrency) as pool:
            for prompts, shown in batches:
                yield pd.Series(list(pool.map(one, prompts, shown)), dtype=object)

    run.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    shown = F.col(images) if images else F.array().cast("array<string>")
    return df.withColumn(out, F.pandas_udf(run, "string").asNondeterministic()(F.col(prompt), shown))


def turn_pairs(df: DataFrame, conv: str = "conv_id", turn: str = "turn", body: str = "text") -> DataFrame:
    """(conv, i, prompt): turn 2i asks for turn 2i + 1; a last turn without an answer is left out."""
    turns = F.array_sort(F.collect_list(F.struct(F.col(turn), F.col(body).alias("text"))))
    rows = df.groupBy(conv).agg(turns.alias("t")).where("size(t) > 1")
    pairs = F.explode(F.sequence(F.lit(0), F.floor(F.size("t") / 2).cast("int") - 1)).alias("i")
    return rows.select(conv, "t", pairs).select(conv, "i", F.get("t", F.col("i") * 2)["text"].alias("prompt"))


def answer_turns(df: DataFrame, open_client: Callable[[], Client | list[Client]], conv: str = "conv_id", retry: Retry | None = None, concurrency: int = 1, **names: str) -> DataFrame:
    """(conv, i, prompt, answer) of conversations all of whose calls succeeded. Calls are made once: answers are stored."""
    told = stored(ask(turn_pairs(df, conv, **names), open_client, retry=retry, concurrency=concurrency))
    failed = told.where("answer is null").select(conv).distinct()
    return told.join(failed, conv, "left_anti")


def distilled(
    df: DataFrame, open_client: Callable[[], Client | list[Client]], key: str = "id", content: str = "content", prompts: str = "ocr_markdown", retry: Retry | None = None, concurrency: int = 1, max_pixels: int | None = None
) -> DataFrame:
    """OCR distillation: a picked prompt, the answer's fenced block, a new two-turn conversation for each quarter turn of the image.

    With ``max_pixels`` larger images are shrunk to that area, keeping their shape, before they are sent and kept.
    """
    from millrace.functions import geometry, images
    from millrace.functions.prompts import pick
    from millrace.functions.text import fenced_block
    from millrace.operators.packing import rotated

    if max_pixels is not None:
        sized = df.withColumn("__d", images.dimensions(content))
        to = geometry.limited(F.col("__d.w"), F.col("__d.h"), max_pixels)
        over = F.col("__d.w") * F.col("__d.h") > max_pixels
        shrunk = images.resized(content, F.coalesce(to["w"].cast("int"), F.lit(1)), F.coalesce(to["h"].cast("int"), F.lit(1)))
        df = sized.withColumn(content, F.when(over, shrunk).otherwise(F.col(content))).drop("__d")
    asked = df.withColumn("prompt", pick(F.xxhash64(key), prompts)).withColumn("images", F.array(content))
    told = ask(asked, open_client, images="images", retry=retry, concurrency=concurrency).where("answer is not null")
    turns = F.array(F.struct(F.lit("user").alias("role"), F.col("prompt").alias("text")), F.struct(F.lit("assistant").alias("role"), fenced_block(F.col("answer")).alias("text")))
    return rotated(told.select(key, content, turns.alias("conversations")), key, content)


def by_rank(samples: DataFrame, ranks: int, order: list[str], open_client: Callable[[], Client | list[Client]], model: str, retry: Retry | None = None, concurrency: int = 1) -> DataFrame:
    """Samples (id, conversations with responses) of all files, in contiguous shares of rows by rank, every second turn answered under a model's name.

    Ranks only name where a row goes (``write_by``); a sample with a failed call is left out.
    """
    placed = relational.positioned(samples, *order)
    n = placed.agg(F.count("*").alias("n"))
    ranked = placed.join(F.broadcast(n), F.lit(True)).withColumn("rank", relational.block_rank(F.col("pos"), F.col("n"), ranks)).drop("n")
    return answered(ranked, open_client, model, retry, concurrency)


def by_file(
    samples: DataFrame, out_root: str, open_client: Callable[[], Client | list[Client]], model: str, start: int = 0, end: int | None = None, done: DataFrame | None = None,
    retry: Retry | None = None, concurrency: int = 1,
) -> DataFrame:
    """Samples of the files with places [start, end) in name order, answered, with the output ``path`` of each; of these, files already done are left out.

    Places are those among all files, so that the same range names the same files on a second run.
    """
    files = relational.positioned(samples.select("file").distinct(), "file").where(F.col("pos") >= start)
    files = files.where(F.col("pos") < end) if end is not None else files
    if done is not None:
        files = relational.remaining(files, done, "file", only_name=True)
    path = F.concat(F.lit(out_root.rstrip("/") + "/"), F.element_at(F.split("file", "/"), -1))
    return answered(samples.join(files.select("file"), "file").withColumn("path", path), open_client, model, retry, concurrency)


def answered(samples: DataFrame, open_client: Callable[[], Client | list[Client]], model: str, retry: Retry | None = None, concurrency: int = 1) -> DataFrame:
    """Samples with the answers to turns 0, 2, ... stored under a model's name in the turns after them; one with a failed call is left out.

    The images of a sample go with each of its prompts. Calls of one sample are made by one task, one after the other; those of
    up to ``concurrency`` samples are under way at the same time.
    """
    policy = retry or Retry()
    shown = F.transform(F.coalesce("images", F.array()), lambda x: x["content"]) if "images" in samples.columns else F.array().cast("array<string>")
    prompts = F.transform(F.filter("conversations", lambda t, i: i % 2 == 0), lambda t: t["text"])
    asked = samples.withColumn("__prompts", F.slice(prompts, F.lit(1), F.floor(F.size("conversations") / 2).cast("int"))).withColumn("__shown", shown)

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        hosts = _hosts(open_client, policy)

        def one(prompts, images) -> list[str] | None:
            answers = []
            for prompt in prompts if prompts is not None else ():
                answer = hosts.call(prompt, list(images) if images is not None else [])
                if answer is None:
                    return None
                answers.append(answer)
            return answers if prompts is not None else None

        with ThreadPoolExecutor(concurrency) as pool:
            for prompts, images in batches:
                yield pd.Series(list(pool.map(one, prompts, images)), dtype=object)

    run.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    told = asked.withColumn("__answers", F.pandas_udf(run, "array<string>").asNondeterministic()("__prompts", "__shown")).where("__answers is not null")
    turns = sequences.answered(F.col("conversations"), F.col("__answers"), model)
    return told.withColumn("conversations", turns).drop("__prompts", "__shown", "__answers")


def write_by(df: DataFrame, path: str, by: str = "rank") -> None:
    """JSON lines in a folder for each rank or path; a share without rows writes nothing."""
    df.write.mode("overwrite").partitionBy(by).option("ignoreNullFields", "false").json(path)


def save(df: DataFrame, root: str, by: str = "rank", order: tuple[str, ...] = ("id",)) -> None:
    """JSON lines in exactly one file for each rank (``rank0.jsonl``, ...) or path (by its name); files that exist stay, and the manifest tells the rows."""
    from millrace.functions.text import basename
    from millrace.sources import routed

    name = basename(F.col(by)) if dict(df.dtypes)[by] == "string" else F.concat(F.lit(by), F.col(by).cast("string"), F.lit(".jsonl"))
    routed.write_files(df.withColumn("__path", name).drop(by), root, "__path", order)
