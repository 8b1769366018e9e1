"""Answering services behind one small interface, called from Spark tasks."""

from __future__ import annotations

import json
import os
import re
import time
import urllib.request
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, types as T

from quaestor.functions.text import RETRYABLE
from quaestor.options import Options
from quaestor.schemas import DIFFICULTIES, QUESTION_TYPES

SYSTEM_TEXT = "You analyse financial documents precisely and answer with data in exactly the requested schema."


class Provider(Protocol):
    backend: str
    rpm: int | None

    def complete(self, prompt: str, kind: str, temperature: float) -> str:
        """JSON text for a prompt; ``kind`` is ``generation`` or ``verification``."""


class OfflineProvider:
    """Deterministic stand-in that needs no network: it quotes the passage and checks quotes."""

    backend = "offline"
    rpm = None

    def complete(self, prompt: str, kind: str, temperature: float) -> str:
        return json.dumps(self._generate(prompt) if kind == "generation" else self._verify(prompt))

    def _generate(self, prompt: str) -> dict:
        wanted = int(re.search(r"Write exactly (\d+) ", prompt).group(1))
        passage = prompt.split("<passage>\n", 1)[1].rsplit("\n</passage>", 1)[0]
        quotes = [s for s in re.split(r"(?<=[.!?])\s+", passage) if s][:wanted]
        return {"qa_pairs": [{
            "question": f"What does this sentence of the passage say: {quote}",
            "answer": quote, "source_passage": quote,
            "question_type": QUESTION_TYPES[i % len(QUESTION_TYPES)],
            "difficulty": DIFFICULTIES[i % len(DIFFICULTIES)],
            "reasoning_steps": f"Step 1: quote = sentence {i + 1}" if i % 2 else None,
        } for i, quote in enumerate(quotes)]}

    def _verify(self, prompt: str) -> dict:
        found = re.findall(r"--- QA Pair (\d+) ---\nSection: .*?\nAnswer: (.*?)\nSource Passage: (.*?)\nQuestion Type: ",
                           prompt, re.S)
        return {"results": [{
            "qa_index": int(i), "is_faithful": answer in passage, "is_answerable": bool(passage.strip()),
            "confidence": 1.0 if answer in passage else 0.0, "reasoning": "quote check",
        } for i, answer, passage in found]}


def _post(url: str, body: dict, headers: dict) -> dict:
    request = urllib.request.Request(url, data=json.dumps(body).encode(),
                                     headers={"Content-Type": "application/json", **headers})
    with urllib.request.urlopen(request, timeout=120) as answer:
        return json.load(answer)


class OpenRouterProvider:
    """Chat completions with JSON output."""

    backend = "openrouter"

    def __init__(self, key: str, model: str, url: str, rpm: int):
        self.key, self.model, self.url, self.rpm = key, model, url, rpm

    def complete(self, prompt: str, kind: str, temperature: float) -> str:
        answer = _post(f"{self.url}/chat/completions", {
            "model": self.model, "temperature": temperature, "response_format": {"type": "json_object"},
            "messages": [{"role": "system", "content": SYSTEM_TEXT}, {"role": "user", "content": prompt}],
        }, {"Authorization": f"Bearer {self.key}"})
        return answer["choices"][0]["message"]["content"]


class GeminiProvider:
    """Content generation with JSON output; an empty answer is an error."""

    backend = "gemini"
    url = "https://generativelanguage.googleapis.com/v1beta/models"

    def __init__(self, key: str, model: str, rpm: int):
        self.key, self.model, self.rpm = key, model, rpm

    def complete(self, prompt: str, kind: str, temperature: float) -> str:
        answer = _post(f"{self.url}/{self.model}:generateContent", {
            "contents": [{"parts": [{"text": prompt}]}],
            "generationConfig": {"temperature": temperature, "responseMimeType": "application/json"},
        }, {"x-goog-api-key": self.key})
        parts = (answer.get("candidates") or [{}])[0].get("content", {}).get("parts", [])
        text = "".join(p.get("text", "") for p in parts)
        if not text:
            raise ValueError("empty response")
        return text


def provider_from_env(options: Options = Options()) -> Provider:
    """The first backend with a key in the environment."""
    if os.environ.get("OPENROUTER_API_KEY"):
        return OpenRouterProvider(os.environ["OPENROUTER_API_KEY"], options.openrouter_model,
                                  options.openrouter_url, options.openrouter_rpm)
    if os.environ.get("GOOGLE_API_KEY"):
        return GeminiProvider(os.environ["GOOGLE_API_KEY"], options.gemini_model, options.gemini_rpm)
    raise ValueError("set OPENROUTER_API_KEY or GOOGLE_API_KEY, or use the offline provider")


SPAN = 61.0  # seconds that hold at most a minute's requests, with one to spare


class Throttle:
    """At most ``rpm`` requests in any sixty seconds by all ``tasks`` together.

    Each task spaces its requests by 61 / rpm * tasks seconds and waits for
    its own place in the first of these spans, so neither the start of a stage
    nor that of a later wave of tasks sends more than the limit.
    """

    def __init__(self, rpm: float, tasks: int = 1, task: int = 0, clock=time.monotonic, sleep=time.sleep):
        if tasks > max(1, int(rpm)):
            raise ValueError(f"{tasks} tasks can't share {rpm} requests per minute")
        self.gap, self.clock, self.sleep = SPAN / rpm * tasks, clock, sleep
        self.next = clock() + SPAN / rpm * (task % tasks + 1)

    def wait(self) -> None:
        self.sleep(max(0.0, self.next - self.clock()))
        self.next = max(self.next, self.clock()) + self.gap


def ask(provider: Provider, throttle: Throttle | None, prompt: str, kind: str, temperature: float,
        options: Options, sleep=time.sleep) -> tuple[str | None, str | None, int]:
    """Response, error and number of requests; retryable errors get more tries with doubling waits."""
    attempt = 0
    while True:
        if throttle:
            throttle.wait()
        try:
            return provider.complete(prompt, kind, temperature), None, attempt + 1
        except Exception as failure:
            error = str(failure)
            again = any(mark in error for mark in RETRYABLE.get(provider.backend, ()))
            if not again or attempt >= options.max_retries:
                return None, error, attempt + 1
            sleep(options.retry_base_delay_sec * 2 ** attempt)
            attempt += 1


def complete(prompts: DataFrame, factory: Callable[[], Provider], kind: str, temperature: float,
             options: Options = Options(), tasks: int | None = None) -> DataFrame:
    """Send every ``prompt``; adds ``response``, ``error`` and ``requests``.

    One provider per task. With ``tasks`` the rows go to that many tasks and
    each gets its share of the requests per minute; a service with a limit
    needs it, and no more tasks than requests per minute are started.
    """
    limit = factory().rpm if tasks else None
    tasks = min(tasks, max(1, int(limit))) if tasks and limit else tasks
    schema = T.StructType([*prompts.schema.fields, T.StructField("response", T.StringType()),
                           T.StructField("error", T.StringType()), T.StructField("requests", T.IntegerType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        provider = factory()
        place = TaskContext.get().partitionId() if TaskContext.get() else 0
        throttle = Throttle(provider.rpm, tasks or 1, place) if provider.rpm else None
        for batch in batches:
            answers = [ask(provider, throttle, p, kind, temperature, options) for p in batch["prompt"]]
            yield batch.assign(response=[a[0] for a in answers], error=[a[1] for a in answers],
                               requests=pd.Series([a[2] for a in answers], dtype="int32", index=batch.index))

    spread = prompts.repartition(tasks) if tasks else prompts
    return spread.mapInPandas(run, schema)
