"""The enricher that asks a chat-completion service, and the settings it needs."""

from __future__ import annotations

import json
import logging
import math
import urllib.request
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import cache

from vellum.operators import enrich

log = logging.getLogger(__name__)

#: Environment variables that stand in for an argument that is not given.
KEY_VARIABLE, TOKEN_VARIABLE, ENDPOINT_VARIABLE = "OPENAI_API_KEY", "HUGGINGFACE_TOKEN", "ENRICH_ENDPOINT"
# What a request asks for.
MODEL, TEMPERATURE, ATTEMPTS, PER_MINUTE = "gpt-4o-mini", 0.1, 3, 10_000
LEAST_REPLY, MOST_REPLY, REPLY_FACTOR, CHARS_A_TOKEN = 1024, 16_384, 1.5, 4

PROMPT = """You are given a passage that was recognised from a scanned page. Put right what recognition got wrong:
misread letters, broken or joined words, stray marks. Change nothing else. Keep the wording, the spelling of the time,
the order, the paragraphs and about the length. Add no remark. Answer with the corrected passage alone."""


def read_dotenv(text: str) -> dict[str, str]:
    """NAME=value lines; blank lines and comments are skipped, quotes around a value go."""
    out = {}
    for line in text.splitlines():
        name, equals, value = line.strip().removeprefix("export ").partition("=")
        if equals and not name.startswith("#"):
            out[name.strip()] = value.strip().strip("'\"")
    return out


def chosen(argument: str | None, variable: str, environment: Mapping[str, str], dotenv: Mapping[str, str] | None = None) -> str | None:
    """The argument, else the environment's value, else that of a settings file."""
    return argument or environment.get(variable) or (dotenv or {}).get(variable) or None


@dataclass(frozen=True)
class Settings:
    """All that a client needs. The key is not shown when settings are printed."""

    key: str = field(repr=False)
    endpoint: str
    prompt: str = PROMPT
    model: str = MODEL
    attempts: int = ATTEMPTS
    per_minute: float = PER_MINUTE
    timeout: float = 120.0

    def __post_init__(self) -> None:
        if not self.key:
            raise ValueError(f"an API key is needed: give one, or set {KEY_VARIABLE}")
        if not self.endpoint:
            raise ValueError(f"a service address is needed: give one, or set {ENDPOINT_VARIABLE}")
        if not self.prompt.strip():
            raise ValueError("the prompt is empty")


@cache
def token_counter(model: str) -> Callable[[str], int]:
    """Counts tokens as the model does; as a quarter of the characters where its tokenizer is not to be had."""
    try:
        import tiktoken

        try:
            encoding = tiktoken.encoding_for_model(model)
        except KeyError:
            encoding = tiktoken.get_encoding("cl100k_base")
        return lambda text: len(encoding.encode(text, disallowed_special=()))
    except Exception as e:  # no package, or no vocabulary at hand and no network
        log.warning("tokens are estimated: %s", e)
        return lambda text: math.ceil(len(text) / CHARS_A_TOKEN)


def reply_budget(tokens: int) -> int:
    return max(LEAST_REPLY, min(MOST_REPLY, int(tokens * REPLY_FACTOR)))


def post(endpoint: str, headers: dict[str, str], body: dict, timeout: float) -> dict:
    """Send a request and return the answer, both as JSON."""
    request = urllib.request.Request(endpoint, json.dumps(body).encode(), headers, method="POST")
    with urllib.request.urlopen(request, timeout=timeout) as answer:
        return json.load(answer)


class ChatClient:
    """One request for each chunk: the prompt as the system's message, the chunk as the user's."""

    def __init__(self, settings: Settings, send=post, count: Callable[[str], int] | None = None):
        self.settings, self.send = settings, send
        self.count = count or token_counter(settings.model)

    def body(self, chunk: str) -> dict:
        return {
            "model": self.settings.model,
            "messages": [{"role": "system", "content": self.settings.prompt.strip()}, {"role": "user", "content": chunk}],
            "temperature": TEMPERATURE,
            "max_tokens": reply_budget(self.count(chunk)),
        }

    def __call__(self, chunk: str) -> str | None:
        headers = {"Authorization": f"Bearer {self.settings.key}", "Content-Type": "application/json"}
        answer = self.send(self.settings.endpoint, headers, self.body(chunk), self.settings.timeout)
        return answer["choices"][0]["message"]["content"]


def factory(settings: Settings, partitions: int = 1, send=post, count=None) -> Callable[[], enrich.Enricher]:
    """What :func:`vellum.operators.enrich.enrich_texts` calls once for each partition.

    A chunk waits for its turn once, however often it is tried; each of so many partitions that
    run at a time has its share of the limit.
    """

    def make() -> enrich.Enricher:
        tried = enrich.with_retries(ChatClient(settings, send, count), settings.attempts)
        return enrich.limited(tried, enrich.partition_limiter(settings.per_minute, partitions))

    return make


def settings_or_none(
    key: str | None, endpoint: str | None, environment: Mapping[str, str], dotenv: Mapping[str, str] | None = None, **more
) -> Settings | None:
    """Settings from arguments, environment and file; None, with a warning, where something lacks."""
    try:
        return Settings(
            chosen(key, KEY_VARIABLE, environment, dotenv) or "",
            chosen(endpoint, ENDPOINT_VARIABLE, environment, dotenv) or "",
            **more,
        )
    except ValueError as e:
        log.warning("no enrichment: %s", e)
        return None
