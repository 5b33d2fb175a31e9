"""A deterministic stand-in for the model labeller (used by tests and queries)."""

from __future__ import annotations


def stub_answer(prompt: str) -> str:
    """Answer from the prompt's URL line: product for '-p-', brand for
    '/marka/', a fenced homepage answer for a trailing '/', else prose."""
    url_line = prompt.split("\n", 1)[0]
    if "-p-" in url_line:
        return '{"label":"product"}'
    if "/marka/" in url_line:
        return '{"label":"brand"}'
    if url_line.endswith("/"):
        return '```json\n{"label":"homepage"}\n```'
    return "unsure"


def stub_complete(system: str, prompts: list[str]) -> list[str]:
    return [stub_answer(p) for p in prompts]


class FlakyStub:
    """Fails the first ``failures`` calls, then answers like ``stub_complete``."""

    def __init__(self, failures: int = 2):
        self.failures = failures
        self.calls = 0

    def __call__(self, system: str, prompts: list[str]) -> list[str]:
        self.calls += 1
        if self.calls <= self.failures:
            raise RuntimeError("service unavailable")
        return stub_complete(system, prompts)
