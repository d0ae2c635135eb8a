"""Code-host provider registry (UDX-1).

A provider is the pair of page descriptions (payload schema and keys) plus the
two DataFrame normalisers that turn its landed pages into ``pull_requests`` and
``pull_request_commits`` rows.  Another host plugs in by registering its own
schemas and functions; the fetch half (HTTP clients) is out of scope — pages
arrive as landed files.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from issuelens.operators.normalize import normalize_commits, normalize_pull_requests
from issuelens.sources.landed import COMMIT_PAGES, PULL_REQUEST_PAGES, Pages


@dataclass(frozen=True)
class Provider:
    name: str
    pull_request_pages: Pages
    commit_pages: Pages
    normalize_pull_requests: Callable[[DataFrame], DataFrame]
    normalize_commits: Callable[[DataFrame], DataFrame]


_REGISTRY: dict[str, Provider] = {}


def register(provider: Provider) -> None:
    _REGISTRY[provider.name] = provider


def get(name: str) -> Provider:
    try:
        return _REGISTRY[name]
    except KeyError:
        raise KeyError(f"unknown provider {name!r}; registered: {sorted(_REGISTRY)}") from None


def names() -> list[str]:
    return sorted(_REGISTRY)


register(Provider("github", PULL_REQUEST_PAGES, COMMIT_PAGES,
                  normalize_pull_requests, normalize_commits))
