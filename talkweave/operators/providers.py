"""Pluggable models: recognisers of speech, processors of text, diarizers; registries.

A provider is a plain object that is sent to the workers. Heavy models belong in its first call, not its constructor.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Protocol


class Recognizer(Protocol):
    provider_name: str
    model_name: str

    def transcribe_batch(self, paths: Sequence[str], batch_size: int, pretokenize: bool) -> list[str]: ...


class TextProvider(Protocol):
    """``None`` as an answer, or one of the wrong length, means failure: the source texts stay."""

    def anonymize(self, texts: list[str]) -> list[str] | None: ...

    def enhance(self, texts: list[str]) -> list[str] | None: ...


class Diarizer(Protocol):
    def diarize(self, path: str) -> list[tuple[float, float, str]]: ...


class GivenTexts:
    """A recogniser that knows its answers by path; unknown paths are silent."""

    provider_name, model_name = "given", "table"

    def __init__(self, texts: dict[str, str] | None = None):
        self.texts = texts or {}

    def transcribe_batch(self, paths: Sequence[str], batch_size: int, pretokenize: bool) -> list[str]:
        return [self.texts.get(p, "").strip() for p in paths]


_RECOGNIZERS: dict[str, Callable[..., Recognizer]] = {"given": GivenTexts}
_OTHERS: dict[str, dict[str, Callable]] = {"text": {}, "diarizer": {}}


def register(name: str, make: Callable[..., Recognizer]) -> None:
    _RECOGNIZERS[name] = make


def register_other(kind: str, name: str, make: Callable) -> None:
    """``kind`` is ``text`` (a ``TextProvider``) or ``diarizer``."""
    _OTHERS[kind][name] = make


def other(kind: str, name: str, **options):
    """The text provider or diarizer of a name; none for ``none``."""
    if name == "none":
        return None
    if name not in _OTHERS[kind]:
        raise ValueError(f"unknown {kind} provider {name!r}; known: {', '.join(sorted(_OTHERS[kind])) or 'none'}")
    return _OTHERS[kind][name](**options)


def recognizer(name: str, **options) -> Recognizer:
    if name not in _RECOGNIZERS:
        raise ValueError(f"unknown recogniser {name!r}; known: {', '.join(sorted(_RECOGNIZERS))}")
    return _RECOGNIZERS[name](**options)


def chosen(name: str, fallback: str = "none", **options) -> tuple[Recognizer, Recognizer | None]:
    """The recogniser of a name, and the one for batches on which it fails, if another is named."""
    return recognizer(name, **options), None if fallback in ("", "none", name) else recognizer(fallback)
