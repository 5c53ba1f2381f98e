"""Operators by name: what they need, what they cost, how they score."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from enum import IntEnum

from pyspark.sql import Column, DataFrame


class Tier(IntEnum):
    RULE = 1
    PERCEPTUAL = 5
    MODEL = 20
    LLM = 50


@dataclass(frozen=True)
class Operator:
    """``score`` gives a column (row operators) or a frame of (id, score, keep) (batch operators).

    ``needs`` names what a batch operator reads beside the id, as columns made from the text.
    """

    name: str
    modalities: frozenset[str]
    score: Callable[..., Column | DataFrame]
    tier: Tier = Tier.RULE
    batch: bool = False
    params: dict = field(default_factory=dict)
    needs: dict[str, Callable[[Column], Column]] = field(default_factory=dict)


_known: dict[str, Operator] = {}


def operator(name: str, modalities: tuple[str, ...], tier: Tier = Tier.RULE, batch: bool = False, needs: dict | None = None, **params):
    """Register a scoring function; a name can be taken once."""

    def add(f):
        if name in _known:
            raise ValueError(f"operator {name} exists already")
        if not modalities:
            raise ValueError(f"operator {name} names no modality")
        _known[name] = Operator(name, frozenset(modalities), f, tier, batch, params, needs or {})
        return f

    return add


def get(name: str) -> Operator:
    try:
        return _known[name]
    except KeyError:
        raise ValueError(f"unknown operator {name}; known: {', '.join(sorted(_known))}") from None


def names() -> list[str]:
    return sorted(_known)


def unregister(name: str) -> None:
    _known.pop(name, None)
