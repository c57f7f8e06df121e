"""Compositions of operators: whole pipelines and the registered queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from typing import Any

from pyspark.sql import DataFrame


def once(method: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Build a plan object's frame once per argument list.

    Equal subplans are then the same frame, which Spark recognises and runs once.
    """
    slot = f"_{method.__name__}_frames"

    @wraps(method)
    def frame(self: Any, *args: Any) -> DataFrame:
        made = self.__dict__.setdefault(slot, {})
        if args not in made:
            made[args] = method(self, *args)
        return made[args]

    return frame
