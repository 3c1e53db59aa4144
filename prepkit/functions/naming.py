"""What to do when a new column's name is already taken."""

from __future__ import annotations

from collections.abc import Iterable

from prepkit.functions.schema import check_choice

IF_EXISTS = ("reuse", "overwrite", "suffix", "fail")


def free_name(base: str, taken: Iterable[str]) -> str:
    taken = set(taken)
    if base not in taken:
        return base
    i = 1
    while f"{base}_{i}" in taken:
        i += 1
    return f"{base}_{i}"


def resolve_name(name: str, taken: Iterable[str], if_exists: str) -> str | None:
    """The name to write to, or None when the existing column is to be kept."""
    check_choice(if_exists, IF_EXISTS, "if_exists")
    taken = list(taken)
    if name not in taken or if_exists == "overwrite":
        return name
    if if_exists == "reuse":
        return None
    if if_exists == "suffix":
        return free_name(name, taken)
    raise ValueError(f"There already exists a column {name}: let if_exists overwrite it, reuse it or add a suffix.")
