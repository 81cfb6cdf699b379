"""Settings of a pipeline run."""

from __future__ import annotations

import re
from dataclasses import dataclass

from docloom.errors import InputError

#: Recipe labels that a page repeats as lines of their own, longer ones before those they begin with.
LABELS = ("Crafting (Shapeless)", "Throw in Water", "Inscriber", "Crafting", "Smelting", "Smithing", "Recipes", "Charger", "Recipe")
#: Labels that name no method.
GENERIC_LABELS = ("Recipe", "Recipes", "Crafting", "Crafting (Shapeless)")


@dataclass(frozen=True)
class Config:
    labels: tuple[str, ...] = LABELS
    site_name: str = ""
    parent_limit: int = 2048
    child_limit: int = 256
    child_overlap: int = 32
    input_limit: int = 8192
    short_body: int = 200
    short_parent: int = 50
    dim: int = 64
    norm_tolerance: float = 1e-4
    neighbour_tolerance: float = 1e-6


def checked_version(version: object) -> str:
    """``version`` if it can name a partition: non-empty ASCII, no slashes or white space, not ``.`` or ``..``."""
    if not isinstance(version, str) or not re.fullmatch(r"[!-~]+", version) or re.search(r"[/\\]", version) or version in (".", ".."):
        raise InputError(f"not a version: {version!r}")
    return version
