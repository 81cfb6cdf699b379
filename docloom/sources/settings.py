"""Settings files and site discovery: control work on the driver."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Mapping
from pathlib import Path

from docloom.config import checked_version
from docloom.errors import InputError, SettingsError

#: Where a sitemap may be that no robots file names.
FALLBACKS = ("/sitemap.xml", "/sitemap_index.xml", "/sitemap-index.xml")


def load_site(path: str) -> dict:
    """A site's settings: version, mod and entry_url must be non-empty; exclude is a list, by default empty."""
    try:
        site = json.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, ValueError) as e:
        raise InputError(f"{path}: {e}") from e
    missing = [k for k in ("version", "mod", "entry_url") if not isinstance(site, dict) or not site.get(k)]
    if missing:
        raise InputError(f"{path}: missing {', '.join(missing)}")
    checked_version(site["version"])
    return {"exclude": [], "include": [], **site}


def load_settings(path: str, names: list[str], environment: Mapping[str, str] = os.environ) -> dict[str, str]:
    """Named settings from the environment, else from a file of NAME=value lines. Messages never hold values."""
    file: dict[str, str] = {}
    if Path(path).exists():
        for line in Path(path).read_text(encoding="utf-8").splitlines():
            name, sep, value = line.strip().partition("=")
            if sep and not name.startswith("#"):
                file[name.strip()] = value.strip().strip("\"'")
    found = {n: environment.get(n, file.get(n, "")) for n in names}
    bad = [n for n, v in found.items() if not v.strip() or "${" in v]
    if bad:
        raise SettingsError(f"not set: {', '.join(bad)}")
    return found


def discover_sitemap(root: str, declared: list[str], is_sitemap: Callable[[str], bool]) -> str:
    """The first address, of the declared ones and then the usual ones, that holds a sitemap."""
    for url in [*declared, *(root.rstrip("/") + p for p in FALLBACKS)]:
        if is_sitemap(url):
            return url
    raise InputError(f"no sitemap found for {root}")
