"""Choosing a plug-in by name: a registered one, or "module:attribute" of an installed module,
or "remote:URL" and "local:FOLDER" where the kind of plug-in has them."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from importlib import import_module
from typing import Any

from tessera.errors import SourceError


def resolve(kind: str, name: str, registry: Mapping[str, Any], schemes: Mapping[str, Callable[[str], Any]] | None = None) -> Any:
    """What the name stands for; an unknown one is an error that lists the known ones."""
    if name in registry:
        return registry[name]
    scheme, _, rest = name.partition(":")
    if rest and scheme in (schemes or {}):
        return schemes[scheme](rest)
    if rest:
        try:
            return getattr(import_module(scheme), rest)
        except (ModuleNotFoundError, AttributeError) as e:
            raise SourceError(f"{kind} {name!r} can't be loaded: {e}") from e
    known = [*sorted(registry), *[f"{s}:..." for s in sorted(schemes or {})], "module:attribute"]
    raise SourceError(f"no {kind} {name!r}; there are {', '.join(known)}")
