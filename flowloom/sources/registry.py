"""Providers of interfaces, by version or by the name of a module or class."""

from __future__ import annotations

import importlib
from abc import ABC, abstractmethod

from .schema import V5, V7, Interface


class FlowProvider(ABC):
    """Makes an interface; a custom one can map other columns over records of version 5 or 7."""

    @abstractmethod
    def create_interface(self) -> Interface: ...


class Version5(FlowProvider):
    def create_interface(self) -> Interface:
        return V5


class Version7(FlowProvider):
    def create_interface(self) -> Interface:
        return V7


_KNOWN: dict[str, type] = {"5": Version5, "7": Version7}


def register_provider(name: str, provider: type) -> None:
    """Makes a provider known by a name of its own, in this process; elsewhere use its dotted name."""
    _KNOWN[name] = provider


def lookup(name: str | int) -> type:
    """The provider class: a known name, a dotted class name, or a module with a DefaultProvider."""
    name = str(name)
    if name in _KNOWN:
        return _KNOWN[name]
    for dotted in (name, f"{name}.DefaultProvider"):
        module, _, attribute = dotted.rpartition(".")
        if not module:
            continue
        try:
            found = getattr(importlib.import_module(module), attribute, None)
        except ModuleNotFoundError:
            continue
        if isinstance(found, type):
            return found
    raise LookupError(f"Failed to find NetFlow interface for {name}")


def create_interface(name: str | int) -> Interface:
    """The interface of a provider, checked."""
    provider = lookup(name)
    if not issubclass(provider, FlowProvider):
        raise NotImplementedError(f"Provider {name} does not support the FlowProvider interface")
    made = provider().create_interface()
    if not isinstance(made, Interface):
        raise ValueError(f"Provider {name} made no interface")
    return made
