"""Namespaces: table identifiers to locations."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

from siltstone.errors import TableNotFound
from siltstone.manifest import versions
from siltstone.storage import Store


@dataclass
class TableInfo:
    location: str
    storage_options: dict[str, str] = field(default_factory=dict)


class Namespace(Protocol):
    def describe_table(self, table_id: list[str]) -> TableInfo: ...

    def create_empty_table(self, table_id: list[str], location: str | None = None) -> TableInfo: ...


class DirectoryNamespace:
    """Tables as folders below a root: ["a", "b"] is ``root/a/b``. A location of its own is noted in ``.location``."""

    def __init__(self, root: str, storage_options: dict[str, str] | None = None):
        self.store, self.storage_options = Store(root, options=storage_options), dict(storage_options or {})

    def _name(self, table_id: list[str]) -> str:
        if not table_id or any(not p or p in (".", "..") or "/" in p for p in table_id):
            raise ValueError(f"{table_id!r} is not a table identifier")
        return "/".join(table_id)

    def describe_table(self, table_id: list[str]) -> TableInfo:
        name = self._name(table_id)
        if not self.store.exists(name):
            raise TableNotFound(f"no table {name} in {self.store.root}")
        if self.store.exists(f"{name}/.location"):
            return TableInfo(self.store.read(f"{name}/.location"), dict(self.storage_options))
        return TableInfo(self.store.path(name), dict(self.storage_options))

    def create_empty_table(self, table_id: list[str], location: str | None = None) -> TableInfo:
        name = self._name(table_id)
        if self.store.exists(name) and (self.store.exists(f"{name}/.location") or versions(Store(self.store.path(name)))):
            raise FileExistsError(f"table {name} already exists")
        self.store.create(f"{name}/.location", location) if location else self.store.create(f"{name}/.table", "")
        return TableInfo(location or self.store.path(name), dict(self.storage_options))

    def drop_table(self, table_id: list[str]) -> None:
        info = self.describe_table(table_id)
        Store(info.location).remove("")
        self.store.remove(self._name(table_id))

    def list_tables(self) -> list[list[str]]:
        root = self.store.root
        return sorted(os.path.relpath(d, root).split(os.sep) for d, dirs, files in os.walk(root) if "_versions" in dirs or ".location" in files or ".table" in files)


def _directory(properties: dict[str, str]) -> DirectoryNamespace:
    options = {k.removeprefix("storage."): v for k, v in properties.items() if k.startswith("storage.")}
    return DirectoryNamespace(properties["root"], options)


_KINDS: dict[str, Callable[[dict[str, str]], Namespace]] = {"dir": _directory}


def register_namespace(kind: str, factory: Callable[[dict[str, str]], Namespace]) -> None:
    """Lets ``connect`` make namespaces of another kind, such as one's own catalog."""
    _KINDS[kind] = factory


def connect(kind: str, properties: dict[str, str]) -> Namespace:
    if kind not in _KINDS:
        raise ValueError(f"no namespace of kind {kind!r}; register_namespace adds to {sorted(_KINDS)}")
    return _KINDS[kind](properties)


def check_target(uri: str | None, namespace: Namespace | None, table_id: list[str] | None) -> None:
    if uri is not None and (namespace is not None or table_id is not None):
        raise ValueError("give either 'uri' or 'namespace' with 'table_id', not both")
    if uri is None and (namespace is None or table_id is None):
        raise ValueError("give 'uri', or 'namespace' and 'table_id' together")


def resolve(uri: str | None, namespace: Namespace | None, table_id: list[str] | None, storage_options: dict | None) -> tuple[str, dict]:
    """Location and storage options; the caller's dict is not changed."""
    check_target(uri, namespace, table_id)
    options = dict(storage_options or {})
    if uri is None:
        info = namespace.describe_table(table_id)
        uri, options = info.location, options | info.storage_options
    return uri, options
