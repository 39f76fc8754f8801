"""Normalization contracts: declarative per-source field rules (driver side only).

A contract document has the sections ``source``, ``partition_key``,
``envelope``, ``common`` and ``event_types``; every leaf is a field rule with
the keys ``from``, ``take``, ``as``, ``default`` and ``expression``.

Validation happens once at load time (nothing here touches data):

* unknown rule keys are rejected;
* exactly one of ``from`` / ``expression`` (an empty string counts as absent);
* ``from`` is a dotted path of identifiers (``a.b.c``); ``take`` likewise;
* ``as`` is ``boolean`` or ``timestamp``;
* all five sections are required; sections are mappings of rules.

``expression`` is a Spark SQL expression over the column ``payload`` (a
VARIANT holding the event payload), e.g. ``size(try_cast(payload:items AS ARRAY<VARIANT>))``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

import yaml

# Fixed values that must match the contract language.
RULE_KEYS = ("from", "take", "as", "default", "expression")
AS_VALUES = ("boolean", "timestamp")
SECTIONS = ("source", "partition_key", "envelope", "common", "event_types")
IDENTIFIER = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")

# Fields pulled out of the evaluated rules into the fixed envelope of a
# normalized event, and names the open tail may not reuse.
EXTRACTED_FIELDS = ("partition_key", "entity_id", "entity_name", "event_time")
RESERVED_TAIL_NAMES = ("source", "event_id", "event_type", "ingested_at", "schema_version")


class ContractError(ValueError):
    """A contract document failed validation."""


@dataclass(frozen=True)
class FieldRule:
    from_: str | None = None
    take: str | None = None
    as_: str | None = None
    default: Any = None
    expression: str | None = None

    @property
    def path(self) -> tuple[str, ...]:
        return tuple(self.from_.split(".")) if self.from_ else ()

    @property
    def take_path(self) -> tuple[str, ...]:
        return tuple(self.take.split(".")) if self.take else ()

    @classmethod
    def parse(cls, obj: Any, where: str) -> "FieldRule":
        if isinstance(obj, FieldRule):
            return obj
        if not isinstance(obj, Mapping):
            raise ContractError(f"{where}: a field rule must be a mapping, got {type(obj).__name__}")
        unknown = sorted(set(obj) - set(RULE_KEYS))
        if unknown:
            raise ContractError(f"{where}: unknown rule key(s) {unknown}")
        src = obj.get("from")
        expr = obj.get("expression")
        take = obj.get("take")
        as_ = obj.get("as")
        for key, val in (("from", src), ("expression", expr), ("take", take)):
            if val is not None and not isinstance(val, str):
                raise ContractError(f"{where}: '{key}' must be a string")
        for key, val in (("from", src), ("take", take)):
            steps = [x for x in val.split(".") if not IDENTIFIER.match(x)] if val else []
            if steps:
                raise ContractError(f"{where}: {key!r} is a path of names joined by dots, and {steps} are no names; write an 'expression' for more")
        if bool(src) == bool(expr):
            raise ContractError(f"{where}: a field rule needs exactly one of 'from' or 'expression'")
        if as_ is not None and as_ not in AS_VALUES:
            raise ContractError(f"{where}: 'as' must be one of {list(AS_VALUES)}, got {as_!r}")
        default = obj.get("default")
        try:
            json.dumps(default)
        except TypeError as exc:
            raise ContractError(f"{where}: 'default' must be a JSON value: {exc}") from None
        return cls(from_=src or None, take=take or None, as_=as_, default=default, expression=expr or None)


def _rules(obj: Any, where: str) -> dict[str, FieldRule]:
    if not isinstance(obj, Mapping):
        raise ContractError(f"{where}: must be a mapping of field rules")
    return {str(name): FieldRule.parse(rule, f"{where}.{name}") for name, rule in obj.items()}


@dataclass(frozen=True)
class Contract:
    source: str
    partition_key: FieldRule
    envelope: dict[str, FieldRule] = field(default_factory=dict)
    common: dict[str, FieldRule] = field(default_factory=dict)
    event_types: dict[str, dict[str, FieldRule]] = field(default_factory=dict)
    # optional Spark SQL type per output field, used by the typed wide table;
    # rules themselves carry no types
    column_types: dict[str, str] = field(default_factory=dict)

    @classmethod
    def parse(cls, doc: Any, where: str = "contract") -> "Contract":
        if not isinstance(doc, Mapping):
            raise ContractError(f"{where}: a contract must be a mapping")
        missing = [s for s in SECTIONS if s not in doc]
        if missing:
            raise ContractError(f"{where}: missing section(s) {missing}")
        if not isinstance(doc["source"], str):
            raise ContractError(f"{where}: 'source' must be a string")
        types = doc["event_types"]
        if not isinstance(types, Mapping):
            raise ContractError(f"{where}.event_types: must be a mapping")
        column_types = doc.get("column_types") or {}
        if not isinstance(column_types, Mapping) or not all(isinstance(v, str) for v in column_types.values()):
            raise ContractError(f"{where}.column_types: must map field names to Spark SQL type names")
        return cls(
            column_types={str(k): v for k, v in column_types.items()},
            source=doc["source"],
            partition_key=FieldRule.parse(doc["partition_key"], f"{where}.partition_key"),
            envelope=_rules(doc["envelope"], f"{where}.envelope"),
            common=_rules(doc["common"], f"{where}.common"),
            event_types={
                str(t): _rules(rules if rules is not None else {}, f"{where}.event_types.{t}")
                for t, rules in types.items()
            },
        )

    @classmethod
    def from_yaml(cls, text: str, where: str = "contract") -> "Contract":
        return cls.parse(yaml.safe_load(text), where)

    def rules_for(self, event_type: str | None) -> dict[str, FieldRule]:
        """Section overlay: partition_key, envelope, common, then the type's own
        section; a later section overwrites a field of the same name (its
        position stays where the name first appeared). An undeclared type
        (``None`` or unknown) gets envelope + common only."""
        merged: dict[str, FieldRule] = {"partition_key": self.partition_key}
        merged.update(self.envelope)
        merged.update(self.common)
        if event_type is not None and event_type in self.event_types:
            merged.update(self.event_types[event_type])
        return merged

    def lint(self) -> list[str]:
        """Warnings for event types whose rows can never be normalized (a
        required envelope field missing, or a tail field reusing an envelope
        name); such rows are routed to the quarantine."""
        out = []
        types = [None, *self.event_types]
        for t in types:
            rules = self.rules_for(t)
            label = t or "<undeclared types>"
            missing = [f for f in EXTRACTED_FIELDS if f not in rules]
            clash = [n for n in rules if n in RESERVED_TAIL_NAMES]
            if missing:
                out.append(f"{self.source}/{label}: no rule for {missing}; its rows are quarantined")
            if clash:
                out.append(f"{self.source}/{label}: fields {clash} reuse envelope names; its rows are quarantined")
        return out

    def field_names(self) -> list[str]:
        """Every field any event type can produce, in first-seen order."""
        names = dict.fromkeys(self.rules_for(None))
        for t in self.event_types:
            names.update(dict.fromkeys(self.rules_for(t)))
        return list(names)


def load_contract(path: str | Path) -> Contract:
    p = Path(path)
    return Contract.from_yaml(p.read_text(), where=p.name)


def load_contracts(directory: str | Path) -> dict[str, Contract]:
    """Every ``<source>.yml`` in a directory, keyed by file stem (the
    stem is the ``source`` value rows are matched on)."""
    d = Path(directory)
    out: dict[str, Contract] = {}
    for p in sorted(list(d.glob("*.yml")) + list(d.glob("*.yaml"))):
        out[p.stem] = load_contract(p)
    return out


def as_contracts(contracts: Mapping[str, Any] | Contract | str | Path) -> dict[str, Contract]:
    """Accept a contract, a mapping source -> contract/dict/YAML text, or a directory."""
    if isinstance(contracts, Contract):
        return {contracts.source: contracts}
    if isinstance(contracts, (str, Path)):
        return load_contracts(contracts)
    out = {}
    for src, c in contracts.items():
        if isinstance(c, Contract):
            out[src] = c
        elif isinstance(c, str):
            out[src] = Contract.from_yaml(c, where=src)
        else:
            out[src] = Contract.parse(c, where=src)
    return out


BUILTIN_DIR = Path(__file__).resolve().parent.parent / "contracts"


def builtin_contracts() -> dict[str, Contract]:
    """The contracts shipped with the package (``eventloom/contracts``)."""
    return load_contracts(BUILTIN_DIR)
