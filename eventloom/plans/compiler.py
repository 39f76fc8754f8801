"""Compile contracts into Spark SQL expressions (driver side, once per query).

A rule becomes a pair of expressions: ``value`` (VARIANT, SQL NULL when
nothing resolves) and ``error`` (boolean, never NULL). A set of contracts
becomes a :class:`ContractPlan`: every (source, event type) pair — plus one
fallback per source for undeclared types — is a *branch* with its own merged
rule set. Rows are routed to a branch with one map lookup and every output
column is a ``CASE`` over branch ids, so one narrow projection serves any
number of sources and types: no UDF, no per-source scan, no shuffle.

Expressions are produced as SQL text and handed to ``selectExpr`` a
projection at a time; Catalyst parses, optimizes and code-generates them.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from eventloom.functions.time import iso_to_millis_sql
from eventloom.functions.variant import (
    is_falsy_sql,
    json_literal_sql,
    pluck_sql,
    present_sql,
    sql_str,
    vget_sql,
)
from eventloom.plans.contract import (
    EXTRACTED_FIELDS,
    RESERVED_TAIL_NAMES,
    Contract,
    FieldRule,
)

ExprResolver = Callable[[str], "tuple[str, str]"]
TimestampLookup = Callable[[tuple], "tuple[str, str]"]


@dataclass(frozen=True)
class CompiledRule:
    value: str
    error: str
    can_fail: bool


def rule_key(rule: FieldRule) -> tuple:
    """Identity of a rule's computation (independent of the field name)."""
    return (rule.from_, rule.take, rule.as_, json.dumps(rule.default, sort_keys=True), rule.expression)


def compile_rule(
    rule: FieldRule,
    payload: str = "payload",
    resolve_expr: ExprResolver | None = None,
    timestamps: TimestampLookup | None = None,
) -> CompiledRule:
    """Precedence: expression > take > boolean > timestamp > plain path; then
    ``default`` (falsy coalesce) for everything but expressions.

    ``timestamps`` maps a path to precomputed ``(millis, error)`` columns
    (see :func:`eventloom.functions.time.with_iso_millis`); without it the ISO
    parse is inlined."""
    if rule.expression:
        if resolve_expr is None:
            raise ValueError("an expression rule needs an expression resolver")
        value, error = resolve_expr(rule.expression)
        return CompiledRule(value, error, error != "false")
    base = vget_sql(payload, rule.path)
    error = None
    if rule.take:
        value = f"to_variant_object({pluck_sql(payload, rule.take_path, rule.path)})"
    elif rule.as_ == "boolean":
        value = f"CAST({present_sql(base)} AS VARIANT)"
    elif rule.as_ == "timestamp":
        if timestamps is not None:
            ms, error = timestamps(rule.path)
        else:
            checked = iso_to_millis_sql(base)
            ms, error = checked.value, checked.error
        value = f"CAST({ms} AS VARIANT)"
    else:
        value = base
    if rule.default is not None:
        value = f"(CASE WHEN {is_falsy_sql(value)} THEN {json_literal_sql(rule.default)} ELSE {value} END)"
    return CompiledRule(value, error if error is not None else "false", error is not None)


@dataclass(frozen=True)
class Branch:
    bid: int
    source: str
    event_type: str | None  # None: fallback for types the contract does not declare
    rules: dict[str, FieldRule]

    @property
    def tail(self) -> list[str]:
        return [n for n in self.rules if n not in EXTRACTED_FIELDS]

    @property
    def always_fails(self) -> bool:
        """Rows of this branch can never form a normalized event: a required
        field is missing, or a tail field reuses an envelope name."""
        missing = any(f not in self.rules for f in EXTRACTED_FIELDS)
        clash = any(n in RESERVED_TAIL_NAMES for n in self.tail)
        return missing or clash


_SEP = "\u0001"


def in_list(col: str, ids) -> str:
    ids = sorted(ids)
    if len(ids) == 1:
        return f"{col} = {ids[0]}"
    return f"{col} IN ({', '.join(str(i) for i in ids)})"


class ContractPlan:
    """All branches of a set of contracts and the expressions that evaluate them."""

    def __init__(self, contracts: Mapping[str, Contract]):
        self.contracts = dict(contracts)
        branches: list[Branch] = []
        for src, contract in self.contracts.items():
            for t in contract.event_types:
                branches.append(Branch(len(branches), src, t, contract.rules_for(t)))
            branches.append(Branch(len(branches), src, None, contract.rules_for(None)))
        self.branches = branches
        self._compiled: dict[tuple, CompiledRule] = {}
        self._payload = "payload"
        self._resolve: ExprResolver | None = None
        self._timestamps: TimestampLookup | None = None
        self._precomputed: dict[tuple, str] = {}

    # -- routing -----------------------------------------------------------
    def branch_id_sql(self, source: str, event_type: str) -> str:
        """Branch of each row (NULL when the source has no contract): one
        literal-map lookup, however many sources and types there are."""
        typed = [b for b in self.branches if b.event_type is not None]
        fallback = [b for b in self.branches if b.event_type is None]
        fb_map = "map(" + ", ".join(f"{sql_str(b.source)}, {b.bid}" for b in fallback) + ")"
        fb = f"try_element_at({fb_map}, {source})"
        if not typed:
            return fb
        t_map = "map(" + ", ".join(f"{sql_str(b.source + _SEP + b.event_type)}, {b.bid}" for b in typed) + ")"
        return f"coalesce(try_element_at({t_map}, concat({source}, {sql_str(_SEP)}, {event_type})), {fb})"

    def sources(self) -> list[str]:
        return list(self.contracts)

    # -- rule evaluation ---------------------------------------------------
    def bind(
        self, payload: str, resolve_expr: ExprResolver | None, timestamps: TimestampLookup | None = None
    ) -> "ContractPlan":
        self._payload = payload
        self._resolve = resolve_expr
        self._timestamps = timestamps
        self._compiled = {}
        self._precomputed = {}
        return self

    def lambda_rules(self) -> list[FieldRule]:
        """Distinct rules whose expressions use lambda functions (``take``
        plucks, free expressions). Catalyst evaluates higher-order functions
        outside whole-stage code generation, so these are computed in a
        projection of their own and the other rules stay in fused code."""
        seen: dict[tuple, FieldRule] = {}
        for b in self.branches:
            for r in b.rules.values():
                if r.take or r.expression:
                    seen.setdefault(rule_key(r), r)
        return list(seen.values())

    def precompute(self, columns: dict[tuple, tuple[str, str]]) -> None:
        """Use already computed (value, error) columns for the given rules (by :func:`rule_key`)."""
        self._precomputed = dict(columns)
        self._compiled = {}

    def timestamp_paths(self) -> dict[tuple, list[int]]:
        """Distinct payload paths read by ``as: timestamp`` rules, with the branches that read them."""
        seen: dict[tuple, set[int]] = {}
        for b in self.branches:
            for r in b.rules.values():
                if r.as_ == "timestamp" and not r.take and not r.expression:
                    seen.setdefault(r.path, set()).add(b.bid)
        return {p: sorted(bids) for p, bids in seen.items()}

    def branches_of(self, rule: FieldRule) -> list[int]:
        """The branches that have a rule of this computation."""
        key = rule_key(rule)
        return sorted({b.bid for b in self.branches for r in b.rules.values() if rule_key(r) == key})

    def compiled(self, rule: FieldRule) -> CompiledRule:
        key = rule_key(rule)
        if key not in self._compiled:
            if key in self._precomputed:
                value, error = self._precomputed[key]
                self._compiled[key] = CompiledRule(value, error, error != "false")
            else:
                self._compiled[key] = compile_rule(rule, self._payload, self._resolve, self._timestamps)
        return self._compiled[key]

    def field_sql(self, name: str, branch: str) -> str:
        """VARIANT value of ``name`` for each row's branch (NULL where the
        branch does not declare the field). Branches sharing a rule share one arm."""
        groups: dict[tuple, tuple[FieldRule, list[int]]] = {}
        for b in self.branches:
            rule = b.rules.get(name)
            if rule is not None:
                groups.setdefault(rule_key(rule), (rule, []))[1].append(b.bid)
        if not groups:
            return "CAST(NULL AS VARIANT)"
        arms = " ".join(
            f"WHEN {in_list(branch, bids)} THEN {self.compiled(rule).value}" for rule, bids in groups.values()
        )
        return f"(CASE {arms} END)"

    def rule_error_sql(self, branch: str) -> str:
        """True when a rule that applies to the row's own branch fails, or the
        branch can never produce an event."""
        per_rule: dict[tuple, tuple[FieldRule, set[int]]] = {}
        for b in self.branches:
            for rule in b.rules.values():
                if self.compiled(rule).can_fail:
                    per_rule.setdefault(rule_key(rule), (rule, set()))[1].add(b.bid)
        terms = [f"({in_list(branch, bids)} AND {self.compiled(rule).error})" for rule, bids in per_rule.values()]
        doomed = [b.bid for b in self.branches if b.always_fails]
        if doomed:
            terms.append(f"({in_list(branch, doomed)})")
        if not terms:
            return "false"
        return "coalesce(" + " OR ".join(terms) + ", false)"

    def per_branch_sql(self, branch: str, build: Callable[[Branch], str]) -> str:
        """``CASE branch WHEN b THEN build(b) ... END``."""
        arms = " ".join(f"WHEN {b.bid} THEN {build(b)}" for b in self.branches)
        return f"(CASE {branch} {arms} END)"

    def all_fields(self) -> list[str]:
        names: dict[str, None] = {}
        for b in self.branches:
            names.update(dict.fromkeys(b.rules))
        return list(names)

    def tail_fields(self) -> list[str]:
        return [n for n in self.all_fields() if n not in EXTRACTED_FIELDS]
