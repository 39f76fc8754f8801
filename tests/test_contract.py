"""Contract loading and validation."""

import pytest

from eventloom.plans.contract import Contract, ContractError, FieldRule, builtin_contracts, load_contracts

ENV = """
source: ferry
partition_key: {from: vessel.call_sign}
envelope:
  entity_id: {from: vessel.hull}
  entity_name: {from: vessel.call_sign}
  event_time: {from: logged, as: timestamp}
common: {}
event_types: {}
"""


def test_valid_rule_forms():
    r = FieldRule.parse({"from": "a.b.c", "take": "name", "as": "boolean", "default": [1]}, "x")
    assert r.path == ("a", "b", "c") and r.take_path == ("name",) and r.default == [1]
    assert FieldRule.parse({"expression": "payload:a", "as": "timestamp"}, "x").expression == "payload:a"


@pytest.mark.parametrize("rule", [
    {"from": "a", "as": "bool"},            # as must be boolean/timestamp
    {"from": "a."},                          # trailing dot
    {"from": ".a"},
    {"from": "a..b"},
    {},                                      # neither from nor expression
    {"from": "", "expression": ""},          # empty strings count as absent
    {"from": "a", "expression": "x"},        # both
    {"frm": "a"},                            # unknown key
    {"from": "a[0]"},                        # not an identifier path: use expression
    {"from": "a || b"},
    {"from": 5},
])
def test_invalid_rules(rule):
    with pytest.raises(ContractError):
        FieldRule.parse(rule, "rule")


def test_empty_take_is_ignored():
    assert FieldRule.parse({"from": "a", "take": ""}, "x").take is None


@pytest.mark.parametrize("missing", ["source", "partition_key", "envelope", "common", "event_types"])
def test_missing_sections(missing):
    import yaml
    doc = yaml.safe_load(ENV)
    doc.pop(missing)
    with pytest.raises(ContractError):
        Contract.parse(doc)


def test_empty_nested_rule_rejected():
    with pytest.raises(ContractError):
        Contract.from_yaml(ENV.replace("common: {}", "common:\n  x: {}"))


def test_declared_empty_type_is_legal():
    c = Contract.from_yaml(ENV.replace("event_types: {}", "event_types:\n  PublicEvent: {}"))
    assert c.event_types == {"PublicEvent": {}}


def test_section_overlay_order():
    c = Contract.from_yaml(ENV.replace("common: {}", "common:\n  entity_name: {from: type}\n  x: {from: a}")
                           .replace("event_types: {}", "event_types:\n  T:\n    x: {from: b}\n    partition_key: {from: c}"))
    rules = c.rules_for("T")
    assert list(rules) == ["partition_key", "entity_id", "entity_name", "event_time", "x"]
    assert rules["x"].from_ == "b" and rules["partition_key"].from_ == "c" and rules["entity_name"].from_ == "type"
    assert c.rules_for("Unknown")["x"].from_ == "a"


def test_repository_loads_by_file_stem(tmp_path):
    (tmp_path / "ferry.yml").write_text(ENV)
    (tmp_path / "notes.txt").write_text("ignored")
    assert list(load_contracts(tmp_path)) == ["ferry"]


def test_builtin_contracts():
    cs = builtin_contracts()
    assert {"github", "shop"} <= set(cs)
    gh = cs["github"]
    assert gh.partition_key.from_ == "repo.name"
    assert set(gh.event_types) == {
        "WatchEvent", "IssueCommentEvent", "PullRequestEvent", "PullRequestReviewEvent",
        "PullRequestReviewCommentEvent", "CreateEvent", "DeleteEvent", "PublicEvent", "GollumEvent",
        "IssuesEvent", "MemberEvent",
    }


def test_lint_and_column_types():
    c = Contract.from_yaml(ENV.replace("common: {}", "common:\n  source: {from: x}")
                           + "\ncolumn_types:\n  x: bigint\n")
    assert c.column_types == {"x": "bigint"}
    assert any("reuse envelope names" in w for w in c.lint())
    assert builtin_contracts()["github"].lint() == []
    with pytest.raises(ContractError):
        Contract.from_yaml(ENV + "\ncolumn_types: [1]\n")


def test_engine_has_no_source_specific_vocabulary():
    """Contracts carry all knowledge of a source; the engine names none."""
    import pathlib

    root = pathlib.Path(__file__).resolve().parent.parent / "eventloom"
    engine = [root / "plans" / "compiler.py", root / "plans" / "contract.py", root / "operators" / "normalize.py",
              root / "functions" / "variant.py", root / "functions" / "time.py"]
    for path in engine:
        text = path.read_text().lower()
        for word in ("github", "gitlab", "issue", "pull_request", "repo."):
            assert word not in text, (path.name, word)
