"""The rule language against a small Python model of its semantics, on random
nested payloads (paths, take, presence, falsy defaults)."""

import json
import random

import yaml
from event_helpers import envelope, values_df

from eventloom.operators.normalize import normalize
from eventloom.plans.contract import Contract

KEYS = ["a", "b", "c"]


def rand_value(rnd, depth):
    r = rnd.random()
    if depth <= 0 or r < 0.35:
        return rnd.choice([None, True, False, 0, 1, 2.5, "", "x", "y"])
    if r < 0.65:
        return {k: rand_value(rnd, depth - 1) for k in rnd.sample(KEYS, rnd.randint(0, 3))}
    return [rand_value(rnd, depth - 1) for _ in range(rnd.randint(0, 3))]


def model_get(v, path):
    for step in path:
        if not isinstance(v, dict) or step not in v:
            return None
        v = v[step]
    return v


def model_take(v, take):
    if not isinstance(v, list):
        return None
    flat = []
    for e in v:
        flat.extend(e if isinstance(e, list) else [e])
    picked = [model_get(e, take) for e in flat]
    return [p for p in picked if p is not None]


def falsy(v):
    return v is None or v is False or v == "" or (isinstance(v, (list, dict)) and len(v) == 0)


def model_rule(rule, payload):
    base = model_get(payload, rule["from"].split("."))
    if "take" in rule:
        out = model_take(base, rule["take"].split("."))
    elif rule.get("as") == "boolean":
        out = base is not None
    else:
        out = base
    if rule.get("default") is not None and falsy(out):
        out = rule["default"]
    return out


def rand_rule(rnd):
    path = ".".join(rnd.choice(KEYS) for _ in range(rnd.randint(1, 3)))
    rule = {"from": path}
    kind = rnd.random()
    if kind < 0.3:
        rule["take"] = ".".join(rnd.choice(KEYS) for _ in range(rnd.randint(1, 2)))
    elif kind < 0.5:
        rule["as"] = "boolean"
    if rnd.random() < 0.4:
        rule["default"] = rnd.choice(["d", 0, 7, [], {"k": 1}, ["z"], True])
    return rule


def same(a, b):
    if isinstance(a, float) or isinstance(b, float):
        return isinstance(a, (int, float)) and isinstance(b, (int, float)) and not isinstance(a, bool) \
            and not isinstance(b, bool) and float(a) == float(b)
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(same(x, y) for x, y in zip(a, b))
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(same(a[k], b[k]) for k in a)
    return type(a) is type(b) and a == b


def test_rules_match_the_model(spark):
    rnd = random.Random(5)
    rules = {f"r{i}": rand_rule(rnd) for i in range(24)}
    doc = {
        "source": "ferry",
        "partition_key": {"from": "pk"},
        "envelope": {"entity_id": {"from": "pk"}, "entity_name": {"from": "pk"}, "event_time": {"from": "t"}},
        "common": rules,
        "event_types": {},
    }
    contract = Contract.from_yaml(yaml.safe_dump(doc))
    payloads = []
    for _ in range(400):
        p = {k: rand_value(rnd, 3) for k in KEYS}
        p.update({"pk": "p", "t": 1})
        payloads.append(p)
    out = normalize(values_df(spark, [envelope(p) for p in payloads]), {"ferry": contract}, keep=["rid"])
    got = {r.rid: json.loads(r.attributes) for r in out.collect()}
    assert len(got) == len(payloads)
    bad, non_null = [], 0
    for i, p in enumerate(payloads):
        for name, rule in rules.items():
            want = model_rule(rule, p)
            non_null += want is not None
            if not same(got[i][name], want):
                bad.append((rule, p, got[i][name], want))
    assert not bad, bad[:5]
    # not a vacuous comparison: most rules resolve to something, every rule kind occurs
    assert non_null > 0.3 * len(payloads) * len(rules)
    assert {"take", "as", "default"} <= {k for r in rules.values() for k in r}
