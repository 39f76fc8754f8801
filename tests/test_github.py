"""The shipped GitHub contract over events derived from a table, one of every declared type and the fallback."""

import json

import pytest
from event_helpers import by_rid, envelope, values_df

from eventloom.operators.normalize import normalize
from eventloom.plans.contract import builtin_contracts
from eventloom.sources.tables import GITHUB_TYPES, github_event_json

GITHUB = builtin_contracts()["github"]


@pytest.fixture(scope="module")
def api(spark):
    """type -> API event (as a dictionary) from the builder that the flagship query uses; event ids 120..131."""
    rows = spark.range(120, 132).selectExpr("id AS event_id", "id % 2 AS user_id", "timestamp_ntz'2031-03-04 05:06:07' AS ts", "'{\"k\": 4}' AS props")
    return {e["type"]: e for e in (json.loads(r[0]) for r in rows.selectExpr(github_event_json()).collect())}


def run(spark, events):
    values = [envelope(e, source="github", event_id=e["id"], event_type=e["type"]) for e in events]
    return by_rid(normalize(values_df(spark, values), {"github": GITHUB}, keep=["rid"], with_reason=True))


def test_every_declared_type_has_exactly_its_fields(spark, api):
    assert set(api) == set(GITHUB_TYPES) and set(GITHUB.event_types) == set(GITHUB_TYPES) - {"PushEvent"}
    for kind, row in zip(api, run(spark, api.values()), strict=True):
        declared = [*GITHUB.common, *GITHUB.event_types.get(kind, {})]
        assert row["reason"] is None and list(row["attributes"]) == declared, kind


def without(event, *path):
    """A copy of an event that lacks what the path leads to."""
    copy = json.loads(json.dumps(event))
    at = copy
    for step in path[:-1]:
        at = at[step]
    at.pop(path[-1])
    return copy


@pytest.mark.parametrize("kind,path,field,value", [
    ("MemberEvent", ("payload", "member", "login"), "member_login", None), ("IssuesEvent", ("payload", "issue", "assignees"), "assignees", None),
    ("IssuesEvent", ("payload", "issue", "assignee"), "assignee_login", None), ("PullRequestEvent", ("payload", "labels"), "labels", None),
    ("GollumEvent", ("payload", "pages"), "pages", None), ("PullRequestReviewEvent", ("payload", "review", "submitted_at"), "review_submitted_at", None),
    ("WatchEvent", ("repo", "id"), "repo_id", None), ("WatchEvent", ("public",), "public", None),
])
def test_an_absent_input_is_null(spark, api, kind, path, field, value):
    row = run(spark, [without(api[kind], *path)])[0]
    assert row["reason"] is None and row["attributes"][field] == value


def test_values_across_types(spark, api):
    found = {k: r["attributes"] for k, r in zip(api, run(spark, api.values()), strict=True)}
    assert [p["title"] for p in found["GollumEvent"]["pages"]] == ["Page 0 of 128", "Page 1 of 128", "Page 2 of 128"]
    assert set(found["GollumEvent"]["pages"][0]) == {"page_name", "title", "summary", "action", "sha"}
    assert found["IssueCommentEvent"]["issue_is_pull_request"] is True and found["IssueCommentEvent"]["issue_labels"] == ["k1", "u1"]
    assert found["PullRequestReviewCommentEvent"]["comment_path"] == f"src/f{124 % 9}.py"
    assert "full_ref" not in found["CreateEvent"]


def test_odd_pages_are_no_error(spark, api):
    event = api["GollumEvent"]
    odd = [event | {"payload": {"pages": p}} for p in ("text", {}, [], [None, {"title": "t"}, [{"title": "u"}]])]
    rows = run(spark, odd)
    assert [r["reason"] for r in rows] == [None] * 4
    titles = [None if r["attributes"]["pages"] is None else [p["title"] for p in r["attributes"]["pages"]] for r in rows]
    assert titles == [None, None, [], ["t", "u"]]


def test_rows_that_cannot_be_normalized(spark, api):
    watch = api["WatchEvent"]
    rows = run(spark, [watch | {"created_at": "later"}, without(watch, "repo", "name"), without(watch, "actor", "login"), without(watch, "actor", "id")])
    assert [r["reason"] for r in rows] == ["normalize_error"] * 3 + [None] and rows[3]["entity_id"] == "None"


def test_wide_columns_have_the_declared_types(spark, api):
    out = normalize(values_df(spark, [envelope(api["IssuesEvent"], source="github", event_type="IssuesEvent")]), {"github": GITHUB}, output="wide")
    kinds = dict(out.dtypes)
    assert {n: kinds[n] for n in GITHUB.column_types} == GITHUB.column_types and kinds["pages"] == "variant"
    assert out.first()["assignees"] == ["user_1", "user_2"]
