"""API events derived from warehouse tables.

The landing zone of a real deployment holds API pages; these builders derive
the same shapes from the tables a Spark job can read, so the pipeline runs at
table scale: every row of the table becomes one event, with work growing with
the table. All builders are narrow projections (plus one bounded grouping per
page or order).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ISO_US = "\"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\""


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, as it is. (How many splits a scan has is the session's matter:
    ``spark.sql.files.maxPartitionBytes``, ``spark.sql.files.minPartitionNum``.)"""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def iso_z(ts: str) -> str:
    """SQL text: a TIMESTAMP_NTZ as ``yyyy-MM-ddTHH:mm:ss.ffffffZ``."""
    return f"concat(date_format({ts}, {ISO_US}), 'Z')"


SHOP_EVENT_FIELDS = {
    "id": "event_id",
    "type": "event_type",
    "actor": "named_struct('id', user_id, 'login', concat('user_', user_id))",
    "created_at": iso_z("ts"),
    "value": "value",
    "props": "parse_json(props)",
}


def shop_event_json(overrides: dict[str, str] | None = None, drop: tuple[str, ...] = ()) -> str:
    """SQL text of one shop API event as JSON, built from an ``events`` row;
    ``overrides`` replace or add top-level keys, ``drop`` removes keys."""
    fields = dict(SHOP_EVENT_FIELDS)
    fields.update(overrides or {})
    for k in drop:
        fields.pop(k, None)
    body = ", ".join(f"'{k}', {v}" for k, v in fields.items())
    return f"to_json(named_struct({body}), map('ignoreNullFields', 'false'))"


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` + ``lineitem`` -> one API event per order whose ``lines`` array
    holds the order's line items in line-number order (empty when it has none)."""
    li = read_table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "named_struct('l_linenumber', l_linenumber, 'l_partkey', l_partkey, 'l_quantity', l_quantity) AS line"
    )
    lines = li.groupBy("l_orderkey").agg(F.collect_list("line").alias("lines"))
    orders = read_table(spark, sf_dir, "orders")
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
    # structs sort by their first field, the line number
    lines_sql = "coalesce(sort_array(lines), array())"
    event = (
        "to_json(named_struct('id', o_orderkey, 'type', 'order', "
        "'actor', named_struct('id', o_custkey, 'login', concat('cust_', o_custkey)), "
        f"'created_at', {iso_z('o_orderdate')}, 'status', o_orderstatus, 'total', o_totalprice, "
        f"'lines', {lines_sql}))"
    )
    return joined.selectExpr("o_orderkey", f"{event} AS event")


# Each row becomes one of the declared GitHub event types, or PushEvent, which the
# GitHub contract doesn't declare (fallback branch): event_id modulo their number.
GITHUB_TYPES = (
    "WatchEvent", "IssueCommentEvent", "PullRequestEvent", "PullRequestReviewEvent", "PullRequestReviewCommentEvent",
    "CreateEvent", "DeleteEvent", "PublicEvent", "GollumEvent", "IssuesEvent", "MemberEvent", "PushEvent",
)


def _struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


def _github_payloads() -> dict[str, str]:
    """Event type -> SQL of its payload, from the columns of ``events``."""
    k = "CAST(get_json_object(props, '$.k') AS BIGINT)"
    iso = iso_z("ts")
    user = _struct(login="concat('user_', user_id)")
    stamps = {"created_at": iso, "updated_at": iso}
    labels = f"array({_struct(name=f'concat({chr(39)}k{chr(39)}, {k} % 3)')}, {_struct(name='concat(' + chr(39) + 'u' + chr(39) + ', user_id % 2)')})"
    issue = {"id": "event_id * 10", "number": k, "title": "concat('Issue ', event_id)", "state": "'open'", **stamps,
             "comments": k, "user": user, "labels": labels}
    linked = _struct(**issue, pull_request=_struct(url="concat('https://example.invalid/pr/', event_id)"))
    either = f"CASE WHEN event_id % 24 = 1 THEN to_variant_object({linked}) ELSE to_variant_object({_struct(**issue)}) END"
    comment = {"id": "event_id * 100", "body": "concat('comment ', event_id)", "user": user, **stamps}

    def side(ref: str, repo_id: str, repo: str) -> str:
        return _struct(ref=f"'{ref}'", sha=f"sha1(concat('{ref}', event_id))", repo=_struct(id=repo_id, name=repo))

    pull = _struct(id="event_id * 7", number="event_id", head=side("feature", "user_id", "concat('user_', user_id)"),
                   base=side("main", "user_id % 10", "'org/repo'"))
    review = _struct(id="event_id * 3", state="CASE WHEN event_id % 24 = 3 THEN 'approved' ELSE 'commented' END",
                     body="CAST(NULL AS STRING)", submitted_at=iso, user=user)
    on_line = _struct(**comment, path="concat('src/f', event_id % 9, '.py')", position=k, diff_hunk="'@@'",
                      commit_id="sha1(CAST(event_id AS STRING))")
    other = _struct(login="concat('user_', user_id + 1)")
    page = _struct(page_name="concat('P', i)", title="concat('Page ', i, ' of ', event_id)", summary="CAST(NULL AS STRING)",
                   action="'edited'", sha="sha1(concat(i, '/', event_id))")
    structs = {
        "WatchEvent": _struct(action="'started'"),
        "IssueCommentEvent": _struct(action="'created'", issue=either, comment=_struct(**comment)),
        "PullRequestEvent": _struct(action="'opened'", number="event_id", pull_request=pull, labels=f"array({_struct(name=chr(39) + 'buy' + chr(39))})"),
        "PullRequestReviewEvent": _struct(action="'submitted'", pull_request=pull, review=review),
        "PullRequestReviewCommentEvent": _struct(action="'created'", pull_request=pull, comment=on_line),
        "CreateEvent": _struct(ref="CAST(NULL AS STRING)", ref_type="'repository'", master_branch="'main'", description="CAST(NULL AS STRING)",
                               pusher_type="'user'", full_ref="'refs/heads/main'"),
        "DeleteEvent": _struct(ref="concat('branch-', event_id)", ref_type="'branch'", pusher_type="'user'"),
        "GollumEvent": _struct(pages=f"transform(sequence(0, CAST(event_id % 3 AS INT)), i -> {page})"),
        "IssuesEvent": _struct(action="'assigned'", issue=_struct(**issue, assignee=user, assignees=f"array({user}, {other})")),
        "MemberEvent": _struct(action="'added'", member=_struct(id="user_id + 1", login="concat('user_', user_id + 1)")),
        "PushEvent": _struct(size="1"),
    }
    return {t: f"to_variant_object({s})" for t, s in structs.items()} | {"PublicEvent": "parse_json('{}')"}


def github_event_json() -> str:
    """SQL text: one GitHub-shaped API event (JSON) per ``events`` row."""
    which = f"CAST(event_id % {len(GITHUB_TYPES)} AS INT)"
    payloads = _github_payloads()
    gh_type = f"element_at(array({', '.join(repr(t) for t in GITHUB_TYPES)}), {which} + 1)"
    payload = f"CASE {which} " + " ".join(f"WHEN {i} THEN {payloads[t]}" for i, t in enumerate(GITHUB_TYPES)) + " END"
    common = {"id": "CAST(event_id AS STRING)", "type": gh_type, "actor": _struct(id="user_id", login="concat('user_', user_id)"),
              "repo": _struct(id="user_id % 10", name="concat('org/repo-', user_id % 10)")}
    tail = {"public": "event_id % 2 = 0", "created_at": iso_z("ts"), "payload": payload}
    with_org = _struct(**common, org=_struct(id="1", login="'acme'"), **tail)
    keep_nulls = "map('ignoreNullFields', 'false')"
    return (f"CASE WHEN user_id % 2 = 0 THEN to_json({with_org}, {keep_nulls}) "
            f"ELSE to_json({_struct(**common, **tail)}, {keep_nulls}) END")


def github_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` -> (event_id, event) with ``event`` a GitHub-shaped API event as JSON."""
    return read_table(spark, sf_dir, "events").selectExpr("event_id", f"{github_event_json()} AS event")
