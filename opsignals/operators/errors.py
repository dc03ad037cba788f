"""Errors with what surrounded them, grouped into issues and reduced for privacy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsignals.functions import fingerprint, pii, sqltext
from opsignals.functions.text import is_blank
from opsignals.operators.privacy import redact_fields
from opsignals.operators.running import SEGMENT, chained, running, time_segment
from opsignals.operators.traces import outermost
from opsignals.shipping import ship

# Fixed value.
FRAME = (
    r"\A[ \t\n\x0B\f\r]*+[0-9]++[ \t\n\x0B\f\r]++([^ \t\n\x0B\f\r]++)[ \t\n\x0B\f\r]++0x[0-9a-fA-F]++"
    r"[ \t\n\x0B\f\r]++(.+?)[ \t\n\x0B\f\r]+\+[ \t\n\x0B\f\r]++[0-9]++[ \t\n\x0B\f\r]*+\z"
)


def _is_empty_user(user: Column) -> Column:
    return user.isNull() | (
        user["id"].isNull() & user["email"].isNull() & user["username"].isNull()
    )


def user_asof(errors: DataFrame, set_user: DataFrame, *, segment: Column | None = None) -> DataFrame:
    """Each error with its own user, else the one last set on its thread before it.

    A setting is wrapped in a struct, so setting an empty user (clearing it) is a value the
    running ``last`` keeps. Both inputs: thread_id, seq, user; errors have occurred_at, set_user ts;
    ``segment`` is of occurred_at.
    """
    segment = time_segment("occurred_at") if segment is None else segment
    rows = errors.select("thread_id", "seq", "occurred_at", F.struct("*").alias("error"))
    settings = set_user.select("thread_id", "seq", F.col("ts").alias("occurred_at"), F.struct("user").alias("setting"))
    timeline = rows.unionByName(settings, allowMissingColumns=True)
    seen = running(
        timeline, ["thread_id"], ["occurred_at", "seq"], segment, {"current": ("last", F.col("setting"))}
    ).filter(F.col("error").isNotNull())
    own, current = F.col("error.user"), F.col("current.user")
    user = F.when(~_is_empty_user(own), own).when(~_is_empty_user(current), current)
    return seen.select(*[(user if c == "user" else F.col("error")[c]).alias(c) for c in errors.columns])


def _last(items: Column, n: int) -> Column:
    return F.slice(items, F.greatest(F.size(items) - (n - 1), F.lit(1)), F.lit(n))


def breadcrumb_trail(
    errors: DataFrame,
    breadcrumbs: DataFrame,
    *,
    limit: int,
    strict: bool = False,
    segment: Column | None = None,
) -> DataFrame:
    """Each error with the last ``limit`` breadcrumbs (clients keep 30) of its thread since the
    last clear, oldest first.

    A stretch of a thread is summed up by whether it clears and by its last ``limit`` crumbs since
    its last clear; earlier stretches combine into what an error's stretch starts with, so an error
    costs one list, however many others of its thread see the same crumbs. Only stretches with
    errors are given that list.

    ``breadcrumbs``: thread_id, seq, ts, op (add or clear), category, message, level, data;
    ``segment`` is of ts.
    """
    crumb_type = "struct<category:string,message:string,level:string,ts:string,data:map<string,string>>"
    columns = [c for c in errors.columns if c != "breadcrumbs"]
    if strict or limit <= 0:
        return errors.select(*columns, F.array().cast(f"array<{crumb_type}>").alias("breadcrumbs"))
    crumb = F.struct(
        "category", "message", "level", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"), "data"
    )
    steps = breadcrumbs.select(
        "thread_id", "seq", "ts", (F.col("op") == "clear").alias("clears"), F.when(F.col("op") == "add", crumb).alias("crumb")
    )
    asked = errors.select("thread_id", "seq", F.col("occurred_at").alias("ts"), F.struct("*").alias("error"))
    adds = F.col("__crumb").isNotNull().cast("long")
    clears = F.coalesce(F.col("__clears"), F.lit(False)).cast("long")

    # Of a stretch: crumbs that no clear follows and fewer than ``limit`` crumbs do.
    back = (
        Window.partitionBy("thread_id", SEGMENT).orderBy(F.desc("ts"), F.desc("seq")).rowsBetween(Window.unboundedPreceding, 0)
    )
    counts = adds.eqNullSafe(1) & (F.col("__clears_on") == 0) & (F.col("__adds_on") <= limit)
    held = F.collect_list(F.when(counts, F.struct(F.col("__adds_on").alias("back"), F.col("__crumb").alias("crumb"))))
    in_order = F.array_sort(held, lambda a, b: F.when(a["back"] > b["back"], -1).otherwise(1))
    # Of stretches that add or clear, each adds a crumb or ends what came before, so ``limit`` are enough.
    of_steps = Window.partitionBy("thread_id", "__steps").orderBy(SEGMENT).rowsBetween(-(limit - 1), 0)
    to_here = Window.partitionBy("thread_id").orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, 0)
    same_epoch = F.filter("__near", lambda x: x["epoch"] == F.col("__epoch"))
    # Since the last clear within a stretch, by the number of a crumb: errors after one crumb share a frame.
    epoch = Window.partitionBy("thread_id", SEGMENT, "__epoch").orderBy("__number")
    none = F.array().cast(f"array<{crumb_type}>")
    seen = chained(
        steps.unionByName(asked, allowMissingColumns=True),
        ["thread_id"], ["ts", "seq"], time_segment("ts") if segment is None else segment,
        {
            "__crumb": F.col("crumb"), "__clears": F.col("clears"), "__asks": F.col("error").isNotNull(),
            "__before": F.lit(None).cast(f"array<{crumb_type}>"),
        },
        local=[{"__clears_on": lambda *_: F.sum(clears).over(back), "__adds_on": lambda *_: F.sum(adds).over(back)}],
        summary={"clears": F.max(clears), "last": F.transform(in_order, lambda x: x["crumb"]), "asks": F.max("__asks")},
        carry=[
            {"__steps": lambda _: (F.col("__of_clears") > 0) | (F.size("__of_last") > 0)},
            {"__epoch": lambda _: F.sum("__of_clears").over(to_here)},
            {"__near": lambda _: F.collect_list(F.struct(F.col("__epoch").alias("epoch"), F.col("__of_last").alias("last"))).over(of_steps)},
            {"__after": lambda _: F.when(F.col("__steps"), _last(F.flatten(F.transform(same_epoch, lambda x: x["last"])), limit))},
            {"__passed": lambda w: F.last("__after", ignorenulls=True).over(w)},
            {"__before": lambda _: F.when(F.col("__of_asks"), F.col("__passed"))},
        ],
        final=[
            {"__epoch": lambda upto, _: F.coalesce(F.sum(clears).over(upto), F.lit(0)), "__number": lambda upto, _: F.sum(adds).over(upto)},
            {
                "__near": lambda *_: F.collect_list("__crumb").over(epoch.rangeBetween(-(limit - 1), 0)),
                "__passed": lambda *_: F.first("__before", ignorenulls=True).over(epoch.rangeBetween(Window.unboundedPreceding, 0)),
            },
        ],
    ).filter(F.col("error").isNotNull())
    trail = _last(F.concat(F.coalesce("__passed", none), "__near"), limit)
    return seen.select(*[F.col("error")[c].alias(c) for c in columns], trail.alias("breadcrumbs"))


def error_trace_asof(errors: DataFrame, traces: DataFrame, *, segment_minutes: int = 1) -> DataFrame:
    """Each error with the id of the trace open on its thread at that moment, else null.

    Without nested traces a thread has one trace open at a time, so the only candidate is the last
    outermost one: one timeline of traces and errors, in one pass. A trace that starts with the error
    is open for it.
    """
    # The caller's row travels as one column, so none of its names can clash.
    rows = errors.select(
        "thread_id", F.col("occurred_at").alias("at"), F.lit(True).alias("after"), "seq", F.struct("*").alias("error")
    )
    opens = traces.select(
        "thread_id", F.col("started_at").alias("at"), F.lit(False).alias("after"), "seq",
        "started_at", "ended_at", F.struct("trace_id", "ended_at").alias("opened"),
    )
    timeline = opens.unionByName(rows, allowMissingColumns=True)
    seen = outermost(timeline, ["at", "after", "seq"], time_segment("at", segment_minutes), F.col("opened")).filter("after")
    found = F.when(F.col("at") <= F.col("outer.ended_at"), F.col("outer.trace_id")).alias("trace_id")
    return seen.select(*[F.col("error")[c].alias(c) for c in errors.columns if c != "trace_id"], found)


def error_trace_link(errors: DataFrame, spans: DataFrame) -> DataFrame:
    """Per trace: its errors over all services, next to its spans. Both sides are reduced to one
    row per trace before they meet, so the join is one to one."""
    per_service = errors.filter(F.col("trace_id").isNotNull()).groupBy("trace_id", "service").agg(
        F.count(F.lit(1)).alias("n")
    )
    per_trace = per_service.groupBy("trace_id").agg(
        F.sum("n").alias("errors"), F.sort_array(F.collect_set("service")).alias("services")
    )
    totals = spans.groupBy("trace_id").agg(F.count(F.lit(1)).alias("spans"), F.sum("duration_ms").alias("total_ms"))
    return per_trace.join(totals, "trace_id", "left")


def issue_groups(errors: DataFrame, *, user: str = "user.id", lg_k: int | None = None) -> DataFrame:
    """Errors grouped by class and message fingerprint: events, distinct users, first and last
    seen, and the normalized message they share.

    ``lg_k`` counts users by a sketch of 2**lg_k cells, kept in ``users_sketch``: one aggregate and no
    row per user. Its standard error is 0.83 / sqrt(2**lg_k), 1.3 % for 12; small numbers are exact but
    for rare collisions. Groups of parts of the errors are added up by :func:`merge_issue_groups`; where the
    number must be exact, by :func:`merge_issue_users`.
    """
    if lg_k is not None:
        grouped = _normalized(errors, user).groupBy("exception_class", "sample").agg(
            F.count(F.lit(1)).alias("events"),
            F.hll_sketch_agg(F.col("user_id").cast("string"), lg_k).alias("users_sketch"),
            F.min("occurred_at").alias("first_seen"),
            F.max("occurred_at").alias("last_seen"),
        )
        return _with_fingerprint(grouped.withColumn("users", F.hll_sketch_estimate("users_sketch")))
    return _counted(issue_users(errors, user=user))


def _normalized(errors: DataFrame, user: str) -> DataFrame:
    return errors.select(
        "exception_class", fingerprint.normalize(F.col("message")).alias("sample"), F.col(user).alias("user_id"), "occurred_at"
    )


def issue_users(errors: DataFrame, *, user: str = "user.id") -> DataFrame:
    """A row per issue and user: events, first and last seen. Grouped by the text itself, which is what the
    fingerprint stands for, and by fixed-width sums, so the aggregate stays in its hash map."""
    return _normalized(errors, user).groupBy("exception_class", "sample", "user_id").agg(
        F.count(F.lit(1)).alias("events"), F.min("occurred_at").alias("first_seen"), F.max("occurred_at").alias("last_seen")
    )


def merge_issue_users(users: DataFrame) -> DataFrame:
    """Issues with exact numbers of users from :func:`issue_users` of parts of the errors (of days, hosts
    or regions): the same as :func:`issue_groups` of them all. A user of several parts is counted once."""
    per_user = users.groupBy("exception_class", "sample", "user_id").agg(
        F.sum("events").alias("events"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen")
    )
    return _counted(per_user)


def _counted(per_user: DataFrame) -> DataFrame:
    # Per user first: the distinct count then works on one row per user, and a hot issue is spread
    # over its users. One hash per issue.
    grouped = per_user.groupBy("exception_class", "sample").agg(
        F.sum("events").alias("events"),
        F.count("user_id").alias("users"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
    )
    return _with_fingerprint(grouped)


def _with_fingerprint(grouped: DataFrame) -> DataFrame:
    return grouped.withColumn("message_fingerprint", fingerprint.hash_normalized(F.col("sample")))


def merge_issue_groups(groups: DataFrame) -> DataFrame:
    """Groups with sketches (of days, hosts or regions) added up: the same as grouping all their
    errors at once with a sketch of that size. Messages are met by their fingerprints."""
    merged = groups.groupBy("exception_class", "message_fingerprint").agg(
        F.sum("events").alias("events"),
        F.hll_union_agg("users_sketch").alias("users_sketch"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.min("sample").alias("sample"),
    )
    return merged.withColumn("users", F.hll_sketch_estimate("users_sketch"))


def frame_rollup(
    errors: DataFrame, *, executable: str, text: str = "backtrace_text", max_lines: int | None = None
) -> DataFrame:
    """Errors per stack frame, from raw backtrace text: all its lines, or the first ``max_lines``
    (clients send 128), those that don't parse skipped, frames of ``executable`` flagged. Repeats within an error are removed in the
    row, so each line is parsed once and counting needs no distinct."""
    lines = F.split(F.col(text), "\n", -1)
    lines = F.array_distinct(lines if max_lines is None else F.slice(lines, 1, max_lines))
    frames = F.transform(
        F.filter(lines, lambda x: x.rlike(FRAME)),
        lambda x: F.struct(
            F.regexp_extract(x, FRAME, 1).alias("image"), F.regexp_extract(x, FRAME, 2).alias("symbol")
        ),
    )
    return (
        errors.select(F.inline(F.array_distinct(frames)))
        .groupBy("image", "symbol")
        .agg(F.count(F.lit(1)).alias("errors"))
        .withColumn("in_app", F.col("image") == executable)
    )


def nearest_statement(causes: Column, max_depth: int | None = None) -> Column:
    """Statement of the nearest cause that has one, its own or one quoted in its text. The error
    itself is followed by all its causes, or by ``max_depth`` of them."""
    found = F.transform(
        causes if max_depth is None else F.slice(causes, 1, max_depth + 1),
        lambda c: F.coalesce(F.nullif(c["statement"], F.lit("")), sqltext.statement_in_text(c["what"])),
    )
    return F.get(F.array_compact(found), F.lit(0))


def cause_chain_sql(errors: DataFrame) -> DataFrame:
    """Errors with the statement behind them; the chain is read in the row, without a shuffle."""
    return errors.withColumn("statement", nearest_statement(F.col("causes"))).filter(F.col("statement").isNotNull())


def _is_scalar(value: Column) -> Column:
    nested = value.rlike(r"\A[ \t\r\n]*+[\[{]") & (
        F.json_object_keys(value).isNotNull() | F.json_array_length(value).isNotNull()
    )
    return value.isNotNull() & ~nested


def _allowed(fields: Column, allowed) -> Column:
    if not allowed:
        return F.lit(None).cast("map<string,string>")
    kept = F.map_filter(fields, lambda k, v: k.isin(*allowed) & _is_scalar(v))
    return F.when(F.size(kept) > 0, kept)


def strict_event(errors: DataFrame, allowed=()) -> DataFrame:
    """Structured facts only: the message becomes its fingerprint, context and tags keep allowed
    keys with plain values, the user is an id, and free text is gone."""
    user_id = F.col("user.id")
    out = (
        errors.withColumn("message_fingerprint", fingerprint.fingerprint(F.coalesce("message", F.lit(""))))
        .withColumn("message", F.lit(""))
        .withColumn("context", _allowed(F.col("context"), allowed))
        .withColumn("tags", _allowed(F.col("tags"), allowed))
        .withColumn("user", F.when(~is_blank(user_id), F.struct(user_id.alias("id"))))
        .drop("breadcrumbs", "endpoint", "sql_statement")
    )
    if "backtrace" in errors.columns:
        fields = {f.name for f in errors.schema["backtrace"].dataType.elementType.fields}
        source = [f for f in ("context_line", "pre_context", "post_context") if f in fields]
        if source:
            out = out.withColumn("backtrace", F.transform("backtrace", lambda f: f.dropFields(*source)))
    return out


def event_assemble(
    errors: DataFrame,
    set_user: DataFrame,
    breadcrumbs: DataFrame,
    traces: DataFrame,
    *,
    max_breadcrumbs: int,
    sql_objects: bool = True,
    sql_statement: bool = False,
    redact: bool = True,
    strict: bool = False,
    allowed=(),
) -> DataFrame:
    """The full error row. Order matters: breadcrumbs and SQL are redacted with the rest, user
    and trace id are not, and the strict projection comes last, over everything."""
    if redact:
        # Before the lookups: a Python function can't stand inside an array of breadcrumbs, and a message is
        # redacted in compiled code there, once and not for every error that shows it.
        ship(errors.sparkSession)
        breadcrumbs = breadcrumbs.withColumns({"data": redact_fields(F.col("data")), "message": pii.redact(F.col("message"))})
    # The lookups run side by side on what identifies an error; the wide rows are shuffled once,
    # to meet the answers on the error's own id.
    narrow = errors.select("error_id", "thread_id", "seq", "occurred_at", "user")
    users = user_asof(narrow, set_user).select("error_id", "user")
    open_traces = error_trace_asof(narrow.drop("user"), traces).select("error_id", "trace_id")
    trails = breadcrumb_trail(narrow.drop("user"), breadcrumbs, limit=max_breadcrumbs, strict=strict)
    rows = (
        errors.drop("user", "trace_id")
        .join(users, "error_id")
        .join(open_traces, "error_id")
        .join(trails.select("error_id", "breadcrumbs"), "error_id")
    )
    statement = F.coalesce(F.nullif("statement", F.lit("")), nearest_statement(F.col("causes")))
    rows = rows.withColumn("sql_statement", sqltext.mask(statement))
    if sql_objects:
        rows = rows.withColumn("sql_objects", sqltext.objects(F.col("sql_statement")))
    if redact:
        rows = rows.withColumns(
            {
                "message": pii.redact(F.col("message")),
                "sql_statement": pii.redact(F.col("sql_statement")),
                "backtrace": F.transform(
                    "backtrace",
                    lambda f: f.withField("file", pii.redact(f["file"])).withField("method", pii.redact(f["method"])),
                ),
                "context": redact_fields(F.col("context")),
                "tags": redact_fields(F.col("tags")),
            }
        )
    if not sql_statement:
        rows = rows.drop("sql_statement")
    rows = rows.drop("statement", "causes")
    return strict_event(rows, allowed) if strict else rows
