"""Span trees rebuilt, cleaned, capped, filtered and stitched across services."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsignals.functions import hosts, routes, sqltext, traceparent
from opsignals.functions.text import ascii_lower, ascii_trim
from opsignals.operators.running import SEGMENT, chained, first_n, sequence_segment, time_segment

# Fixed values.
KINDS = ("controller", "service", "database", "redis", "http", "job", "other")
THRESHOLD_MS = 1000.0
STATEMENT, SYSTEM = "db.statement", "db.system"

_BEFORE_ALL = -(2**62)
# A task takes whole traces whose bucket of hashes has so many events, or so many times the average.
_WHOLE, _TIMES, _BUCKETS = 1_000_000, 8, 2**16


_TRACE_SEGMENT = ["trace_id", SEGMENT]


def _early_closes(events: DataFrame, segment: Column) -> DataFrame:
    """For each segment of a trace: the spans opened or closed in it whose only close comes before their
    only opening, each with the segment of its close. Only ids and numbers are shuffled for it."""
    op = F.col("op")
    ends = events.filter(op.isin("open", "close") & F.col("span_id").isNotNull()).select("trace_id", "span_id", "seq", segment.alias(SEGMENT), (op == "open").alias("opens"))
    opened, closed = (F.when(c, F.col("seq")) for c in (F.col("opens"), ~F.col("opens")))
    early = (
        ends.groupBy("trace_id", "span_id")
        .agg(
            F.count(opened).alias("openings"), F.count(closed).alias("closes"), F.min(opened).alias("opened"), F.max(closed).alias("closed"),
            F.min(F.when(F.col("opens"), F.col(SEGMENT))).alias("there"), F.max(F.when(~F.col("opens"), F.col(SEGMENT))).alias("home"),
        )
        .filter("openings = 1 AND closes = 1 AND closed < opened")
    )
    placed = early.select("trace_id", "span_id", "home", F.explode(F.array_distinct(F.array("there", "home"))).alias(SEGMENT))
    return placed.groupBy(*_TRACE_SEGMENT).agg(F.map_from_entries(F.collect_list(F.struct("span_id", "home"))).alias("early"))


def _stepped(events: DataFrame, segment: Column, columns: list[str]) -> DataFrame:
    """Events by segment, with the depth before them and after them as the segment alone tells, the level
    they stand on (an opening) or ask about (a leaf, a close: that of their parent), how many spans the
    segment recorded up to them, and the span last opened on that level before them, if it was here.

    ``home`` is the segment of the close of a span that was closed before it was opened: neither end
    changes the depth, and the opening asks for the close.
    """
    op, home = F.col("op"), F.col("home")
    before = Window.partitionBy(*_TRACE_SEGMENT).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    delta = F.when(home.isNotNull(), 0).when(op == "open", 1).when(op == "close", -1).otherwise(0).cast("long")
    records = op.isin("close", "leaf").cast("long")
    rows = events.filter(op.isin("open", "close", "leaf")).select(*columns, segment.alias(SEGMENT))
    rows = rows.join(_early_closes(events, segment), _TRACE_SEGMENT, "left")
    rows = rows.withColumn("home", F.when(op != "leaf", F.try_element_at("early", F.col("span_id")))).drop("early")
    rows = rows.withColumn("delta", delta)
    depth = F.coalesce(F.sum("delta").over(before), F.lit(0))
    recorded = F.sum(records).over(before.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.select("*", depth.alias("depth"), recorded.alias("recorded"))
    # An opening raises the level it stands on; a close asks about the level under the one it leaves.
    rows = rows.withColumn("level", F.col("depth") + F.col("delta"))
    on_level = Window.partitionBy(*_TRACE_SEGMENT, "level").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.when(F.col("delta") == 1, F.col("span_id"))
    return rows.withColumn("local", F.last(opened, ignorenulls=True).over(on_level))


def _along_traces(events: DataFrame, roots: DataFrame, segment: Column) -> DataFrame:
    """For each segment of a trace: the spans recorded before it, the spans that earlier segments left
    open on the levels it asks about, the parents of spans it closed before they were opened, and the
    trace's root.

    A segment is summed up by the change of depth, what it records, the spans it leaves open and the
    levels it asks earlier ones about: a row per segment, which is all that is shuffled by trace.
    """
    op, home, nobody = F.col("op"), F.col("home"), F.lit(None).cast("string")
    rest = Window.partitionBy(*_TRACE_SEGMENT).orderBy("seq").rowsBetween(0, Window.unboundedFollowing)
    steps = _stepped(events, segment, ["trace_id", "seq", "op", "span_id"])
    left_open = (F.col("delta") == 1) & (F.min(F.col("depth") + F.col("delta")).over(rest) >= F.col("level"))
    summaries = (
        steps.withColumn("left_open", left_open)
        .groupBy(*_TRACE_SEGMENT)
        .agg(
            F.sum("delta").alias("delta"),
            F.max("recorded").alias("records"),
            F.collect_list(F.when(F.col("left_open"), F.struct("level", "span_id"))).alias("offers"),
            F.collect_set(F.when((op != "open") & home.isNull() & F.col("local").isNull(), F.struct("level", nobody.alias("span_id")))).alias("asks"),
            F.collect_list(
                F.when((op == "open") & home.isNotNull(), F.struct("level", nobody.alias("span_id"), "home", F.col("span_id").alias("late"), "local"))
            ).alias("late"),
        )
    )
    root_rows = roots.select(
        "trace_id", F.lit(_BEFORE_ALL).cast("long").alias(SEGMENT), F.struct("span_id", "duration_ms").alias("root")
    )
    earlier = Window.partitionBy("trace_id").orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    placed = summaries.unionByName(root_rows, allowMissingColumns=True).select(
        *_TRACE_SEGMENT, "offers", "asks", "late",
        F.coalesce(F.sum("delta").over(earlier), F.lit(0)).alias("before"),
        F.coalesce(F.sum("records").over(earlier), F.lit(0)).alias("recorded_before"),
        F.max("root").over(earlier).alias("root"),
    )
    # Level 0 is the root's; most traces have one segment, which asks about no other. A row of each
    # segment is its own; an early close hears where it was, on the level of its opening.
    entry = "struct<level:bigint,span_id:string,home:bigint,late:string,local:string>"

    def entries(name: str) -> Column:
        given = ("level", "span_id", "home", "late", "local") if name == "late" else ("level", "span_id")
        full = lambda x: F.struct(*[(x[c] if c in given else F.lit(None)).alias(c) for c in ("level", "span_id", "home", "late", "local")])
        return F.transform(name, full).cast(f"array<{entry}>")

    asked = F.filter(F.concat(*map(entries, ("offers", "asks", "late"))), lambda x: (F.col("before") + x["level"] > 0) | x["local"].isNotNull())
    levels = placed.filter("offers IS NOT NULL").select(
        *_TRACE_SEGMENT, "before", "recorded_before", "root", F.inline(F.concat(asked, F.array(F.lit(None).cast(entry))))
    )
    on_level = Window.partitionBy("trace_id", F.col("before") + F.col("level")).orderBy(SEGMENT, F.col("span_id").isNotNull())
    open_there = F.last("span_id", ignorenulls=True).over(on_level.rowsBetween(Window.unboundedPreceding, -1))
    late = F.col("late")
    parent = F.coalesce("local", "open")
    answer = F.when(late.isNull() & F.col("span_id").isNull() & F.col("open").isNotNull(), F.struct("level", "open"))
    own = F.when(late.isNull(), F.struct("recorded_before", "root"))
    return (
        levels.withColumn("open", open_there)
        .withColumn(SEGMENT, F.coalesce("home", SEGMENT))
        .groupBy(*_TRACE_SEGMENT)
        .agg(
            F.map_from_entries(F.collect_list(answer)).alias("open"),
            F.map_from_entries(F.collect_list(F.when(late.isNotNull() & parent.isNotNull(), F.struct("late", parent)))).alias("late"),
            F.first(own, ignorenulls=True).alias("own"),
        )
        .select(*_TRACE_SEGMENT, "open", "late", "own.*")
    )


def _is_long(events: DataFrame, whole: int | None) -> Column:
    """Whether a row's trace may be too long for one task. Events are counted per bucket of hashed ids, so
    this shuffles as many rows as there are buckets, however many traces; it is one value to the plan."""
    bucket = F.pmod(F.xxhash64("trace_id"), F.lit(_BUCKETS)).cast("int")
    counts = events.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("all", F.sum("n").over(Window.partitionBy(F.lit(0))))
    most = F.greatest(F.lit(_WHOLE), F.col("all") * _TIMES / _BUCKETS) if whole is None else F.lit(whole)
    long = counts.filter(F.col("n") > most).agg(F.collect_list("bucket").alias("long"))
    flags = long.select(F.transform(F.sequence(F.lit(0), F.lit(_BUCKETS - 1)), lambda b: F.array_contains("long", b)))
    return F.get(flags.scalar(), bucket)


def _whole_spans(events: DataFrame, roots: DataFrame, facts: list[str], cap: int | None, threshold_ms: float | None) -> DataFrame:
    """Recorded spans with their parents, each trace by one task: rows are shuffled once, with the trace's
    root among them, and all windows are over that. An opening takes no facts along.

    A span closed before it was opened is recorded by its opening, which takes over the facts of the close.
    """
    op, step, at = F.col("op"), F.col("step"), F.col("at")
    # In one segment, so that the key is that of traces in several. A root has no step and comes first.
    whole = ["trace_id", F.lit(0).cast("long").alias(SEGMENT), "span_id"]
    change = F.when(op == "open", 1).when(op == "close", -1).otherwise(0)
    others = [c for c in facts if c != "seq"]
    rows = events.select(*whole, change.alias("step"), F.col("seq").alias("at"), *[F.when(op != "open", F.col(c)).alias(c) for c in others])
    root = F.struct("span_id", *(["duration_ms"] if threshold_ms is not None else []))
    rows = rows.unionByName(roots.select(*whole, root.alias("root")), allowMissingColumns=True)
    rows = rows.repartition(*_TRACE_SEGMENT)  # else the first window, of spans, would have an exchange of its own

    ends = Window.partitionBy(*_TRACE_SEGMENT, "span_id")
    opened, closed = (F.when(step == n, at) for n in (1, -1))
    once = (F.count(opened).over(ends) == 1) & (F.count(closed).over(ends) == 1)
    early = F.col("span_id").isNotNull() & once & (F.max(closed).over(ends) < F.min(opened).over(ends))
    rows = rows.withColumns({"early": early, "seq": F.max(closed).over(ends)})
    late = F.col("early") & (step == 1)
    taken = {c: F.first(F.when(step == -1, F.col(c)), ignorenulls=True).over(ends) for c in others}
    rows = rows.withColumns({c: F.when(late, value).otherwise(F.col(c)) for c, value in taken.items()})
    rows = rows.filter(~(F.col("early") & step.eqNullSafe(-1)))
    rows = rows.withColumns({"seq": F.when(late, F.col("seq")).otherwise(at), "step": F.when(late, 0).otherwise(step)}).drop("early")

    order = ["at", F.desc_nulls_first("step")]
    upto = Window.partitionBy(*_TRACE_SEGMENT).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # An opening raises the level it stands on; a close asks about the level under the one it leaves.
    depth = F.coalesce(F.sum("step").over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumns({"level": depth + step, "root": F.max("root").over(upto)}).filter(step.isNotNull())
    if threshold_ms is not None:
        rows = rows.filter(F.col("root.duration_ms") >= threshold_ms)
    rows = rows.withColumn("root", F.col("root.span_id"))
    on_level = Window.partitionBy(*_TRACE_SEGMENT, "level").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    open_there = F.last(F.when(step == 1, F.col("span_id")), ignorenulls=True).over(on_level)
    spans = rows.withColumn("parent_span_id", F.coalesce(open_there, "root")).filter(step <= 0)
    if cap is not None:
        number = F.row_number().over(Window.partitionBy(*_TRACE_SEGMENT).orderBy("seq"))
        spans = spans.withColumn("number", number).filter(F.col("number") < cap)
    return spans.select("trace_id", "span_id", "parent_span_id", *facts)


def _split_spans(
    events: DataFrame, roots: DataFrame, facts: list[str], segment: Column, cap: int | None, threshold_ms: float | None
) -> DataFrame:
    """The same with each segment of a trace by one task."""
    rows = _stepped(events, segment, ["trace_id", "op", "span_id", *facts]).filter("op <> 'open'")
    spans = rows.join(_along_traces(events, roots, segment), _TRACE_SEGMENT)
    if threshold_ms is not None:
        spans = spans.filter(F.col("root.duration_ms") >= threshold_ms)
    if cap is not None:
        spans = spans.filter(F.col("recorded_before") + F.col("recorded") < cap)
    found = F.coalesce("local", F.try_element_at("open", F.col("level")))
    found = F.when(F.col("home").isNull(), found).otherwise(F.try_element_at("late", F.col("span_id")))
    parent = F.coalesce(found, "root.span_id")
    return spans.select("trace_id", "span_id", parent.alias("parent_span_id"), *facts)


def _trees(
    events: DataFrame, roots: DataFrame, segment: Column | None, whole: int | None, cap: int | None, threshold_ms: float | None
) -> DataFrame:
    # Events without a number come before all others, here and in a whole trace.
    segment = F.coalesce(sequence_segment("seq") if segment is None else segment, F.lit(_BEFORE_ALL + 1))
    extra = [c for c in ("data",) if c in events.columns]
    facts = ["name", "kind", "started_at", "duration_ms", "seq", *extra]
    events = events.filter(F.col("op").isin("open", "close", "leaf") & F.col("trace_id").isNotNull())
    traced = roots.filter(F.col("trace_id").isNotNull())
    long = _is_long(events, whole)
    spans = _whole_spans(events.filter(~long), traced.filter(~long), facts, cap, threshold_ms).unionByName(
        _split_spans(events.filter(long), traced.filter(long), facts, segment, cap, threshold_ms)
    )
    if threshold_ms is not None:
        roots = roots.filter(F.col("duration_ms") >= threshold_ms)
    root_spans = roots.select(
        "trace_id", "span_id", traceparent.parse(F.col("traceparent"))["parent_span_id"].alias("parent_span_id"),
        "name", F.lit("controller").alias("kind"), "started_at", "duration_ms", F.lit(_BEFORE_ALL).cast("long").alias("seq"),
        *[F.create_map().cast("map<string,string>").alias(c) for c in extra], F.lit(True).alias("is_root"),
    )
    return spans.withColumn("is_root", F.lit(False)).unionByName(root_spans)


def span_tree(events: DataFrame, roots: DataFrame, *, segment: Column | None = None, whole: int | None = None) -> DataFrame:
    """Recorded spans with their parents, from ``open``, ``close`` and ``leaf`` events.

    A leaf's parent is the span open when it came, else the root. Spans close in reverse order of
    opening, so a close's parent is the span that is open beneath the one it closes. A span that never
    closes is none; a close whose opening was lost counts as closing the innermost open span. A close
    that comes before its own opening closes nothing and that opening opens nothing: the span is recorded
    at the close, under the one that is open at the opening. Rows without trace_id are left out.

    Traces are matched whole, and rows shuffled once. Only where a bucket of traces has more than
    ``whole`` events (a million or eight times the average) are their segments matched side by side, so a
    trace of any length is spread over tasks.

    ``events``: trace_id, seq, op, span_id, name, kind, started_at, duration_ms and, if there is, data.
    ``roots``: trace_id, span_id, traceparent, name, started_at, duration_ms.
    """
    return _trees(events, roots, segment, whole, None, None)


def captured_traces(
    events: DataFrame, roots: DataFrame, *, cap: int, threshold_ms: float = THRESHOLD_MS, strict: bool = False, segment: Column | None = None,
    whole: int | None = None,
) -> DataFrame:
    """:func:`span_tree`, :func:`trace_capture`, :func:`span_cap` and :func:`span_normalize` as one job.

    Whether a trace's root is slow comes with its rows, and to the segments of a long one with their
    depth and how many spans were recorded before them, so all four rest on the same exchanges. Names
    and statements are cleaned in what is left. Inputs as for :func:`span_tree`.
    """
    if "data" not in events.columns:
        events = events.withColumn("data", F.create_map().cast("map<string,string>"))
    return span_normalize(_trees(events, roots, segment, whole, cap, threshold_ms), strict=strict)


def _database_data(data: Column) -> Column:
    system = ascii_lower(ascii_trim(data[SYSTEM], " \t\r\n"))
    system = F.when(system != "", system)
    masked = sqltext.mask(data[STATEMENT], system)
    rewritten = F.transform_values(
        data, lambda k, v: F.when(k == SYSTEM, system).when(k == STATEMENT, masked).otherwise(v)
    )
    return F.map_filter(rewritten, lambda k, v: ~k.isin(SYSTEM, STATEMENT) | v.isNotNull())


def span_normalize(spans: DataFrame, *, strict: bool = False) -> DataFrame:
    """Kinds outside the known seven become ``other``, durations are rounded to two decimals,
    statements of database spans are masked. ``strict`` also reduces names and data."""
    raw_kind, data = F.col("kind"), F.col("data")
    cleaned = F.when(raw_kind == "database", _database_data(data)).otherwise(data)
    name = F.col("name")
    if strict:
        cleaned = F.map_filter(cleaned, lambda k, _: k.isin(STATEMENT, SYSTEM))
        name = routes.strict_name(name)
    return spans.withColumns(
        {
            "name": name,
            "kind": F.when(raw_kind.isin(*KINDS), raw_kind).otherwise("other"),
            "duration_ms": F.round(F.col("duration_ms") * 100) / 100,
            "data": F.coalesce(cleaned, F.create_map().cast("map<string,string>")),
        }
    )


def span_cap(spans: DataFrame, *, cap: int) -> DataFrame:
    """At most ``cap`` spans per trace: the root, then the first ones recorded."""
    children = first_n(spans.filter(~F.col("is_root")), ["trace_id"], ["seq", "span_id"], cap - 1)
    return spans.filter("is_root").unionByName(children)


def trace_capture(spans: DataFrame, *, threshold_ms: float = THRESHOLD_MS, enabled: bool = True) -> DataFrame:
    """All spans of the traces whose root took at least the threshold: one semi join."""
    if not enabled:
        return spans.limit(0)
    slow = spans.filter(F.col("is_root") & (F.col("duration_ms") >= threshold_ms)).select("trace_id")
    return spans.join(slow, "trace_id", "left_semi")


def trace_breakdown(spans: DataFrame) -> DataFrame:
    """Time and span count per trace and kind."""
    return spans.groupBy("trace_id", "kind").agg(
        F.count(F.lit(1)).alias("spans"), F.sum("duration_ms").alias("total_ms")
    )


_TRACE_ORDER = ["started_at", "seq"]


def outermost(timeline: DataFrame, order: list[str], segment: Column, what: Column) -> DataFrame:
    """A thread's timeline with ``is_nested`` (an earlier trace was still open) and ``outer``, ``what``
    of the last trace so far that isn't nested. Rows without ``started_at`` are no traces.

    A stretch of traces is summed up by its latest end and its last trace that none of the stretch
    encloses. That one is outermost if no earlier stretch reaches beyond its start, and if one does,
    that one encloses all others of the stretch too, which started before.
    """
    started, end = F.col("__started"), F.col("__ended")

    def nested(_, before) -> Column:
        return F.coalesce(started < F.max(end).over(before), F.lit(False))

    begun = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], started.alias("started"), F.col("__what").alias("what"))
    return chained(
        timeline, ["thread_id"], order, segment,
        {"__started": F.col("started_at"), "__ended": F.col("ended_at"), "__what": what},
        local=[
            {"__nested": nested},
            {"__begun": lambda *_: F.when(started.isNotNull() & ~F.col("__nested"), begun)},
        ],
        summary={"until": F.max("__ended"), "begun": F.max("__begun")},
        carry=[
            {"__ended": lambda w: F.max("__of_until").over(w)},
            {"__at": lambda _: F.when(~F.coalesce(F.col("__of_begun.started") < end, F.lit(False)), F.col("__of_begun.what"))},
            {"__what": lambda w: F.last("__at", ignorenulls=True).over(w)},
        ],
        final=[
            {"is_nested": nested},
            {
                "outer": lambda upto, _: F.last(
                    F.when(F.col("is_carry") | (started.isNotNull() & ~F.col("is_nested")), F.col("__what")), ignorenulls=True
                ).over(upto)
            },
        ],
    )


def trace_collapse(traces: DataFrame, *, segment: Column | None = None) -> DataFrame:
    """A trace opened while another is open on its thread becomes a ``service`` span of the
    outer one, which keeps its id; a header that came with the inner one is ignored.

    ``traces``: thread_id, seq, trace_id, root_name, traceparent, started_at, ended_at.
    """
    segment = time_segment("started_at") if segment is None else segment
    return (
        outermost(traces, _TRACE_ORDER, segment, F.col("trace_id"))
        .withColumn("kind", F.when(F.col("is_nested"), "service").otherwise("controller"))
        .withColumn("traceparent", F.when(~F.col("is_nested"), F.col("traceparent")))
        .withColumnRenamed("trace_id", "own_trace_id")
        .withColumnRenamed("outer", "trace_id")
    )


def traceparent_stitch(roots: DataFrame, spans: DataFrame) -> DataFrame:
    """Each root with the trace it belongs to and the span that called it. A header that can't
    be used leaves the root in the fresh trace it came with.

    ``roots``: trace_id, span_id, name, service, traceparent. ``spans``: the calling side.
    """
    header = traceparent.parse(F.col("traceparent"))
    placed = roots.select(
        F.coalesce(header["trace_id"], F.col("trace_id")).alias("trace_id"),
        "span_id",
        "name",
        "service",
        header["parent_span_id"].alias("parent_span_id"),
    )
    callers = spans.select(
        "trace_id",
        F.col("span_id").alias("parent_span_id"),
        F.col("name").alias("caller_name"),
        F.col("service").alias("caller_service"),
    )
    return placed.join(callers, ["trace_id", "parent_span_id"], "left")


def outbound_calls(calls: DataFrame) -> DataFrame:
    """HTTP calls per method and host with their total time; never a path or query."""
    return (
        calls.groupBy(hosts.call_name(F.col("method"), F.col("url")).alias("call"))
        .agg(F.count(F.lit(1)).alias("calls"), F.sum("duration_ms").alias("total_ms"))
    )


_GRAM = 3
# Patterns that no text is known to be needed for are tried on every host, so many to a row.
_TOGETHER, _BLOCKS = 64, 16
_CUT = "\u0001"


def _needed_grams(pattern: Column) -> Column:
    """Three-character texts that whatever a regex finds must hold; empty where none is sure.

    What may be absent or stands for several texts is cut out: character classes, groups, and every
    character that a quantifier other than + follows. A regex that still has alternatives, nested
    groups, flags, lookarounds or unusual escapes then has none.
    """
    quantified = r"(?:[?*]|\{[0-9,]*\})[?+]?"
    text = pattern
    for find, put in (
        (r"\\[dDwWsS]", "."),  # stands for one character of several
        (r"\[\^?[^\[\]\\]+\](?:" + quantified + r"|\+[?+]?)?", _CUT),
        (r"\((?:\?:)?[^()?\[\]\\]*\)(?:" + quantified + r"|\+[?+]?)?", _CUT),
        (r"(?:\\[.\-/]|[^\\])" + quantified, _CUT),
        (r"\+[?+]?", _CUT),
        (r"\\\.", "\u0002"),
        (r"\\([\-/])", "$1"),
        (r"[.^$]", _CUT),
        ("\u0002", "."),
    ):
        text = F.regexp_replace(text, find, put)
    grams = F.flatten(
        F.transform(
            F.filter(F.split(text, _CUT), lambda run: F.length(run) >= _GRAM),
            lambda run: F.transform(F.sequence(F.lit(1), F.length(run) - (_GRAM - 1)), lambda i: F.substr(run, i, F.lit(_GRAM))),
        )
    )
    # Uppercase text is in no lowercased host; flags could make it match, and they are left over then.
    odd = text.rlike(r"[\\()\[\]{}|?*+]") | F.contains(pattern, F.lit("\\\\"))
    return F.when(odd, F.array().cast("array<string>")).otherwise(grams)


def _host_grams(host: Column) -> Column:
    last = F.length(host) - (_GRAM - 1)
    return F.when(last >= 1, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substr(host, i, F.lit(_GRAM)))))


def _matched_hosts(hosts_: DataFrame, patterns: DataFrame) -> DataFrame:
    """The hosts (host) that any of the patterns (pattern) is found in.

    A pattern is filed under the rarest of the texts it needs, so it meets only hosts that hold that
    text, in an equality join, and one whose texts no host holds meets none. Patterns that need
    no text are joined to regexes of several alternatives and tried on every host, in blocks.
    """
    keyed = patterns.distinct().withColumn("grams", _needed_grams(F.col("pattern")))
    held = hosts_.select("host", F.explode(_host_grams(F.col("host"))).alias("gram"))
    often = held.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    needed = keyed.filter(F.size("grams") > 0).select("pattern", F.size(F.array_distinct("grams")).alias("needs"), F.explode(F.array_distinct("grams")).alias("gram"))
    # A text that no host holds leaves its pattern with fewer than it needs.
    filed = (
        needed.join(often, "gram")
        .groupBy("pattern")
        .agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"), F.count(F.lit(1)).alias("found"), F.max("needs").alias("needs"))
        .filter("found = needs")
    )
    indexed = held.join(filed.select("gram", "pattern"), "gram").filter(F.rlike("host", F.col("pattern"))).select("host")

    free = keyed.filter(F.size("grams") == 0)
    # A reference to a group, or a named one, would change its meaning inside another regex.
    alone = F.col("pattern").rlike(r"\\[1-9kQ]|\(\?<[a-zA-Z]")
    block = F.pmod(F.xxhash64("pattern"), F.lit(_BLOCKS))
    number = F.row_number().over(Window.partitionBy(block).orderBy("pattern"))
    at = F.when(alone, -number).otherwise(F.floor(number / _TOGETHER))
    grouped = (
        free.select("pattern", block.alias("block"), at.alias("at"))
        .groupBy("block", "at")
        .agg(F.array_join(F.transform(F.collect_list("pattern"), lambda p: F.concat(F.lit("(?:"), p, F.lit(")"))), "|").alias("pattern"))
    )
    blocks = hosts_.select("host", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(_BLOCKS - 1).cast("long"))).alias("block"))
    tried = blocks.join(grouped, "block").filter(F.rlike("host", F.col("pattern"))).select("host")
    return indexed.unionByName(tried).distinct()


def propagation_audit(
    calls: DataFrame, targets: DataFrame | list[str] | None = None, patterns: list[str] = (), *, enabled: bool = True
) -> DataFrame:
    """Calls per host, and whether a trace header goes there.

    No targets means everywhere, an empty list or table nowhere. Hosts are counted first; a host then
    meets the targets as its own dot-boundary suffixes, an equality join on distinct hosts. A table
    of targets has ``host`` and ``pattern``, one of them null; patterns are searched in the lowercased
    host. There may be any number of either: nothing is collected, and a pattern meets the hosts that
    hold the text it needs.
    """
    counted = calls.groupBy(hosts.url_host(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("calls"))
    if not enabled or (targets is None and not patterns):
        return counted.withColumn("sent", F.lit(enabled))
    spark = calls.sparkSession

    def listed(values, name: str) -> DataFrame:
        return spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in values]).cast("array<string>")).alias(name))

    regexes = listed(patterns, "pattern") if patterns else None
    if isinstance(targets, DataFrame):
        named = targets.select("host")
        in_table = targets.filter(F.col("pattern").isNotNull()).select("pattern")
        regexes = in_table if regexes is None else in_table.unionByName(regexes)
    else:
        named = listed(targets or [], "host")
    # An empty name or a bare dot names no domain.
    domain = F.regexp_replace(F.lower("host"), r"\A\.", "")
    domains = named.select(domain.alias("domain")).filter(F.col("domain") != "").distinct()
    suffixes = counted.select("host", F.explode(hosts.domain_suffixes(F.col("host"))).alias("domain"))
    hits = suffixes.join(domains, "domain").select("host")
    if regexes is not None:
        hits = hits.unionByName(_matched_hosts(counted.filter(F.col("host").isNotNull()).select("host"), regexes))
    hits = hits.distinct().withColumn("sent", F.lit(True))
    return counted.join(hits, "host", "left").select("host", "calls", F.coalesce("sent", F.lit(False)).alias("sent"))
