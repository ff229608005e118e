"""Episode algebra: which messages, topics, tasks and windows make an episode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epiframe.functions.scalars import frame_of

GAP = "no_subtask"


def keep_monotonic(stream: DataFrame, key: list[str], ts: str = "ts", seq: str = "seq") -> DataFrame:
    """Rows whose time is no later than any following row's; equal times stay."""
    later = Window.partitionBy(*key).orderBy(F.col(seq).desc()).rowsBetween(Window.unboundedPreceding, -1)
    return stream.withColumn("_low", F.min(ts).over(later)).where(F.col("_low").isNull() | (F.col(ts) <= F.col("_low"))).drop("_low")


def degenerate(stream: DataFrame, key: str, ts: str = "ts", seq: str = "seq") -> DataFrame:
    """``key, median_step`` of streams of two rows or more whose median time step is not above 0."""
    step = F.col(ts) - F.lag(ts).over(Window.partitionBy(key).orderBy(seq))
    return stream.select(key, step.alias("_d")).groupBy(key).agg(F.percentile("_d", 0.5).alias("median_step")).where("median_step <= 0")


def dedup_topics(topics: DataFrame, scope: str = "scope") -> tuple[DataFrame, DataFrame]:
    """Topics of one scope with equal name, span and count are one recording: the lowest file id's stays. (kept, dropped)

    Dropped rows carry ``kept_file_id``. The lowest is found by an aggregate and joined back from a written-out
    exchange, so a signature that many files share needs no sort or list in one task.
    """
    sig = [scope, "name", "start_ns", "end_ns", "message_count"]
    firsts = topics.groupBy(*[F.col(c).alias(f"_{c}") for c in sig]).agg(F.min("file_id").alias("kept_file_id"))
    same = [topics[c].eqNullSafe(firsts[f"_{c}"]) for c in sig]
    rows = topics.join(firsts, same).drop(*[f"_{c}" for c in sig])
    kept = rows.where("file_id = kept_file_id").drop("kept_file_id").dropDuplicates([*sig, "file_id"])
    return kept, rows.where("file_id <> kept_file_id")


def dedup_rollup(dropped: DataFrame, scope: str = "scope") -> DataFrame:
    """``n_groups, topics_dropped, files_affected``."""
    per = dropped.groupBy(scope, "name", "start_ns", "end_ns", "message_count").agg(F.count("*").alias("n"))
    files = dropped.agg(F.count_distinct("file_id"))
    return per.agg(F.count("*").alias("n_groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("topics_dropped")).withColumn("files_affected", files.scalar())


def bind_roles(specs: DataFrame, files: DataFrame) -> DataFrame:
    """Topic of each role-bound spec: specs ``key, role, names``; files ``file_id, role, topic, paths`` (a row a topic).

    ``status`` is ok, or why there is no topic: the role must be on one file, and one of its topics must have all names.
    """
    n_files = files.groupBy(F.col("role").alias("_r")).agg(F.count_distinct("file_id").alias("n_files"))
    fits = specs.join(files, "role").where(F.size(F.array_except("names", "paths")) == 0).groupBy("key").agg(F.count("*").alias("n_topics"), F.min("topic").alias("_topic"))
    both = specs.join(n_files, F.col("role") == F.col("_r"), "left").join(fits, "key", "left")
    files_n, topics_n = F.coalesce("n_files", F.lit(0)), F.coalesce("n_topics", F.lit(0))
    status = F.when(files_n == 0, "role not found").when(files_n > 1, "role on several files").when(topics_n == 0, "no topic has the names").when(topics_n > 1, "several topics have the names").otherwise("ok")
    return both.select("key", "role", status.alias("status"), F.when(status == "ok", F.col("_topic")).alias("topic"))


def missing_topics(wanted: DataFrame, found: DataFrame) -> DataFrame:
    return wanted.join(found.select("topic").distinct(), "topic", "left_anti")


def with_scope(events: DataFrame) -> DataFrame:
    """Events with datasets, routed to their first one."""
    return events.where(F.size("dataset_ids") > 0).withColumn("scope", F.get("dataset_ids", F.lit(0)))


def task_labels(episodes: DataFrame, tasks: DataFrame, key: str = "episode") -> DataFrame:
    """``key, task``: the episode's own label, else the first task message in its window, else ``default``.

    episodes: ``key, scope, start_ns, end_ns, label``; tasks: ``scope, ts, seq, data``.
    """
    inside = within(tasks, episodes.select(key, "scope", "start_ns", "end_ns"), "scope", "ts", "start_ns", "end_ns")
    first = inside.groupBy(F.col(key).alias("_k")).agg(F.min_by("data", F.struct("ts", "seq")).alias("_first"))
    found = episodes.join(first, F.col(key).eqNullSafe(F.col("_k")), "left")
    return found.select(key, F.coalesce(F.nullif("label", F.lit("")), F.nullif("_first", F.lit("")), F.lit("default")).alias("task"))


def session_windows(sessions: DataFrame, files: DataFrame, topics: DataFrame) -> DataFrame:
    """``session, start_ns, end_ns``: the session's own bounds, else those of its files, else of its topics."""
    f = files.groupBy("session").agg(F.min("start_ns").alias("_fs"), F.max("end_ns").alias("_fe"))
    t = topics.groupBy("session").agg(F.min("start_ns").alias("_ts"), F.max("end_ns").alias("_te"))
    both = sessions.join(f, "session", "left").join(t, "session", "left")
    return both.select("session", F.coalesce("start_ns", "_fs", "_ts").alias("start_ns"), F.coalesce("end_ns", "_fe", "_te").alias("end_ns"))


def subtask_frames(episodes: DataFrame, windows: DataFrame, step_ns: int, key: str = "episode") -> tuple[DataFrame, DataFrame]:
    """One window a frame, the latest start winning (then the earlier end, then the larger id). (frames, dropped windows)

    episodes: ``key, start_ns, n_frames``; windows: ``key, event_id, name, start_ns, end_ns``.
    """
    e = episodes.select(F.col(key).alias("_k"), F.col("start_ns").alias("_s"), "n_frames")
    at = windows.join(e, F.col(key).eqNullSafe(F.col("_k"))).drop("_k")
    at = at.withColumn("first", F.greatest(frame_of(F.col("start_ns"), F.col("_s"), step_ns), F.lit(0))).withColumn("last", F.least(frame_of(F.col("end_ns"), F.col("_s"), step_ns), F.col("n_frames")) - 1)
    dropped = at.where("first > last").select(key, "event_id", "name")
    each = at.where("first <= last").select(key, "event_id", "name", "start_ns", "end_ns", F.explode(F.sequence("first", "last")).alias("frame"))
    top = each.groupBy(key, "frame").agg(F.max_by(F.struct("event_id", "name"), F.struct("start_ns", -F.col("end_ns"), "event_id")).alias("w"))
    frames = episodes.select(key, F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_frames") - 1)).alias("frame"))
    top = top.select(F.col(key).alias("_k"), F.col("frame").alias("_f"), "w")
    return frames.join(top, F.col(key).eqNullSafe(F.col("_k")) & (F.col("frame") == F.col("_f")), "left").select(key, "frame", F.col("w.event_id").alias("event_id"), F.col("w.name").alias("name")), dropped


def segments(frames: DataFrame, key: str = "episode") -> DataFrame:
    """``key, start_frame, content, event_id``: a row where the window changes; none for episodes without any window."""
    order = Window.partitionBy(key).orderBy("frame")
    changed = frames.withColumn("_new", F.lag("frame").over(order).isNull() | ~F.lag("event_id").over(order).eqNullSafe(F.col("event_id")))
    some = frames.where("event_id IS NOT NULL").select(F.col(key).alias("_k")).distinct()
    return changed.where("_new").join(some, F.col(key).eqNullSafe(F.col("_k")), "left_semi").select(key, F.col("frame").alias("start_frame"), F.coalesce("name", F.lit(GAP)).alias("content"), "event_id")


def by_start(events: DataFrame, scope: str, ts: str, event: str) -> DataFrame:
    """``events`` plus ``rank`` within their scope from 0: by start, ties by the larger id first."""
    order = Window.partitionBy(scope).orderBy(ts, F.col(event).desc())
    return events.withColumn("rank", (F.row_number().over(order) - 1).cast("long"))


def relabelled(entries: DataFrame, session: Column, name: Column) -> DataFrame:
    """``entries`` plus ``kind`` (session or event) and ``label``: a session's own name, else none."""
    own = F.coalesce(F.nullif(F.when(session, name), F.lit("")), F.lit("none"))
    return entries.withColumn("kind", F.when(session, "session").otherwise("event")).withColumn("label", own)


def flattened(messages: DataFrame, samples: str, step_ns: int, ts: str = "ts", seq: str = "seq") -> DataFrame:
    """A row a sample of the array column ``samples``, as ``value``: ``step_ns`` apart from the message's time on; ``seq`` is the pair of message and place."""
    rest = [c for c in messages.columns if c not in (samples, ts, seq)]
    rows = messages.select(*rest, F.col(ts).alias("_t"), F.col(seq).alias("_q"), F.posexplode(samples).alias("_p", "value"))
    return rows.select(*rest, (F.col("_t") + F.col("_p").cast("long") * step_ns).alias(ts), F.struct(F.col("_q").alias("message"), F.col("_p").alias("place")).alias(seq), "value")


def within(points: DataFrame, windows: DataFrame, scope: str, ts: str, start: str, end: str) -> DataFrame:
    """Points joined to the windows of their scope that they lie in, both ends included.

    Time is cut into buckets as long as the mean window, and a window is entered in those it touches, so a hot scope's points meet only
    windows near them, not all of its windows.
    """
    mean = windows.agg(F.avg(F.col(end) - F.col(start))).first()[0]
    bucket = max(1, int(mean or 1))
    cut = lambda c: F.floor(c / F.lit(bucket)).cast("long")
    opened = windows.where(F.col(end) >= F.col(start)).withColumn("_cut", F.explode(F.sequence(cut(F.col(start)), cut(F.col(end)))))
    own = points.withColumnRenamed(scope, "_scope").withColumn("_at", cut(F.col(ts)))
    met = opened.join(own, (F.col(scope) == F.col("_scope")) & (F.col("_cut") == F.col("_at")))
    return met.where(F.col(ts).between(F.col(start), F.col(end))).drop("_scope", "_cut", "_at")


def first_seen(rows: DataFrame, value: str, order: Column) -> DataFrame:
    """``value, index``: distinct values numbered in the order of their first row."""
    firsts = rows.groupBy(value).agg(F.min(order).alias("_o"))
    return firsts.select(value, (F.row_number().over(Window.orderBy("_o", value)) - 1).cast("long").alias("index"))


def skip_rollup(skipped: DataFrame) -> DataFrame:
    """Counts of skipped events by stage and error class, with the datasets concerned in order."""
    return skipped.groupBy("stage", "error_class").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("source_dataset_id")).alias("datasets"))


def tag_diff(items: DataFrame, prefix: str) -> DataFrame:
    """``to_add`` and ``to_remove`` of array columns ``wanted`` and ``existing``; only existing tags with the prefix are removed."""
    own = F.filter("existing", lambda t: t.startswith(prefix))
    return items.withColumn("to_add", F.array_sort(F.array_except("wanted", "existing"))).withColumn("to_remove", F.array_sort(F.array_except(own, F.col("wanted"))))


def pair_dims(state: list[str], action: list[str]) -> tuple[str, list[tuple[str, str]]]:
    """How state and action dims belong together: by name without its prefix, by a longest common ending, by position, or not. (method, pairs)"""

    def bare(n: str, prefix: str) -> str:
        return n.removeprefix(prefix)

    by_name = {bare(n, "action."): n for n in action}
    pairs = [(n, by_name[b]) for n in state if (b := bare(n, "observation.state.")) in by_name]
    if pairs:
        return "name", pairs

    def ends(long: str, short: str) -> bool:
        return long == short or (long.endswith(short) and not long[: -len(short)][-1].isalnum())

    free, pairs = list(action), []
    for n in state:
        fits = sorted(((min(len(n), len(a)), -i, a) for i, a in enumerate(free) if a and n and (ends(n, a) or ends(a, n))), reverse=True)
        if fits:
            pairs.append((n, fits[0][2]))
            free.remove(fits[0][2])
    if pairs:
        return "name", pairs
    pairs = list(zip(state, action))
    return ("position", pairs) if pairs else ("none", [])
