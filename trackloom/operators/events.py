"""From captioned observations to events, states, a graph, scores, episodes and integrity issues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.functions import lexicon as lx
from trackloom.functions import sequences as s
from trackloom.operators.reports import clause_windows
from trackloom.sources.tables import stored

AUTO, REVIEW = 0.70, 0.40
PERSON, BACKGROUND = ("person",), ("dining table",)
SEGMENT = ["video_id", "segment_id"]
EVENT = ["video_id", "event_id"]
WEIGHTS = {"action_certainty": 0.10, "actor_resolution": 0.20, "object_resolution": 0.20, "state_evidence": 0.20, "timing_precision": 0.10, "trajectory_support": 0.20}
#: The order in which events were found; ties of time are settled by it.
FOUND = ["observation_id", "clause"]


def of_class(names: tuple[str, ...]):
    return lambda t: F.lower(t["class_name"]).isin(*names)


def actor_of(tracks: Column) -> Column:
    """The person's track with the most points, the least id on a tie; null without a person."""
    best = F.array_max(F.transform(F.filter(tracks, of_class(PERSON)), lambda t: F.struct(t["n_points"], -t["track_id"])))
    return -best["col2"]


def things_of(tracks: Column) -> Column:
    """array<struct<track_id, name, n_points, surface>>: the tracks that may be an event's object, their classes in lower case and trimmed."""
    things = F.filter(tracks, lambda t: ~of_class(PERSON + BACKGROUND)(t))
    return F.transform(things, lambda t: F.struct(t["track_id"].alias("track_id"), F.lower(F.trim(t["class_name"])).alias("name"), t["n_points"].alias("n_points"), t["surface"].alias("surface")))


def object_of(ordered: Column, things: Column) -> Column:
    """(track, label): the first label that names one of things_of(), and of its tracks the best named, then no marking on another, then that with the most points."""

    def scored(label: Column, i: Column) -> Column:
        one = lambda name, t: F.struct(i.alias("nth"), (-lx.plain_score(name, t["name"])).alias("score"), t["surface"].alias("surface"), (-t["n_points"]).alias("n"), t["track_id"].alias("track"), label.alias("label"))
        return F.filter(lx.let(F.lower(F.trim(label)), lambda name: F.transform(things, lambda t: one(name, t))), lambda s: s["score"] < 0)

    best = F.when(F.size(things) > 0, F.array_min(F.flatten(F.transform(ordered, scored))))
    return lx.let(best, lambda b: F.struct(b["track"].alias("track"), F.coalesce(b["label"], F.get(ordered, F.lit(0))).alias("label")))


def identity_of(track: Column, label: Column, objects: Column, tracks: Column) -> Column:
    """(track, label, status) of what an event's state belongs to: its own track, else the one of tracks (track_id, low) whose class in lower case contains the first object's name."""
    first = F.get(objects, F.lit(0))
    fitting = lx.let(F.lower(first), lambda name: F.filter(tracks, lambda t: F.contains(t["low"], name)))
    made = lambda t, name, status: F.struct(t.cast("long").alias("track"), name.alias("label"), F.lit(status).alias("status"))
    none = F.lit(None)
    guessed = lambda fits: F.when(F.size(fits) == 1, made(F.get(fits, F.lit(0))["track_id"], first, "RESOLVED")).when(F.size(fits) > 1, made(none, first, "AMBIGUOUS")).otherwise(made(none, first, "UNRESOLVED"))
    return F.when(track.isNotNull(), made(track, F.coalesce(label, first), "RESOLVED")).when(first.isNull(), made(none, none.cast("string"), "UNRESOLVED")).otherwise(lx.let(fitting, guessed))


def extract(observations: DataFrame, tracks: DataFrame, changes: DataFrame | None = None) -> DataFrame:
    """The events of the successful observations, one for each action that a caption names.

    tracks: (video_id, segment_id, track_id, class_name, n_points, surface), changes: (video_id, segment_id,
    sec). The tracks of a segment, few by nature, travel as one array, and what they alone tell is worked out once for each segment. Captions are read before they meet them, in the
    tasks that observations come in. A caption's only action has its times, or
    the segment's; several actions share the segment, cut at its changes if there are enough. An
    action of several acts on what its own clause names, or on nothing known.
    """
    fields = F.struct(F.col("track_id").cast("long").alias("track_id"), "class_name", "n_points", "surface")
    held = tracks.groupBy(*SEGMENT).agg(F.array_sort(F.collect_set(fields)).alias("_tracks"))
    people = F.size(F.filter("_tracks", lambda t: t["class_name"] == "person"))
    named = F.transform("_tracks", lambda t: F.struct(t["track_id"].alias("track_id"), F.lower(t["class_name"]).alias("low")))
    held = held.select(*SEGMENT, actor_of(F.col("_tracks")).alias("_actor"), people.alias("_people"), things_of(F.col("_tracks")).alias("_things"), named.alias("_named"))
    low = F.lower(F.coalesce("raw_action", F.lit("")))
    said = F.lower(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in ("visible_facts", "state_change", "inference", "uncertainty") if c in observations.columns]))
    read = observations.where(F.col("status") == "SUCCESS").withColumns({"_acts": lx.read_actions(low, F.col("objects")), "_stated": lx.stated(F.col("visible_facts"), F.col("state_change")), "_told": said})
    o = read.join(held, SEGMENT, "left")
    if changes is None:
        o = o.withColumn("_secs", F.array().cast("array<double>"))
    else:
        o = o.join(changes.groupBy(*SEGMENT).agg(F.collect_set("sec").alias("_secs")), SEGMENT, "left")
    cut = clause_windows(F.col("_secs"), F.col("seg_start"), F.col("seg_end"), F.size("_acts"))
    o = o.withColumns({"_n": F.size("_acts"), "_cut": cut}).select("*", F.posexplode_outer("_acts").alias("clause", "_act"))
    several = F.col("_n") > 1
    bound = object_of(F.col("_act.ordered"), F.col("_things"))
    o = o.withColumns({"_cut": F.get("_cut", F.col("clause")), "_bound": F.when(~several | F.col("_act.named"), bound)})
    start = F.when(several, F.coalesce("_cut.from_sec", "seg_start")).otherwise(F.coalesce("start_sec", "seg_start"))
    end = F.when(several, F.coalesce("_cut.to_sec", "seg_end")).otherwise(F.coalesce("end_sec", "seg_end"))
    timing = F.when(several, "SEGMENT").otherwise(lx.timing(F.col("start_sec"), F.col("end_sec"), F.col("seg_start"), F.col("seg_end")))
    source = F.when(several & F.col("_cut").isNotNull(), "CHANGE_POINT").when(several | (timing != "EXACT"), "SEGMENT").otherwise("VLM")
    return o.select(
        *SEGMENT,
        "observation_id",
        F.col("clause").cast("long").alias("clause"),
        F.concat(F.lit("evt_"), "observation_id", F.when(several, F.concat(F.lit("_"), "clause")).otherwise("")).alias("event_id"),
        F.col("_act.verb").alias("action"),
        F.coalesce(lx.mapped(lx.DIRECTIONS, F.col("_act.verb")), F.lit("NONE")).alias("direction"),
        F.col("_bound.label").alias("object_label"),
        "actor",
        F.col("_actor").alias("actor_id"),
        F.col("_bound.track").alias("object_id"),
        F.coalesce("_people", F.lit(0)).alias("n_people"),
        identity_of(F.col("_bound.track"), F.col("_bound.label"), F.col("objects"), F.col("_named")).alias("identity"),
        start.alias("start_sec"),
        end.alias("end_sec"),
        timing.alias("timing"),
        source.alias("timing_source"),
        "confidence",
        "objects",
        F.col("_stated").alias("stated"),
        F.col("_told").alias("said"),
        "raw_action",
    )


def transitions(events: DataFrame) -> DataFrame:
    """State before and after each event: before is what the last event of the object in the segment left, else what is said of it."""
    e = events.select("*", F.col("identity.track").alias("state_track"), F.col("identity.label").alias("state_label"), F.col("identity.status").alias("state_status"))
    denied, said = lx.denied(F.col("action"), F.col("said")), F.col("said")
    e = e.withColumn("after", F.when(denied, "UNKNOWN").otherwise(lx.state_left(F.col("action"), said)))
    w = Window.partitionBy(*SEGMENT, "state_track", "state_label").orderBy("start_sec", *FOUND)
    e = e.withColumn("_kept", F.coalesce(F.lag("after").over(w), F.lit("UNKNOWN")))
    before = F.when(denied, "UNKNOWN").when(F.col("_kept") != "UNKNOWN", F.col("_kept")).otherwise(lx.state_found(F.col("action"), said))
    return e.select("video_id", F.concat(F.lit("tr_"), "event_id").alias("transition_id"), "event_id", "segment_id", "state_track", "state_label", "state_status", before.alias("before"), "after", "start_sec", "end_sec", "timing")


def node_id(track: Column, label: Column, observation: Column) -> Column:
    name = F.coalesce(F.when(label != "", label), F.lit("unknown"))
    return F.when(track.isNotNull(), F.concat(F.lit("node_track_"), track)).otherwise(F.concat_ws("_", F.lit("node_unresolved"), F.coalesce(observation.cast("string"), F.lit("no_obs")), name))


def one_each(targets: Column) -> Column:
    """Of targets with the same track, or the same label without one, the last, where the first stood."""
    key = lambda t: F.coalesce(t["track"].cast("string"), t["label"], F.lit(""))
    keys = F.transform(targets, key)
    return F.transform(F.filter(targets, lambda t, i: F.array_position(keys, key(t)) == i + 1), lambda t: F.element_at(F.filter(targets, lambda u: key(u) == key(t)), -1))


def edges(events: DataFrame, states: DataFrame) -> DataFrame:
    """An edge from an event's person to each of its targets.

    Targets are the event's own track, else what its states belong to, else the only object named; several
    objects without a link are one target, `multiple_ambiguous`. An edge has the states of its target.
    """
    of_event = states.groupBy(*EVENT).agg(F.array_sort(F.collect_list(F.struct("transition_id", F.col("state_track").alias("track"), F.col("state_label").alias("label"), F.col("state_status").alias("status")))).alias("_states"))
    e = events.join(of_event, EVENT, "left")
    target = lambda t, label, status: F.array(F.struct(t.cast("long").alias("track"), label.cast("string").alias("label"), F.lit(status).alias("status")))
    none, plain = F.lit(None), F.transform("_states", lambda x: F.struct(x["track"].alias("track"), x["label"].alias("label"), x["status"].alias("status")))
    targets = (
        F.when(F.col("object_id").isNotNull(), target(F.col("object_id"), F.col("object_label"), "RESOLVED"))
        .when(F.size("_states") > 0, one_each(plain))
        .when(F.size("objects") == 1, target(none, F.get("objects", F.lit(0)), "UNRESOLVED"))
        .when(F.size("objects") > 1, target(none, F.lit("multiple_ambiguous"), "AMBIGUOUS"))
        .otherwise(target(none, none, "UNRESOLVED"))
    )
    e = e.select("*", F.posexplode(targets).alias("nth", "_to"))
    actor = F.when(F.col("actor_id").isNotNull(), "RESOLVED").when(F.col("n_people") > 1, "AMBIGUOUS").otherwise("UNRESOLVED")
    to = F.col("_to")
    attached = F.filter("_states", lambda x: F.coalesce(F.when(to["track"].isNotNull(), x["track"] == to["track"]).otherwise((to["label"] != "") & (x["label"] == to["label"])), F.lit(False)))
    e = e.withColumns({"source_id": node_id(F.col("actor_id"), F.col("actor"), F.col("observation_id")), "target_id": node_id(to["track"], to["label"], F.col("observation_id"))})
    return e.select(
        "video_id",
        F.concat_ws("_", F.lit("edge"), "event_id", "source_id", "target_id").alias("edge_id"),
        "event_id",
        *FOUND,
        F.col("nth").cast("long").alias("nth"),
        "source_id",
        "target_id",
        "action",
        actor.alias("actor_resolution"),
        to["status"].alias("object_resolution"),
        F.col("actor_id").alias("source_track"),
        to["track"].alias("target_track"),
        F.col("actor").alias("source_label"),
        to["label"].alias("target_label"),
        F.transform(attached, lambda x: x["transition_id"]).alias("state_ids"),
        "timing",
        "start_sec",
        "end_sec",
    )


def nodes(links: DataFrame) -> DataFrame:
    """The graph's nodes by video, each with role and label of the edge end that named it first, and its degree."""
    end = lambda side, role: F.struct(F.col(f"{side}_id").alias("node_id"), F.lit(role).alias("role"), F.col(f"{side}_track").cast("long").alias("track"), F.col(f"{side}_label").alias("label"), F.lit(int(side == "target")).alias("side"))
    flat = links.select("video_id", *FOUND, "nth", F.explode(F.array(end("source", "PERSON"), end("target", "OBJECT"))).alias("n"))
    first = F.min_by(F.struct("n.role", "n.track", "n.label"), F.struct(*FOUND, F.when(F.col("n.side") == 0, -1).otherwise(F.col("nth"))))
    found = flat.groupBy("video_id", F.col("n.node_id").alias("node_id")).agg(first.alias("f"), F.count("*").alias("degree"))
    return found.select("video_id", "node_id", "f.role", "f.track", "f.label", "degree")


def quality(events: DataFrame, links: DataFrame, states: DataFrame, trajectories: DataFrame) -> DataFrame:
    """A weighted score of six parts, its tier, the reasons and what it rests on; a part of 0 rules out automatic acceptance.

    Of an event's edges the last counts. trajectories: (video_id, track_id).
    """
    unknown = lambda c: F.col(c) == "UNKNOWN"
    known = F.when(~unknown("before") & ~unknown("after"), 1.0).when(unknown("before") & unknown("after"), 0.0).otherwise(0.5)
    best = states.groupBy(*EVENT).agg(F.max(known).alias("_best"), F.array_join(F.array_sort(F.collect_list("transition_id")), ",").alias("transition_ids"))
    last = links.groupBy(*EVENT).agg(F.max_by(F.struct("edge_id", "actor_resolution", "object_resolution", "source_track", "target_track"), "nth").alias("_edge"))
    e = events.select(*EVENT, "action", "timing", "confidence").join(best, EVENT, "left").join(last, EVENT, "left")
    for side in ("source", "target"):
        paths = trajectories.select(F.col("video_id").alias("_v"), F.col("track_id").alias(f"_{side}")).distinct()
        e = e.join(paths, (F.col("video_id") == F.col("_v")) & (F.col(f"_edge.{side}_track") == F.col(f"_{side}")), "left").drop("_v")
    met = lambda c: F.when(c == "RESOLVED", 1.0).when(c == "AMBIGUOUS", 0.5).otherwise(0.0)
    there = F.when(F.col("_edge.source_track").isNotNull(), 1).otherwise(0) + F.when(F.col("_edge.target_track").isNotNull(), 1).otherwise(0)
    backed = F.when(F.col("_source").isNotNull(), 1).otherwise(0) + F.when(F.col("_target").isNotNull(), 1).otherwise(0)
    parts = {
        "action_certainty": F.when(unknown("action"), 0.0).otherwise(1.0),
        "actor_resolution": met(F.col("_edge.actor_resolution")),
        "object_resolution": met(F.col("_edge.object_resolution")),
        "state_evidence": F.when(F.col("action").isin(*lx.STATEFUL) | F.col("_best").isNotNull(), F.coalesce("_best", F.lit(0.0))).otherwise(1.0),
        "timing_precision": F.when(F.col("timing") == "EXACT", 1.0).otherwise(0.5),
        "trajectory_support": F.when(there == 0, 0.0).otherwise(backed / there),
    }
    e = e.withColumns({**parts, "_there": there, "_backed": backed})
    total = sum((F.col(k) * w for k, w in WEIGHTS.items()), F.lit(0.0))
    e = e.withColumns({"score": total, "_zero": F.array_join(F.array_compact(F.array(*[F.when(F.col(k) == 0, k) for k in WEIGHTS])), ", ")})
    tier = F.when((F.col("score") >= AUTO) & (F.col("_zero") == ""), "AUTO_ACCEPT").when(F.col("score") >= REVIEW, "HUMAN_REVIEW").otherwise("REJECT")
    linked = F.col("_edge").isNotNull()
    reasons = (
        F.when(unknown("action"), "action unknown"),
        F.when(~linked, "no edge"),
        F.when(linked & (F.col("actor_resolution") < 1), F.concat(F.lit("actor "), F.lower("_edge.actor_resolution"))),
        F.when(linked & (F.col("object_resolution") < 1), F.concat(F.lit("object "), F.lower("_edge.object_resolution"))),
        F.when(F.col("state_evidence") < 1, "no full state evidence"),
        F.when(F.col("timing") != "EXACT", "timing not exact"),
        F.when(F.col("_there") == 0, "no participants").when(F.col("_backed") < F.col("_there"), "participants without trajectory"),
        F.when((F.col("score") >= AUTO) & (F.col("_zero") != ""), F.concat(F.lit("capped: "), "_zero")),
    )
    tracks = F.array_join(F.array_compact(F.array(F.col("_source"), F.col("_target"))), ",")
    return e.select(*EVENT, "action", "confidence", *WEIGHTS, "score", tier.alias("tier"), F.array_join(F.array_compact(F.array(*reasons)), "; ").alias("reasons"), F.col("_edge.edge_id").alias("edge_id"), "transition_ids", tracks.alias("trajectory_tracks"))


#: Names that tiers go by.
TIER_NAMES = {"high": ("HIGH", "AUTO_ACCEPT"), "medium": ("MEDIUM", "HUMAN_REVIEW"), "low": ("LOW",), "rejected": ("REJECT", "REJECTED")}


def tiers(scores: DataFrame) -> DataFrame:
    return scores.groupBy("video_id").agg(*[F.sum(F.when(F.col("tier").isin(*names), 1).otherwise(0)).alias(f"n_{k}") for k, names in TIER_NAMES.items()])


def temporal_episodes(events: DataFrame, gap: float = 2.0) -> DataFrame:
    """Episodes by time alone: events of a video no further than `gap` apart."""
    parts = {"start_sec": F.min("start_sec"), "end_sec": F.max("end_sec"), "n_events": F.count("*"), "_e": F.collect_list(F.struct("start_sec", "end_sec", "event_id"))}
    whole = {"start_sec": F.min("start_sec"), "end_sec": F.max("end_sec"), "n_events": F.sum("n_events"), "_e": F.array_sort(F.flatten(F.collect_list("_e")))}
    found = s.merged_islands(events, ["video_id"], "start_sec", "end_sec", gap, ["event_id"], s.STRETCH_SEC, parts, whole).withColumnRenamed("island", "episode")
    name = F.sha2(F.array_join(F.transform("_e", lambda x: x["event_id"]), "-"), 256)
    return found.select("video_id", "episode", "start_sec", "end_sec", "n_events", F.concat(F.lit("ie_"), F.left(name, F.lit(8))).alias("episode_id"))


def gathered(members: DataFrame, events: DataFrame, states: DataFrame, links: DataFrame) -> DataFrame:
    """(video_id, episode_id, start_sec, end_sec, timing, quality, event_ids, edge_ids, transition_ids) of the episodes that members (video_id, event_id, episode) name."""
    m = members.join(events.select(*EVENT, "start_sec", "end_sec"), EVENT, "left")
    m = m.join(links.select(*EVENT, "edge_id"), EVENT, "left").join(states.select(*EVENT, "transition_id"), EVENT, "left")
    ids = [F.collect_set(f"{k}_id").alias(f"{k}_ids") for k in ("edge", "transition")]
    order = F.transform(F.array_sort(F.collect_set(F.struct("start_sec", "end_sec", "event_id"))), lambda x: x["event_id"])
    extra = [F.first(c).alias(c) for c in ("timing", "quality") if c in members.columns]
    found = m.groupBy("video_id", "episode").agg(F.min("start_sec").alias("start_sec"), F.max("end_sec").alias("end_sec"), order.alias("event_ids"), *ids, *extra)
    name = F.concat(F.lit("ie_"), F.left(F.sha2(F.array_join("event_ids", "-"), 256), F.lit(8)))
    return found.select("video_id", name.alias("episode_id"), "start_sec", "end_sec", *[c for c in ("timing", "quality") if c in members.columns], "event_ids", "edge_ids", "transition_ids")


def bad_bounds() -> Column:
    return F.coalesce((F.col("start_sec") > F.col("end_sec")) | (F.col("start_sec") < 0) | (F.col("end_sec") < 0), F.lit(False))


#: Rules of reference and order, with their severity; each stands once, whichever table breaks it.
RULES = {
    "event_bounds": "ERROR",
    "transition_event_missing": "ERROR",
    "transition_bounds": "ERROR",
    "transition_segment_timing": "INFO",
    "transition_unknown_state": "INFO",
    "edge_event_missing": "ERROR",
    "edge_source_missing": "ERROR",
    "edge_target_missing": "ERROR",
    "edge_source_role": "ERROR",
    "edge_target_role": "ERROR",
    "edge_actor_unresolved": "WARNING",
    "edge_object_unresolved": "WARNING",
    "edge_bounds": "ERROR",
    "edge_segment_timing": "INFO",
    "score_event_missing": "ERROR",
    "episode_bounds": "ERROR",
    "episode_event_missing": "ERROR",
    "episode_event_outside": "WARNING",
    "episode_edge_missing": "ERROR",
    "episode_transition_missing": "ERROR",
}


def issues(events: DataFrame, states: DataFrame, links: DataFrame, points: DataFrame, scores: DataFrame, whole: DataFrame | None = None) -> DataFrame:
    """(video_id, rule, severity, item_id): what breaks the rules between the tables.

    points: the graph's nodes; whole: episodes as gathered() gives them. All ids hold within a video. Each table
    is read once: joins say what is missing, and a row tells all the rules that it breaks.
    """
    there = events.select(*EVENT, F.lit(True).alias("_there"))
    absent = F.col("_there").isNull()

    def broken(df: DataFrame, item: str, tests: dict[str, Column]) -> DataFrame:
        found = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(k).alias("rule"), F.lit(RULES[k]).alias("severity"))) for k, c in tests.items()]))
        return df.select("video_id", F.explode(found).alias("_x"), F.col(item).alias("item_id")).select("video_id", "_x.rule", "_x.severity", "item_id")

    ends = links
    for side in ("source", "target"):
        ends = ends.join(points.select("video_id", F.col("node_id").alias(f"{side}_id"), F.col("role").alias(f"{side}_role")), ["video_id", f"{side}_id"], "left")
    out = [
        broken(events, "event_id", {"event_bounds": bad_bounds()}),
        broken(
            states.join(there, EVENT, "left"),
            "transition_id",
            {"transition_event_missing": absent, "transition_bounds": bad_bounds(), "transition_segment_timing": F.col("timing") == "SEGMENT", "transition_unknown_state": F.expr("before = 'UNKNOWN' or after = 'UNKNOWN'")},
        ),
        broken(
            ends.join(there, EVENT, "left"),
            "edge_id",
            {
                "edge_event_missing": absent,
                "edge_source_missing": F.col("source_role").isNull(),
                "edge_target_missing": F.col("target_role").isNull(),
                "edge_source_role": F.col("source_role") != "PERSON",
                "edge_target_role": F.col("target_role") != "OBJECT",
                "edge_actor_unresolved": F.col("actor_resolution") != "RESOLVED",
                "edge_object_unresolved": F.col("object_resolution") != "RESOLVED",
                "edge_bounds": bad_bounds(),
                "edge_segment_timing": F.col("timing") == "SEGMENT",
            },
        ),
        broken(scores.join(there, EVENT, "left"), "event_id", {"score_event_missing": absent}),
    ]
    if whole is not None:
        each = lambda k: whole.select("video_id", "episode_id", F.col("start_sec").alias("_a"), F.col("end_sec").alias("_b"), F.explode(f"{k}_ids").alias(f"{k}_id"))
        held = each("event").join(events.select(*EVENT, "start_sec", "end_sec", F.lit(True).alias("_there")), EVENT, "left")
        gone = lambda k, df: each(k).join(df.select("video_id", f"{k}_id", F.lit(True).alias("_there")), ["video_id", f"{k}_id"], "left")
        out += [
            broken(whole, "episode_id", {"episode_bounds": bad_bounds()}),
            broken(held, "episode_id", {"episode_event_missing": absent, "episode_event_outside": F.expr("start_sec < _a or end_sec > _b")}),
            broken(gone("edge", links), "episode_id", {"episode_edge_missing": absent}),
            broken(gone("transition", states), "episode_id", {"episode_transition_missing": absent}),
        ]
    total = out[0]
    for more in out[1:]:
        total = total.unionByName(more)
    return total


def health(found: DataFrame) -> DataFrame:
    """(video_id, dataset_health, n_errors, n_warnings, n_infos) of integrity issues."""
    n = {k: F.sum(F.when(F.col("severity") == k.upper(), 1).otherwise(0)) for k in ("error", "warning", "info")}
    sums = found.groupBy("video_id").agg(*[c.alias(f"n_{k}s") for k, c in n.items()])
    return sums.withColumn("dataset_health", F.when(F.col("n_errors") > 0, "CRITICAL").when(F.col("n_warnings") > 0, "WARNING").otherwise("HEALTHY"))


def preview(whole: DataFrame, events: DataFrame, links: DataFrame, points: DataFrame) -> DataFrame:
    """(video_id, episode_id, n_events, said): the events of each episode in order, as a person would write them."""
    each = whole.select("video_id", "episode_id", F.posexplode("event_ids").alias("_nth", "event_id"))
    last = links.groupBy(*EVENT).agg(F.max_by("target_id", "nth").alias("node_id"))
    rows = each.join(events.select(*EVENT, "action"), EVENT).join(last, EVENT, "left").join(points.select("video_id", "node_id", "label"), ["video_id", "node_id"], "left")
    told = F.transform(F.array_sort(F.collect_list(F.struct("_nth", lx.spoken(F.col("action"), F.col("label")).alias("text")))), lambda x: x["text"])
    return rows.groupBy("video_id", "episode_id").agg(F.count("*").alias("n_events"), F.array_join(told, "; ").alias("said"))


def interleave(df: DataFrame, group: str, order: str) -> DataFrame:
    """Two numbers that sort rows so that every beginning is as even over the groups as the whole: turn, then place among the groups in turn.

    Rows are written once before they are dealt by ranges of group and order, as finding the ranges reads them too, and once more when dealt, so a group with most of the rows lies in many tasks. Each
    numbers its own; what a group has in earlier ranges, a row for each, is added.
    """
    df = stored(df, "rows")
    dealt = stored(df.repartitionByRange(F.col(group), F.col(order)).withColumn("_range", F.spark_partition_id()), "ranges")
    nth = F.row_number().over(Window.partitionBy("_range", group).orderBy(order))
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("_range", group).agg(F.count("*").alias("_n")).select(F.col("_range").alias("_at"), F.col(group).alias("_group"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    both = dealt.withColumn("_nth", nth).join(sums, (F.col("_range") == F.col("_at")) & F.col(group).eqNullSafe(F.col("_group")))
    turned = both.select(*df.columns, (F.col("_nth") + F.col("_before")).alias("turn"))
    return turned.withColumn("place", F.row_number().over(Window.partitionBy("turn").orderBy(group)))
