"""Events and clips against labels: verdicts, causes, reliability, offline re-mapping and their tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.functions import lexicon as lx

#: Seconds of a stretch in which events and labels meet.
SPAN = 16.0
CLIP = ["video_id", "segment_id"]
#: The actions that events may have.
VOCABULARY = ("GRASP", "RELEASE", "PICK", "PLACE", "MOVE", "PUSH", "PULL", "OPEN", "CLOSE", "INSERT", "REMOVE", "USE_TOOL", "TOUCH", "INSPECT", "UNKNOWN")
#: Causes in the order in which they are tried and told.
CAUSES = ("NO_SEGMENT", "VLM_FAILED", "UNMAPPED", "RANKING", "WRONG_VERB", "UNKNOWN_CAUSE")
#: The wordings of labelled clips that name one action, with the action.
LABEL_ACTIONS = {
    "Holding something": "GRASP",
    "Holding something behind something": "GRASP",
    "Holding something in front of something": "GRASP",
    "Holding something next to something": "GRASP",
    "Holding something over something": "GRASP",
    "Picking something up": "PICK",
    "Putting something on a surface": "PLACE",
    "Putting something onto something": "PLACE",
    "Putting something on a flat surface without letting it roll": "PLACE",
    "Putting something upright on the table": "PLACE",
    "Putting something and something on the table": "PLACE",
    "Putting something, something and something on the table": "PLACE",
    "Putting something behind something": "PLACE",
    "Putting something in front of something": "PLACE",
    "Putting something next to something": "PLACE",
    "Putting something underneath something": "PLACE",
    "Putting number of something onto something": "PLACE",
    "Putting something similar to other things that are already on the table": "PLACE",
    "Moving something up": "MOVE",
    "Moving something down": "MOVE",
    "Moving something away from something": "MOVE",
    "Moving something closer to something": "MOVE",
    "Moving something across a surface without it falling down": "MOVE",
    "Moving something and something away from each other": "MOVE",
    "Moving something and something closer to each other": "MOVE",
    "Pushing something from left to right": "PUSH",
    "Pushing something from right to left": "PUSH",
    "Pushing something so that it slightly moves": "PUSH",
    "Pushing something so it spins": "PUSH",
    "Pushing something off of something": "PUSH",
    "Pushing something onto something": "PUSH",
    "Pulling something from left to right": "PULL",
    "Pulling something from right to left": "PULL",
    "Pulling something from behind of something": "PULL",
    "Pulling something onto something": "PULL",
    "Opening something": "OPEN",
    "Closing something": "CLOSE",
    "Putting something into something": "INSERT",
    "Stuffing something into something": "INSERT",
    "Plugging something into something": "INSERT",
    "Taking something out of something": "REMOVE",
    "Removing something, revealing something behind": "REMOVE",
    "Touching (without moving) part of something": "TOUCH",
}


def label_action(template: Column) -> Column:
    """The action that a clip's wording names; null for wordings that are not scored."""
    return lx.mapped(LABEL_ACTIONS, lx.normal_template(template))


def unlisted(catalogue: DataFrame, template: str, allowed: Mapping[str, str] = LABEL_ACTIONS) -> DataFrame:
    """(template): allowed wordings that the catalogue lacks; any row means that the list is wrong."""
    wanted = catalogue.sparkSession.createDataFrame([(k,) for k in allowed], "template string")
    known = catalogue.select(lx.normal_template(F.col(template)).alias("template")).distinct()
    return wanted.join(known, "template", "left_anti")


def usable(clips: DataFrame, labels: DataFrame, key: str, template: str) -> DataFrame:
    """(outcome, action, n): how many clips have no label, a wording that is not scored, or count for an action."""
    both = clips.select(key).join(labels.select(key, template, F.lit(True).alias("_labelled")), key, "left")
    action = label_action(F.col(template))
    outcome = F.when(F.col("_labelled").isNull(), "unlabelled").when(action.isNull(), "excluded").otherwise("usable")
    return both.groupBy(outcome.alias("outcome"), action.alias("action")).agg(F.count("*").alias("n"))


def expanded(truth: DataFrame, repeats: Column, clip_sec: Column) -> DataFrame:
    """Labels of a clip once for each of its copies, moved by the clip's length; rows without an action are not labels."""
    rows = truth.where(F.coalesce("truth_action", F.lit("")) != "")
    rows = rows.withColumns({"copy": F.explode(F.sequence(F.lit(0).cast("long"), repeats.cast("long") - 1)), "_clip": clip_sec})
    shift = F.col("copy") * F.col("_clip")
    return rows.withColumns({"t_start": F.col("t_start") + shift, "t_end": F.col("t_end") + shift}).drop("_clip")


def overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(a_end, b_end) - F.greatest(a_start, b_start))


def covered(events: DataFrame, truth: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Pairs of an event and a label of its video that it overlaps, or if none, that lie within the tolerance; of these, where some name its object, only they.

    truth: (video_id, label_id, truth_action, t_start, t_end), and truth_object and truth_target where known. The join is on the
    video and on stretches of SPAN seconds, each pair in the first that both reach, with an overlap as
    its condition. Adds hit (a direct overlap).
    """
    e = events.select("video_id", "event_id", "action", "start_sec", "end_sec", *[c for c in ("object_label",) if c in events.columns])
    direct = overlap(F.col("start_sec"), F.col("end_sec"), F.col("t_start"), F.col("t_end")) > 0
    wide = overlap(F.col("start_sec") - tolerance, F.col("end_sec") + tolerance, F.col("t_start"), F.col("t_end")) > 0

    def spread(df: DataFrame, a: Column, b: Column, first: str) -> DataFrame:
        low, high = F.floor(F.least(a, b) / SPAN), F.floor(F.greatest(a, b) / SPAN)
        return df.withColumns({first: low, "_stretch": F.explode(F.sequence(low, high))})

    near = spread(e, F.col("start_sec") - tolerance, F.col("end_sec") + tolerance, "_e")
    labels = spread(truth, F.col("t_start"), F.col("t_end"), "_t")
    both = near.join(labels, ["video_id", "_stretch"]).where(wide & (F.col("_stretch") == F.greatest("_e", "_t"))).withColumn("hit", direct)
    one = Window.partitionBy("video_id", "event_id")
    used = both.withColumn("_any", F.max("hit").over(one)).where(F.col("hit") | ~F.col("_any"))
    roles = [c for c in ("truth_object", "truth_target") if c in truth.columns and "object_label" in events.columns]
    if roles:
        named = [F.coalesce(lx.label_score(F.col("object_label"), F.col(c)) > 0, F.lit(False)) for c in roles]
        used = used.withColumn("_on", named[0] if len(named) == 1 else F.greatest(*named))
        used = used.withColumn("_some", F.max("_on").over(one)).where(F.col("_on") | ~F.col("_some")).drop("_on", "_some")
    return used.drop("_e", "_t", "_stretch", "_any")


def assess(events: DataFrame, truth: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """What each event covers, a best case over all of it: verdict, attribution, how far its bounds are off and its direction.

    Bounds are held against the first label of the event's action, else the one with the largest overlap; the
    direction against the first label of its action that states one, else the first that does. Without
    truth_direction no direction is told.
    """
    used = covered(events, truth, tolerance)
    same = F.col("action") == F.col("truth_action")
    size = overlap(F.col("start_sec"), F.col("end_sec"), F.col("t_start"), F.col("t_end"))
    order = F.struct("t_start", "label_id")
    on = F.min_by(F.struct("label_id", "t_start", "t_end"), F.struct((~same).alias("a"), F.when(same, 0.0).otherwise(-size).alias("b"), order.alias("c")))
    stated = F.upper(F.trim("truth_direction")) if "truth_direction" in truth.columns else F.lit(None).cast("string")
    plain = F.coalesce(stated, F.lit("")).isin("", "NONE")
    said = F.min_by(stated, F.when(~plain | (same & (F.coalesce(stated, F.lit("")) != "")), F.struct((~same).alias("a"), order.alias("c"))))
    turned = F.coalesce(F.col("action") == lx.mapped(lx.ANTONYMS, F.col("truth_action")), F.lit(False))
    sums = used.groupBy("video_id", "event_id").agg(F.count("*").alias("n_covered"), F.bool_or(same).alias("same"), F.bool_or(turned).alias("turned"), F.bool_or("hit").alias("hit"), F.bool_or(F.col("truth_action").isin(*VOCABULARY)).alias("worded"), on.alias("on"), said.alias("wanted"))
    out = events.select("video_id", "event_id", "action", "start_sec", "end_sec").join(sums, ["video_id", "event_id"], "left")
    n = F.col("n_covered")
    verdict = F.when(n.isNull(), "UNMATCHED").when(F.col("same"), "EXACT").when(F.col("turned"), "REVERSED").when(~F.col("worded"), "NOT_IN_VOCABULARY").otherwise("OTHER")
    attribution = F.when(n > 1, F.concat(F.lit("AMBIGUOUS x"), n)).when(F.col("hit"), "PRECISE").when(n == 1, "NEAR")
    error = F.greatest(F.abs(F.col("start_sec") - F.col("on.t_start")), F.abs(F.col("end_sec") - F.col("on.t_end")))
    return out.select(
        "video_id",
        "event_id",
        "action",
        verdict.alias("verdict"),
        attribution.alias("attribution"),
        F.coalesce(n, F.lit(0)).cast("long").alias("n_covered"),
        error.alias("boundary_error"),
        F.when(error <= tolerance, "WITHIN_TOL").when(error.isNotNull(), "OUTSIDE_TOL").otherwise("N/A").alias("timing_verdict"),
        lx.direction_verdict(lx.mapped(lx.DIRECTIONS, F.col("action")), F.col("wanted")).alias("direction_verdict"),
    )


def recall_ceiling(events: DataFrame, truth: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """(truth_action, n, covered, ceiling): how many labels of each action some event covers, the most that recall can reach."""
    met = covered(events, truth.drop("truth_object", "truth_target"), tolerance).where("hit").select("video_id", "label_id").distinct().withColumn("_met", F.lit(1))
    both = truth.select("video_id", "label_id", "truth_action").join(met, ["video_id", "label_id"], "left")
    n, got = F.count("*"), F.count("_met")
    return both.groupBy("truth_action").agg(n.alias("n"), got.alias("covered"), (got / n).alias("ceiling"))


def span_scores(events: DataFrame, truth: DataFrame) -> DataFrame:
    """(video_id, event_id, iou): the largest temporal overlap of an event with a label of its action, as intersection over union."""
    used = covered(events, truth, 0.0).where("hit and action = truth_action")
    both = overlap(F.col("start_sec"), F.col("end_sec"), F.col("t_start"), F.col("t_end"))
    union = (F.col("end_sec") - F.col("start_sec")) + (F.col("t_end") - F.col("t_start")) - both
    return used.groupBy("video_id", "event_id").agg(F.max(both / union).alias("iou"))


def refused(observations: DataFrame, backend: str = "backend", model: str = "model_name") -> DataFrame:
    """Successful observations that no real model made: a run with any must not be scored."""
    return observations.where((F.col("status") == "SUCCESS") & ((F.col(backend) == "LOCAL_MODEL") | F.lower(F.col(model)).contains("stub")))


def records(clips: DataFrame, events: DataFrame, observations: DataFrame) -> DataFrame:
    """One row for each clip with its answer: verdict, chosen event, verbs, direction and all captions.

    The answer is the most confident event, the earliest on a tie. A clip without output has no events,
    whatever the tables hold.
    """
    chosen = F.min_by(F.struct("action", "raw_action", "confidence", "start_sec"), F.struct(-F.coalesce("confidence", F.lit(0.0)), F.coalesce("start_sec", F.lit(0.0)), "observation_id", "clause"))
    verbs = F.transform(F.array_sort(F.collect_list(F.struct("observation_id", "clause", "action"))), lambda x: x["action"])
    made = events.groupBy(*CLIP).agg(F.count("*").alias("_n"), verbs.alias("_verbs"), chosen.alias("_best"))
    captions = observations.groupBy(*CLIP).agg(F.array_sort(F.collect_list(F.struct("observation_id", "raw_action", "objects", "status", "error_reason", "seg_start", "seg_end"))).alias("captions"))
    c = clips.withColumn("truth_action", label_action(F.col("template"))).where("truth_action is not null")
    c = c.join(made, CLIP, "left").join(captions, CLIP, "left")
    there = lambda x: F.when(F.col("has_output"), x)
    c = c.withColumns({"got": there(F.col("_best.action")), "n_events": F.coalesce(there(F.col("_n")), F.lit(0)), "all_verbs": F.coalesce(there(F.col("_verbs")), F.array().cast("array<string>")), "raw_action": there(F.col("_best.raw_action"))})
    verdict = F.when(~F.col("has_output"), "NO_OUTPUT").when(F.col("got").isNull(), "NO_EVENTS").when(F.col("got") == F.col("truth_action"), "TOP1").when(F.array_contains("all_verbs", F.col("truth_action")), "ANY_ONLY").otherwise("MISS")
    direction = F.when(F.col("got").isNull(), "N/A").otherwise(lx.direction_verdict(lx.mapped(lx.DIRECTIONS, F.col("got")), lx.template_direction(F.col("template"))))
    return c.select(*CLIP, "template", "truth_action", "exit_code", "seconds", "n_events", "got", "all_verbs", "raw_action", verdict.alias("verdict"), direction.alias("direction"), "captions")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of old, those of new in place of old ones with their keys."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def undone(clips: DataFrame, done: DataFrame, keys: list[str] = CLIP) -> DataFrame:
    """The clips that an interrupted run still has to do."""
    return clips.join(done.select(*keys).distinct(), keys, "left_anti")


def cause(r: DataFrame) -> Column:
    """Why a clip did not give its label's action; null captions mean that it can't be told."""
    captions = F.col("captions")
    return (
        F.when(F.col("verdict") == "TOP1", "CORRECT")
        .when(captions.isNull(), "UNKNOWN_CAUSE")
        .when(F.size(captions) == 0, "NO_SEGMENT")
        .when(~F.exists(captions, lambda c: F.coalesce(c["raw_action"], F.lit("")) != ""), "VLM_FAILED")
        .when(F.col("verdict") == "ANY_ONLY", "RANKING")
        .when(F.coalesce("got", F.lit("UNKNOWN")) == "UNKNOWN", "UNMAPPED")
        .otherwise("WRONG_VERB")
    )


def caption_of(raw: Column, captions: Column) -> Column:
    """The caption of the answer, else the first that is not empty."""
    first = F.get(F.filter(captions, lambda c: F.coalesce(c["raw_action"], F.lit("")) != ""), F.lit(0))["raw_action"]
    return F.coalesce(F.when(raw != "", raw), first, F.lit(""))


def objects_of(raw: Column, captions: Column) -> Column:
    """The objects named with the caption of the answer; null without any."""
    found = F.get(F.filter(captions, lambda c: c["raw_action"].eqNullSafe(raw)), F.lit(0))["objects"]
    return F.when(F.size(found) > 0, found)


def accuracy(r: DataFrame) -> DataFrame:
    """For each labelled action: clips, right answers, answers among the events, wrong ones, none, failed runs, and the wrong answer given most."""
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    is_ = lambda *v: F.col("verdict").isin(*v)
    counts = r.groupBy("truth_action").agg(
        F.count("*").alias("n"), n(is_("TOP1")).alias("top1"), n(is_("TOP1", "ANY_ONLY")).alias("any_hit"), n(is_("MISS")).alias("miss"), n(is_("NO_EVENTS", "NO_OUTPUT")).alias("no_event"), n(F.col("exit_code") != 0).alias("failed"), F.avg(is_("TOP1").cast("double")).alias("rate")
    )
    wrong = r.where(is_("MISS")).groupBy("truth_action", "got").agg(F.count("*").alias("_n"))
    most = wrong.groupBy("truth_action").agg(F.min_by("got", F.struct(-F.col("_n"), "got")).alias("common_wrong"), F.max("_n").alias("common_n"))
    return counts.join(most, "truth_action", "left")


def headline(r: DataFrame) -> DataFrame:
    """One row of rates in percent: right answers over clips and over actions, answers among events, clips without an event, failed runs."""
    a = accuracy(r)
    total = F.sum("n")
    return a.agg(total.alias("n"), (100.0 * F.sum("top1") / total).alias("micro"), (100.0 * F.avg("rate")).alias("macro"), (100.0 * F.sum("any_hit") / total).alias("any_hit"), F.sum("no_event").alias("no_event"), F.sum("failed").alias("failed"))


def cause_shares(r: DataFrame) -> DataFrame:
    """(cause, n, share, headroom): the clips of each cause, and what accuracy would be at most without it; percentages."""
    by = r.groupBy(cause(r).alias("cause")).agg(F.count("*").alias("n"))
    whole = by.agg(F.sum("n").alias("total"), F.sum(F.when(F.col("cause") == "CORRECT", F.col("n")).otherwise(0)).alias("right"))
    told = by.crossJoin(F.broadcast(whole))  # one row of sums beside seven
    gain = F.when(~F.col("cause").isin("CORRECT", "UNKNOWN_CAUSE"), 100.0 * (F.col("right") + F.col("n")) / F.col("total"))
    return told.select("cause", "n", (100.0 * F.col("n") / F.col("total")).alias("share"), gain.alias("headroom"))


def reliability(r: DataFrame) -> DataFrame:
    """(signature, n): calls asked (`asked`), without a usable answer (`failed`), and the failures by their reason."""
    each = r.where("captions is not null").select(F.explode("captions").alias("c"))
    empty = F.coalesce("c.raw_action", F.lit("")) == ""
    marks = F.array_compact(F.array(F.lit("asked"), F.when(empty | (F.col("c.status") != "SUCCESS"), "failed"), F.when(F.coalesce("c.error_reason", F.lit("")) != "", lx.reason_signature(F.col("c.error_reason")))))
    return each.select(F.explode(marks).alias("signature")).groupBy("signature").agg(F.count("*").alias("n"))


def reasons(r: DataFrame, runs: DataFrame) -> DataFrame:
    """(video_id, segment_id, reasons): the reasons recorded with a clip's captions, else those of its run, else none. runs: (video_id, segment_id, error_reason)."""
    own = F.filter(F.transform("captions", lambda c: c["error_reason"]), lambda x: F.coalesce(x, F.lit("")) != "")
    other = runs.where(F.coalesce("error_reason", F.lit("")) != "").groupBy(*CLIP).agg(F.array_sort(F.collect_list("error_reason")).alias("_run"))
    both = r.select(*CLIP, own.alias("_own")).join(other, CLIP, "left")
    return both.select(*CLIP, F.when(F.size("_own") > 0, F.col("_own")).otherwise(F.coalesce("_run", F.array().cast("array<string>"))).alias("reasons"))


def remapped(r: DataFrame, recorded: str = "got") -> DataFrame:
    """The clips with a caption, the action that the rules give it now, all its actions, and what became of the answer.

    outcome: FIXED, BROKEN, CHANGED or SAME; null for captions of several actions, where the answer can't be told from the text.
    """
    rows = r.where(F.coalesce("raw_action", F.lit("")) != "")
    objects = objects_of(F.col("raw_action"), F.col("captions"))
    rows = rows.withColumn("_objects", objects)
    rows = rows.withColumns({"now": lx.match_action(F.col("raw_action"), F.col("_objects"))["verb"], "verbs": F.transform(lx.action_clauses(F.col("raw_action"), F.col("_objects")), lambda a: a["verb"])})
    was, now, truth = F.col(recorded), F.col("now"), F.col("truth_action")
    outcome = F.when((was != truth) & (now == truth), "FIXED").when((was == truth) & (now != truth), "BROKEN").when(was != now, "CHANGED").otherwise("SAME")
    return rows.select(*CLIP, "truth_action", F.col(recorded).alias("was"), "now", "verbs", "raw_action", F.when(F.size("verbs") == 1, outcome).alias("outcome"))


def several_verbs(m: DataFrame) -> DataFrame:
    """(clip, truth_action, verbs, raw_action, hit) of the captions that name several actions: hit tells whether the true one is among them."""
    return m.where(F.size("verbs") > 1).select(*CLIP, "truth_action", "verbs", "raw_action", F.coalesce(F.array_contains("verbs", F.col("truth_action")), F.lit(False)).alias("hit"))


def remap_table(m: DataFrame) -> DataFrame:
    """(truth_action, n, was, now, delta) over the captions of one action."""
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    sums = m.where("outcome is not null").groupBy("truth_action").agg(F.count("*").alias("n"), n(F.col("was") == F.col("truth_action")).alias("was"), n(F.col("now") == F.col("truth_action")).alias("now"))
    return sums.withColumn("delta", F.col("now") - F.col("was"))


def confusion(pairs: DataFrame, truth: str, got: str, top: int) -> DataFrame:
    """The most frequent wrong pairs; a report of `top` rows."""
    return pairs.where(F.col(truth) != F.col(got)).groupBy(truth, got).agg(F.count("*").alias("n")).orderBy(F.desc("n"), truth, got).limit(top)


def slowest(r: DataFrame, top: int = 5) -> DataFrame:
    """The clips that took longest; a report of `top` rows."""
    return r.orderBy(F.desc("seconds"), *CLIP).limit(top).select(*CLIP, "seconds")
