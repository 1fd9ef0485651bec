"""Rules that read captions: action verbs, objects, states and timing, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Verb stems with the action that they name, the first that matches wins.
STEMS = (
    (("fold", "assembl"), "UNKNOWN"),
    (("releas", "let go"), "RELEASE"),
    (("insert",), "INSERT"),
    (("remov", "retriev", "peel"), "REMOVE"),
    (("pick",), "PICK"),
    (("plac", "put down", "drop"), "PLACE"),
    (("grasp", "grip", "hold"), "GRASP"),
    (("push", "flick"), "PUSH"),
    (("pull",), "PULL"),
    (("open", "uncap"), "OPEN"),
    (("clos",), "CLOSE"),
    (("unbox", "unpack"), "REMOVE"),
    (("using", "use"), "USE_TOOL"),
    (("touch", "tapp", "taps", "press"), "TOUCH"),
    (("inspect", "examin"), "INSPECT"),
    (("mov", "slid"), "MOVE"),
    (("plugging", "plugged", "stuffing", "stuffed", "threading", "threaded"), "INSERT"),
)
#: What a preposition in the verb's own clause makes of an action.
PROMOTIONS = (
    ("PLACE", ("into", "inside", "in to", "within"), "INSERT"),
    ("PLACE", ("out of", "outside"), "REMOVE"),
    ("PICK", ("out of", "from inside"), "REMOVE"),
    ("MOVE", ("into", "inside"), "INSERT"),
    ("MOVE", ("out of",), "REMOVE"),
)
#: Endings of a stem, and what ends a clause.
ENDINGS = ("ing", "ped", "ping", "ged", "ging", "ned", "ning", "es", "ed", "s", "e", "d", "")
BREAKS = (" and ", " then ", " after ", " before ", " while ", ",", ";")
#: Opposites, and the direction that a verb implies.
ANTONYMS = {"INSERT": "REMOVE", "REMOVE": "INSERT", "OPEN": "CLOSE", "CLOSE": "OPEN", "PICK": "PLACE", "PLACE": "PICK", "PUSH": "PULL", "PULL": "PUSH", "GRASP": "RELEASE", "RELEASE": "GRASP"}
DIRECTIONS = {"INSERT": "INTO", "CLOSE": "INTO", "REMOVE": "OUT_OF", "OPEN": "OUT_OF", "PLACE": "ONTO", "PICK": "OFF"}
#: Actions after which a change of state is expected.
STATEFUL = ("PICK", "PLACE", "OPEN", "CLOSE", "INSERT", "REMOVE", "GRASP", "RELEASE")


#: What leads to a place rather than to the thing in the hand, and the words between the two.
LOCATIVES = ("into", "in", "onto", "on", "from", "out of", "off", "inside", "under", "over", "at", "against", "toward", "towards", "near", "beside", "to")
DETERMINERS = ("the", "a", "an", "its", "his", "her", "their")
#: Words that say that a thing is open or closed.
OPEN_WORDS = r"\b(?:is open|was open|opened|open)\b"
CLOSED_WORDS = r"\b(?:is closed|was closed|closed|shut|shuts)\b"
#: Words that deny an action.
DENIALS = {
    "PICK": r"\b(stationary|not lifted|no pickup|did not lift|did not move|did not pick)\b",
    "PLACE": r"\b(kept holding|not placed|no placement|did not place)\b",
    "OPEN": r"\b(already open|not opened|remained closed)\b",
    "CLOSE": r"\b(already closed|not closed|remained open)\b",
}
#: Actions, the state that they leave and what must be said for it, the state that they find and what says so.
STATE_RULES = (
    (("PICK", "GRASP"), "IN_HAND", r"\b(in hand|held|holding|lifted|pick|grab)", "ON_SURFACE", r"\b(off table|from table|off surface|from surface|picked up from|grabbed from)"),
    (("PLACE", "RELEASE"), "ON_SURFACE", r"\b(on table|on surface|put|set|place|drop)", "IN_HAND", r"\b(was holding|from hand|held)"),
    (("OPEN",), "OPEN", None, "CLOSED", r"\b(was closed|from closed|opened the closed)\b"),
    (("CLOSE",), "CLOSED", None, "OPEN", r"\b(was open|from open|closed the open)\b"),
)
#: Opposite directions, and what a label's wording says of direction, the first that stands in it wins.
OPPOSITE_DIRECTIONS = {"INTO": "OUT_OF", "OUT_OF": "INTO", "ONTO": "OFF", "OFF": "ONTO"}
TEMPLATE_WORDS = (("out of", "OUT_OF"), ("off of", "OFF"), ("into", "INTO"), ("onto", "ONTO"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is worked out once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def mapped(values: dict[str, str], key: Column) -> Column:
    """What a small dictionary says of a key; null if nothing."""
    return F.element_at(F.create_map(*[F.lit(x) for p in values.items() for x in p]), key)


def stem_pattern(stems: tuple[str, ...]) -> str:
    """Any of the stems as a whole word with one of the usual endings."""
    return rf"\b({'|'.join(stems)})({'|'.join(ENDINGS)})\b"


BREAK_PATTERN = "|".join(BREAKS)
CLAUSE_PATTERN = rf"(?s)^(.*?)(?:{BREAK_PATTERN}|\z)"
LOCATIVE_PATTERN = rf"(^| )({'|'.join(LOCATIVES)}) *( ({'|'.join(DETERMINERS)}))?$"


def word_pattern(phrase: Column) -> Column:
    """A pattern for a phrase as whole words."""
    return F.concat(F.lit(r"\b\Q"), phrase, F.lit(r"\E\b"))


def clause_after(text: Column, position: Column) -> Column:
    """The text from a position on, up to the first word or mark that ends a clause."""
    return F.regexp_extract(F.substring(text, position, F.length(text)), CLAUSE_PATTERN, 1)


def word_at(low: Column, phrase: Column) -> Column:
    """Where a phrase stands in a text as whole words, from 1, else 0. A pattern is made only where its characters are there at all."""
    return F.when(F.contains(low, phrase), F.regexp_instr(low, word_pattern(phrase))).otherwise(F.lit(0))


def longest_names(objects: Column) -> Column:
    """The names of objects in lower case, each once, the longest first."""
    names = F.array_distinct(F.transform(F.filter(objects, lambda o: F.trim(o) != ""), lambda o: F.lower(F.trim(o))))
    return F.transform(F.sort_array(F.transform(names, lambda n: F.struct((-F.length(n)).alias("size"), n.alias("name")))), lambda x: x["name"])


def without(low: Column, names: Column) -> Column:
    """A lower-case text with names replaced by as many spaces, in their order."""
    blank = lambda t, n: F.regexp_replace(t, word_pattern(n), F.repeat(F.lit(" "), F.length(n)))
    return F.coalesce(F.aggregate(names, low, lambda t, n: F.when(F.contains(t, n), blank(t, n)).otherwise(t)), low)


def blanked(low: Column, objects: Column) -> Column:
    """A lower-case text with the names of objects, the longest first, replaced by as many spaces: no verb is read from a name."""
    return without(low, longest_names(objects))


def verb_in(blank: Column) -> Column:
    """(verb, at) of a lower-case text: the first group of stems that it has, promoted by the words of its clause; UNKNOWN and 0 without one.

    Groups are tried in order up to the first, and a pattern only where a stem's characters are there at all.
    """
    found = None
    for stems, name in STEMS:
        near = F.contains(blank, F.lit(stems[0]))
        for stem in stems[1:]:
            near = near | F.contains(blank, F.lit(stem))
        test, hit = near & blank.rlike(stem_pattern(stems)), F.struct(F.regexp_instr(blank, F.lit(stem_pattern(stems))).alias("at"), F.lit(name).alias("verb"))
        found = F.when(test, hit) if found is None else found.when(test, hit)

    def promoted(h: Column) -> Column:
        def by(clause: Column) -> Column:
            out = None
            for base, words, better in PROMOTIONS:
                test = (h["verb"] == base) & clause.rlike(rf"\b({'|'.join(words)})")
                out = F.when(test, better) if out is None else out.when(test, better)
            return out.otherwise(h["verb"])

        better = F.when(h["verb"].isin(*{p[0] for p in PROMOTIONS}), let(clause_after(blank, h["at"]), by)).otherwise(h["verb"])
        return F.struct(F.coalesce(better, F.lit("UNKNOWN")).alias("verb"), F.coalesce(h["at"], F.lit(0)).alias("at"))

    return let(found, promoted)


def match_action(text: Column, objects: Column | None = None) -> Column:
    """(verb, at): the action that a caption names and where its verb stands (from 1), names of objects aside."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return let(low if objects is None else blanked(low, objects), verb_in)


def clauses(low: Column) -> Column:
    """array<struct<at, text>>: the clauses of a text that are not blank, trimmed, and where they begin (from 1)."""
    pieces, breaks = F.split(low, BREAK_PATTERN, -1), F.regexp_extract_all(low, F.lit(BREAK_PATTERN), F.lit(0))
    zero = F.struct(F.lit(1).alias("pos"), F.array().cast("array<struct<at:int,text:string>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        lead = F.length(x["piece"]) - F.length(F.ltrim(x["piece"]))
        spot = F.struct((acc["pos"] + lead).cast("int").alias("at"), F.trim(x["piece"]).alias("text"))
        after = acc["pos"] + F.length(x["piece"]) + F.coalesce(F.length(x["cut"]), F.lit(0))
        return F.struct(after.cast("int").alias("pos"), F.when(F.trim(x["piece"]) != "", F.array_append(acc["out"], spot)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(F.arrays_zip(pieces.alias("piece"), breaks.alias("cut")), zero, step, lambda acc: acc["out"])


def action_clauses(text: Column, objects: Column) -> Column:
    """array<struct<verb, at>>: the actions of a caption's clauses, or if fewer than two, that of the whole caption.

    Clauses without an action or of one word don't count, nor do those that repeat the action before.
    """
    low = F.lower(F.coalesce(text, F.lit("")))

    def read(t: Column, names: Column) -> Column:
        return let(without(t, names), verb_in)

    def actions(x: Column) -> Column:
        t, names = x["text"], x["names"]
        longer = F.filter(clauses(t), lambda c: F.contains(c["text"], F.lit(" ")))
        placed = lambda c: let(read(c["text"], names), lambda m: F.struct(m["verb"].alias("verb"), (c["at"] + m["at"] - 1).alias("at")))
        known = F.filter(F.transform(longer, placed), lambda m: m["verb"] != "UNKNOWN")
        fresh = let(known, lambda k: F.filter(k, lambda m, i: (i == 0) | (m["verb"] != F.get(k, i - 1)["verb"])))
        several = F.when(t.rlike(BREAK_PATTERN), let(fresh, lambda f: F.when(F.size(f) > 1, f)))
        return F.coalesce(several, F.array(read(t, names)))

    return let(F.struct(low.alias("text"), longest_names(objects).alias("names")), actions)


def mention_at(low: Column, label: Column) -> Column:
    """Where a label stands in a lower-case text as whole words, from 1: the phrase, else its last word, else 0."""
    return let(F.lower(F.trim(label)), lambda name: name_at(low, name))


def name_at(low: Column, name: Column) -> Column:
    """mention_at() of a label in lower case and trimmed; its characters hold those of its last word, so without those it is not looked for."""
    head = F.substring_index(name, " ", -1)
    found = F.when(F.contains(low, head), F.coalesce(F.nullif(word_at(low, name), F.lit(0)), word_at(low, head))).otherwise(F.lit(0))
    return F.when(F.coalesce(name, F.lit("")) == "", 0).otherwise(found)


def is_locative(low: Column, at: Column) -> Column:
    """Whether a preposition of place leads to the mention at a position, with one determiner at most between."""
    return F.rtrim(F.substring(low, F.lit(1), at - 1)).rlike(LOCATIVE_PATTERN)


def plain_names(objects: Column) -> Column:
    """array<struct<label, name>>: the names of objects as they stand, and in lower case and trimmed."""
    return F.transform(objects, lambda o: F.struct(o.alias("label"), F.lower(F.trim(o)).alias("name")))


def read_objects(low: Column, plain: Column, verb_at: Column) -> Column:
    """(ordered, named): the labels of plain_names(), those that the verb acts on first, and whether any is named.

    First come those not led by a preposition of place, behind the verb, near it; labels without a mention last.
    """

    def key(m: Column, label: Column, i: Column) -> Column:
        seen = m > 0
        distance = F.when(verb_at > 0, F.abs(m - verb_at)).otherwise(m)
        return F.struct((~seen).alias("absent"), (seen & is_locative(low, m)).alias("place"), (seen & (verb_at > 0) & (m < verb_at)).alias("before"), F.when(seen, distance).otherwise(0).alias("far"), i.alias("nth"), label.alias("label"))

    def of(keys: Column) -> Column:
        return F.struct(F.transform(keys, lambda k: k["label"]).alias("ordered"), F.coalesce(~F.get(keys, F.lit(0))["absent"], F.lit(False)).alias("named"))

    return let(F.sort_array(F.transform(plain, lambda x, i: let(name_at(low, x["name"]), lambda m: key(m, x["label"], i)))), of)


def read_actions(low: Column, objects: Column) -> Column:
    """array<struct<verb, at, ordered, named>>: the actions of a caption with what each acts on; one of several is read from its own clause.

    Never empty, so explode it with explode_outer: explode() would have it worked out once more for a filter on its size.
    """

    def all_of(x: Column) -> Column:
        def one(a: Column) -> Column:
            several = F.size(x["acts"]) > 1
            own = F.when(several, clause_after(x["low"], a["at"])).otherwise(x["low"])
            read = let(own, lambda text: read_objects(text, x["plain"], F.when(several, 1).otherwise(a["at"])))
            return let(read, lambda r: F.struct(a["verb"].alias("verb"), a["at"].alias("at"), r["ordered"].alias("ordered"), r["named"].alias("named")))

        return F.transform(x["acts"], one)

    return let(F.struct(action_clauses(low, objects).alias("acts"), low.alias("low"), plain_names(objects).alias("plain")), all_of)


def ordered_objects(low: Column, objects: Column, verb_at: Column) -> Column:
    """The labels, those that the verb acts on first: not led by a preposition of place, behind the verb, near it; labels without a mention last."""
    return read_objects(low, plain_names(objects), verb_at)["ordered"]


def names_any(low: Column, objects: Column) -> Column:
    return F.coalesce(F.exists(objects, lambda o: mention_at(low, o) > 0), F.lit(False))


def label_score(label: Column, name: Column) -> Column:
    """3 for equal labels, 2 if the name stands in the label, 1 the other way round, else 0; empty ones match nothing."""
    return plain_score(F.lower(F.trim(label)), F.lower(F.trim(name)))


def plain_score(x: Column, y: Column) -> Column:
    """label_score() of a label and a name in lower case and trimmed."""
    both = (F.coalesce(x, F.lit("")) != "") & (F.coalesce(y, F.lit("")) != "")
    return F.when(~both, 0).when(x == y, 3).when(F.contains(x, y), 2).when(F.contains(y, x), 1).otherwise(0)


def evidence(low: Column) -> Column:
    """(state, at): OPEN or CLOSED as a lower-case text says, and where; null if it says neither or both."""

    def told(t: Column) -> Column:
        opened = F.when(F.contains(t, F.lit("open")), F.regexp_instr(t, F.lit(OPEN_WORDS))).otherwise(F.lit(0))
        closed = F.when(F.contains(t, F.lit("closed")) | F.contains(t, F.lit("shut")), F.regexp_instr(t, F.lit(CLOSED_WORDS))).otherwise(F.lit(0))
        one = lambda at, name: F.struct(F.lit(name).alias("state"), at.alias("at"), t.alias("text"))
        of = lambda x: F.when((x["opened"] > 0) & (x["closed"] == 0), one(x["opened"], "OPEN")).when((x["closed"] > 0) & (x["opened"] == 0), one(x["closed"], "CLOSED"))
        return let(F.struct(opened.alias("opened"), closed.alias("closed")), of)

    return let(low, told)


def stated(facts: Column, change: Column) -> Column:
    """(state, at, text) of what is visible, else of what is said to change."""
    return F.coalesce(evidence(F.lower(facts)), evidence(F.lower(change)))


def denied(verb: Column, said: Column) -> Column:
    """Whether a lower-case text says that an action did not happen."""
    out = F.lit(False)
    for name, pattern in DENIALS.items():
        out = out | ((verb == name) & said.rlike(pattern))
    return out


def state_left(verb: Column, said: Column) -> Column:
    """The state that an action leaves its object in, as far as it is said."""
    out = None
    for verbs, after, words, _, _ in STATE_RULES:
        test = verb.isin(*verbs) & (said.rlike(words) if words else F.lit(True))
        out = F.when(test, after) if out is None else out.when(test, after)
    return out.otherwise("UNKNOWN")


def state_found(verb: Column, said: Column) -> Column:
    """The state that an action found its object in, if that is said; else UNKNOWN."""
    out = None
    for verbs, _, _, before, words in STATE_RULES:
        test = verb.isin(*verbs) & said.rlike(words)
        out = F.when(test, before) if out is None else out.when(test, before)
    return out.otherwise("UNKNOWN")


def timing(start: Column, end: Column, seg_start: Column, seg_end: Column, slack: float = 0.05) -> Column:
    """EXACT if both times lie inside the segment by more than the slack, else SEGMENT."""
    inside = (start > seg_start + slack) & (end < seg_end - slack)
    return F.when(F.coalesce(inside, F.lit(False)), "EXACT").otherwise("SEGMENT")


def absolute_timing(start: Column, end: Column, seg_start: Column, seg_end: Column, fps: Column) -> Column:
    """(start_sec, end_sec, note): times that a model gave as text from the segment's start, in seconds of the video.

    A time past an edge by at most one frame is moved to the edge (`snapped`). If a time is no number
    (`not a number`), lies outside, or the two are in the wrong order (`outside`), neither is kept.
    """
    none = F.lit(None).cast("double")

    def pulled(t: Column) -> Column:
        frame = F.when(fps > 0, 1.0 / fps).otherwise(0.0)
        return F.when((t < seg_start) & (seg_start - t <= frame), seg_start).when((t > seg_end) & (t - seg_end <= frame), seg_end).otherwise(t)

    def checked(x: Column) -> Column:
        a, b = seg_start + x["a"], seg_start + x["b"]
        lost = (start.isNotNull() & x["a"].isNull()) | (end.isNotNull() & x["b"].isNull())
        p, q = pulled(a), pulled(b)
        out = F.coalesce((p < seg_start) | (p > seg_end), F.lit(False)) | F.coalesce((q < seg_start) | (q > seg_end), F.lit(False)) | F.coalesce(p > q, F.lit(False))
        moved = F.coalesce(p != a, F.lit(False)) | F.coalesce(q != b, F.lit(False))
        note = F.when(lost, "not a number").when(out, "outside").when(moved, "snapped")
        return F.struct(F.when(lost | out, none).otherwise(p).alias("start_sec"), F.when(lost | out, none).otherwise(q).alias("end_sec"), note.alias("note"))

    return let(F.struct(F.expr("cast(null as double)").alias("z"), start.try_cast("double").alias("a"), end.try_cast("double").alias("b")), checked)


def template_direction(template: Column) -> Column:
    """The direction that a label's wording gives as whole words; null without one."""
    low = F.concat(F.lit(" "), F.lower(F.regexp_replace(template, r"[\[\]]", "")), F.lit(" "))
    out = None
    for words, name in TEMPLATE_WORDS:
        test = F.contains(low, F.lit(f" {words} "))
        out = F.when(test, name) if out is None else out.when(test, name)
    return out


def direction_verdict(mine: Column, wanted: Column) -> Column:
    """SAME, REVERSED or OTHER of two directions; N/A if either is not given."""
    given = mine.isNotNull() & wanted.isNotNull() & ~wanted.isin("", "NONE")
    return F.when(~given, "N/A").when(mine == wanted, "SAME").when(mapped(OPPOSITE_DIRECTIONS, wanted) == mine, "REVERSED").otherwise("OTHER")


def normal_template(template: Column) -> Column:
    """Without brackets, blanks collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(template, r"[\[\]]", ""), r"\s+", " "))


def reason_signature(text: Column) -> Column:
    """A status code and its name, else the first 56 characters."""
    found = F.regexp_extract(text, r"\b([0-9]{3}\s+[A-Z][A-Z_]+)", 1)
    return F.when(found != "", F.regexp_replace(found, r"\s+", " ")).otherwise(F.left(text, F.lit(56)))


def detector_prompt(phrases: Column) -> Column:
    """Lower-case phrases, each once, blanks collapsed, joined as a detector's vocabulary."""
    clean = F.transform(phrases, lambda p: F.trim(F.regexp_replace(F.lower(p), r"\s+", " ")))
    return F.concat(F.array_join(F.array_distinct(F.filter(clean, lambda p: p != "")), " . "), F.lit(" ."))


def with_duration(prompt: Column, token: str, seconds: Column) -> Column:
    """A prompt whose token is replaced by a duration with two decimals."""
    return F.replace(prompt, F.lit(token), F.format_string("%.2f", seconds))


def spoken(action: Column, label: Column) -> Column:
    """An event as a person would write it: UNKNOWN stands alone, and so does an action without a label."""
    return F.when((action == "UNKNOWN") | (F.coalesce(label, F.lit("")) == ""), action).otherwise(F.concat_ws(" ", action, label))


def byte_size(n: Column) -> Column:
    """A number of bytes with one decimal and its unit."""
    out = F.format_string("%.1f TB", n / 1024**4)
    for i, unit in reversed(list(enumerate(("B", "KB", "MB", "GB")))):
        out = F.when(F.abs(n) < 1024 ** (i + 1), F.format_string(f"%.1f {unit}", n / float(1024**i))).otherwise(out)
    return out


def missing_keys(body: Column, required: tuple[str, ...]) -> Column:
    """Which required keys a JSON object lacks, in order; a key with a null is there. All, if it is no object."""
    return F.array_except(F.array(*map(F.lit, required)), F.coalesce(F.json_object_keys(body), F.array().cast("array<string>")))


def bad_times(start: Column, end: Column, seg_start: Column, seg_end: Column) -> Column:
    """Whether given times are in the wrong order or outside the segment, its edges being inside."""
    out = lambda t: F.coalesce((t < seg_start) | (t > seg_end), F.lit(False))
    return F.coalesce(start > end, F.lit(False)) | out(start) | out(end)


def json_body(text: Column) -> Column:
    """The JSON in a model's answer: what a fence holds, else from the first bracket to the last one that closes."""
    fenced = F.regexp_extract(text, r"(?is)```(?:json)?\s*(.*?)```", 1)
    loose = F.regexp_extract(text, r"(?s)([\[{].*[\]}])", 1)
    return F.when(fenced != "", F.trim(fenced)).otherwise(loose)


def json_rows(body: Column) -> Column:
    """array<string>: the objects of a JSON array, or the one object; null if it is neither or there are none."""
    many = F.from_json(body, "array<string>", {"mode": "PERMISSIVE"})
    one = F.when(F.json_object_keys(body).isNotNull(), F.array(body))
    found = F.filter(F.when(F.ltrim(body).startswith("["), many).otherwise(one), lambda x: F.ltrim(x).startswith("{"))
    return F.when(F.size(found) > 0, found)
