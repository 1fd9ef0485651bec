"""Actions of captions that the rest of an observation bears out: inflected verbs, negation, and what must or must not be said beside them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from trackloom.functions.lexicon import let

#: The verbs of each group as lemmas, those of several words as they stand.
VERBS = {
    "pick": ("pick", "lift", "raise"),
    "grasp": ("grasp", "grab", "hold", "take hold", "took hold"),
    "place": ("put", "set", "place", "drop", "lay"),
    "open": ("open",),
    "close": ("close", "shut", "seal"),
    "move": ("move", "slide", "carry", "shift"),
    "push": ("push", "shove"),
    "pull": ("pull", "drag"),
    "touch": ("touch", "tap"),
    "inspect": ("look", "inspect", "examine"),
    "release": ("release", "let go", "lets go", "letting go", "let it go"),
    "tool": ("use", "cut", "chop", "slice", "stir", "hammer", "screw", "wipe", "scrub"),
    "insert": ("put", "place", "insert", "drop", "stuff", "plug", "slide", "push", "load", "pack", "lower"),
    "remove": ("take", "pull", "remove", "lift", "pick", "dig", "extract", "unload", "fish"),
}
#: Prepositions of direction, negation, and what breaks a caption into clauses.
INTO = r"\b(into|inside|in to)\b"
OUT_OF = r"\b(out of|out from|from inside|from within)\b"
NEGATED = r"\b(did not|does not fit|didn't|failed to|fails to|pretend|pretends|pretending|without)\b"
CLAUSES = r",\s+(?:and\s+|then\s+)?|\s+and\s+|\s+then\s+"
#: What is said of movement, hold, placement and sight.
UPWARD = r"\b(lift|up|upward|rise|raise)"
UNMOVED = r"\b(did not move|no movement|stationary)\b"
NOT_HELD = r"\b(did not grasp|no hold|dropped)"
NOT_PLACED = r"\b(did not put|kept holding|no placement)"
OBJECT_MOVED = r"object was moved|moved the object|object moves"
LOOKED = r"inspect|examine|look closely"
UNSEEN = r"cannot see|occluded|unclear"


def inflected(lemma: str) -> str:
    """A pattern of the forms that English spelling makes of a verb: a silent e goes before -ing, y becomes ie, a last consonant may double."""
    if " " in lemma:
        return lemma
    if lemma[-1] == "e":
        return f"{lemma[:-1]}({'|'.join(('e', 'es', 'ed', 'ing'))})"
    if lemma[-1] == "y" and len(lemma) > 2 and lemma[-2] not in "aeiou":
        return f"{lemma[:-1]}({'|'.join(('y', 'ies', 'ied', 'ying'))})"
    return f"{lemma}({'|'.join(('s', 'es', 'ed', 'ing', lemma[-1] + 'ed', lemma[-1] + 'ing'))})?"


def verb_pattern(*lemmas: str) -> str:
    """Any form of any of the verbs as a whole word."""
    return rf"\b({'|'.join(map(inflected, lemmas))})\b"


@dataclass(frozen=True)
class Rule:
    """An action for clauses that have all of the patterns `has`, subject to checks.

    A check is (field, pattern, whether it is there, outcome): the first whose pattern is found, or is not, in
    its field decides. Fields: clause, facts, state (what is visible or said to change), said (what is visible,
    inferred or uncertain) and any (the clause or what is said).
    """

    action: str
    has: tuple[str, ...]
    checks: tuple[tuple[str, str, bool, str], ...] = ()


_NO = "UNKNOWN"
#: The first rule whose patterns a clause has decides it.
RULES = (
    Rule("INSERT", (INTO, verb_pattern(*VERBS["insert"])), (("any", NEGATED, True, _NO),)),
    Rule("REMOVE", (OUT_OF, verb_pattern(*VERBS["remove"])), (("any", NEGATED, True, _NO),)),
    Rule("RELEASE", (verb_pattern(*VERBS["release"]),)),
    Rule("PICK", (verb_pattern(*VERBS["pick"]),), (("said", UPWARD, False, _NO), ("said", UNMOVED, True, _NO))),
    Rule("GRASP", (verb_pattern(*VERBS["grasp"]),), (("said", NOT_HELD, True, _NO), ("facts", UPWARD, True, "PICK"))),
    Rule("PLACE", (verb_pattern(*VERBS["place"]),), (("said", NOT_PLACED, True, _NO),)),
    Rule("OPEN", (verb_pattern(*VERBS["open"]),), (("state", "already open", True, _NO),)),
    Rule("CLOSE", (verb_pattern(*VERBS["close"]),), (("state", "already closed", True, _NO),)),
    Rule(_NO, (" is open| is closed",)),
    Rule("MOVE", (verb_pattern(*VERBS["move"]),), (("said", OBJECT_MOVED, False, _NO),)),
    Rule("PUSH", (verb_pattern(*VERBS["push"]),)),
    Rule("PULL", (verb_pattern(*VERBS["pull"]),)),
    Rule("USE_TOOL", (verb_pattern(*VERBS["tool"]),)),
    Rule("TOUCH", (verb_pattern(*VERBS["touch"]),)),
    Rule("INSPECT", (verb_pattern(*VERBS["inspect"]),), (("said", LOOKED, False, _NO),)),
)


def corroborated_actions(action: Column, facts: Column, change: Column, inference: Column, uncertainty: Column) -> Column:
    """array<struct<action, parted>>: the actions of a caption that the rest of the observation bears out.

    A caption is read clause by clause if it has several; clauses that say nothing known are left out, as are
    repeats of the action before. If none is left it is read as a whole. parted tells that several actions share
    the caption, so its times are those of none. A missing caption, or one that says UNKNOWN, and anything that
    could not be seen well, is UNKNOWN. Unlike the rules of lexicon.py these keep the names of objects, and
    know no irregular past.
    """
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    fields = F.struct(low(facts).alias("facts"), F.concat_ws("\n", low(facts), low(change)).alias("state"), F.concat_ws(" ", low(facts), low(inference), low(uncertainty)).alias("said"), low(uncertainty).alias("unsure"))

    def decided(clause: Column, f: Column) -> Column:
        text = {"clause": clause, "facts": f["facts"], "state": f["state"], "said": f["said"], "any": F.concat_ws("\n", clause, f["said"])}
        out = F.when(f["unsure"].rlike(UNSEEN), _NO)
        for rule in RULES:
            found = F.lit(rule.action)
            for field, pattern, there, outcome in reversed(rule.checks):
                found = F.when(text[field].rlike(pattern) == there, outcome).otherwise(found)
            test = clause.rlike(rule.has[0])
            for pattern in rule.has[1:]:
                test = test & clause.rlike(pattern)
            out = out.when(test, found)
        return out.otherwise(_NO)

    def read(raw: Column, f: Column) -> Column:
        pieces = F.filter(F.transform(F.split(raw, CLAUSES, -1), F.btrim), lambda c: c != "")
        known = F.filter(F.transform(F.when(F.size(pieces) > 1, pieces).otherwise(F.array().cast("array<string>")), lambda c: decided(c, f)), lambda a: a != _NO)
        fresh = let(known, lambda k: F.filter(k, lambda a, i: (i == 0) | (a != F.get(k, i - 1))))
        return let(fresh, lambda k: F.transform(F.when(F.size(k) > 0, k).otherwise(F.array(decided(raw, f))), lambda a: F.struct(a.alias("action"), (F.size(k) > 1).alias("parted"))))

    missing = (F.coalesce(action, F.lit("")) == "") | (F.upper(F.trim(action)) == _NO)
    none = F.array(F.struct(F.lit(_NO).alias("action"), F.lit(False).alias("parted")))
    return F.when(missing, none).otherwise(let(fields, lambda f: let(F.lower(action), lambda raw: read(raw, f))))
