"""Inflected verbs and the evidence that captions need."""

import re

import pytest
from pyspark.sql import functions as F

from trackloom.functions import corroboration as co

#: Forms that the verbs must have.
FORMS = {
    "place": "place places placed placing", "close": "close closes closed closing", "move": "move moves moved moving", "slide": "slide slides sliding",
    "raise": "raise raises raised raising", "release": "release releases released releasing", "push": "push pushes pushed pushing", "pull": "pull pulls pulled pulling",
    "lift": "lift lifts lifted lifting", "pick": "pick picks picked picking", "drop": "drop drops dropped dropping", "plug": "plug plugs plugged plugging",
    "stuff": "stuff stuffs stuffed stuffing", "grab": "grab grabs grabbed grabbing", "put": "put puts putting", "shut": "shut shuts shutting",
    "carry": "carry carries carried carrying", "open": "open opens opened opening", "insert": "insert inserts inserted inserting", "take": "take takes taking",
}


@pytest.mark.parametrize("lemma", sorted(FORMS))
def test_forms_of_a_verb(lemma):
    for form in FORMS[lemma].split():
        assert re.search(co.verb_pattern(lemma), form) and re.search(co.verb_pattern(lemma), f"the person is {form} the object on the table")


def test_other_words_are_no_forms():
    for lemma, text in (("place", "no placement was observed"), ("close", "the closet door"), ("open", "the opener is on the shelf"), ("slide", "slid the box across"), ("take", "took the cup")):
        assert not re.search(co.verb_pattern(lemma), text)
    for form in ("let go", "lets go", "letting go"):
        assert re.search(co.verb_pattern(*co.VERBS["release"]), f"the person {form} of the handle")


CASES = [
    (("placing the push chopper into the cardboard box and closing the lid",), ["INSERT", "CLOSE"]),
    (("picked up cup",), ["UNKNOWN"]),
    (("picked up cup", "the hand moves up"), ["PICK"]),
    (("picked up cup", "the hand moves up but did not move"), ["UNKNOWN"]),
    (("grabbing the cup", "it is lifted"), ["PICK"]),
    (("grabbing the cup", None, None, "it is lifted"), ["GRASP"]),
    (("holding it", "the cup dropped"), ["UNKNOWN"]),
    (("putting it down", None, "kept holding it"), ["PLACE"]),
    (("putting it down", "kept holding it"), ["UNKNOWN"]),
    (("opening the door", None, "Already open"), ["UNKNOWN"]),
    (("the door is closed",), ["CLOSE"]),
    (("the drawer is open now",), ["OPEN"]),
    (("moved hand",), ["UNKNOWN"]),
    (("moved it", None, None, "the object moves"), ["MOVE"]),
    (("pretending to put it into the box",), ["UNKNOWN"]),
    (("taking it out of the box", None, None, None, "the hand failed to pull"), ["UNKNOWN"]),
    (("taking it out of the box",), ["REMOVE"]),
    (("pushing it", None, None, None, "the view is unclear"), ["UNKNOWN"]),
    (("wiggled it and pushes it, then pushed it and taps",), ["PUSH", "TOUCH"]),
    (("looking at it",), ["UNKNOWN"]),
    (("looking at it", "they look closely"), ["INSPECT"]),
    (("wiping the table",), ["USE_TOOL"]),
    ((None,), ["UNKNOWN"]),
    (("",), ["UNKNOWN"]),
    ((" Unknown ",), ["UNKNOWN"]),
    ((", ,",), ["UNKNOWN"]),
]


def test_evidence(spark):
    rows = [(i, *(said + (None,) * 5)[:5]) for i, (said, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, a string, f string, c string, n string, u string")
    got = {r.i: r.x for r in df.select("i", co.corroborated_actions(*[F.col(k) for k in "afcnu"]).alias("x")).collect()}
    for i, (said, want) in enumerate(CASES):
        assert [x.action for x in got[i]] == want, said
        assert all(x.parted == (len(want) > 1) for x in got[i])
