"""Line-first cleaning: rules judge each line, failing lines go, and a document that loses too much text is rejected."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import map_texts, packed

SYMBOLS = "#*$%&|<>"
#: Signs between the entries of a menu; fixed values.
BARS = "|»›•·"
AROUND = BARS + " \t\n\x0b\x0c\r"
#: Phrases of legal and site furniture in the corpus's languages; fixed values.
BOILERPLATE = (
    "all rights reserved",
    "licensed under",
    "released under the",
    "terms of service",
    "terms of use",
    "privacy policy",
    "cookie policy",
    "we use cookies",
    "accept cookies",
    "subscribe to our newsletter",
    "sign up for our newsletter",
    "click here",
    "skip to content",
    "lorem ipsum",
    "enable javascript",
    "alle rechte vorbehalten",
    "lizenziert unter",
    "nutzungsbedingungen",
    "datenschutzerklärung",
    "wir verwenden cookies",
    "cookies akzeptieren",
    "newsletter abonnieren",
    "hier klicken",
    "zum inhalt springen",
    "tous droits réservés",
    "sous licence",
    "conditions d'utilisation",
    "politique de confidentialité",
    "nous utilisons des cookies",
    "accepter les cookies",
    "abonnez-vous à notre newsletter",
    "cliquez ici",
    "aller au contenu",
    "todos los derechos reservados",
    "bajo licencia",
    "términos de uso",
    "política de privacidad",
    "utilizamos cookies",
    "aceptar cookies",
    "suscríbete a nuestro boletín",
    "haz clic aquí",
    "saltar al contenido",
)


@dataclass(frozen=True)
class Rules:
    """Limits of the line rules and of the verdict on a document."""

    min_words: int = 20
    max_repeat_percent: int = 30
    window: int = 8
    max_symbol_share: float = 0.10
    max_shout_share: float = 0.5
    max_bar_share: float = 0.15
    max_run_share: float = 0.5
    max_boiler_share: float = 0.25
    max_link_share: float = 0.5
    max_teaser_words: int = 5
    max_lost_share: float = 0.5


def repeated_words(words: list[bytes], width: int = 8) -> int:
    """Words that lie in a window of `width` words which the list holds twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    # Windows with unequal sums differ; only where sums meet, exact ranks of 2, 4, 8... words decide.
    mixed = ids.astype(np.uint64)
    sums = np.zeros(n, np.uint64)
    for j in range(width):
        sums = sums * np.uint64(0x9E3779B97F4A7C15) + mixed[j : j + n] + np.uint64(1)
    ordered = np.sort(sums)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0
    rank = np.zeros(n, np.int64)
    for j in range(width):
        _, rank = np.unique(rank * (len(numbers) + 1) + ids[j : j + n], return_inverse=True)
    twice = np.bincount(rank)[rank] > 1
    marks = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + width, -1)
    return int((np.cumsum(marks[:-1]) > 0).sum())


_SHOUT = re.compile(rb"!{2,}$")
_LINK = re.compile(rb"https?://|www\.")
#: How a line ends that only leads to another page; fixed values.
TEASERS = ("...".encode(), "…".encode(), "»".encode(), "›".encode(), ">>".encode())


def menu_signs(line: str, bars: Sequence[str]) -> int:
    """Signs that stand between entries: bullets and others at either end of the line are none, nor are quotation marks."""
    inner = line.strip(AROUND)
    return sum(inner.count(c) for c in bars if not ((c == "»" and "«" in line) or (c == "›" and "‹" in line)))


def line_fault(line: bytes, words: list[bytes], rules: Rules, phrases: Sequence[str] = BOILERPLATE, bars: Sequence[str] = BARS, links: bool = True) -> str | None:
    """The first rule that a line with words breaks, or None. phrases, bars and links: those of the lists that the text has at all, and whether it has links."""
    n = len(words)
    solid = sum(map(len, words))
    symbols = sum(line.count(s) for s in (b"#", b"*", b"$", b"%", b"&", b"<", b">"))
    if symbols > 2 and symbols > rules.max_symbol_share * solid:
        return "punctuation"
    if line.count(b"!!") and sum(1 for w in words if _SHOUT.search(w)) > rules.max_shout_share * n:
        return "punctuation"
    if bars and menu_signs(line.decode("utf-8", "replace"), bars) > rules.max_bar_share * n:
        return "navigation"
    runs = sum(1 for a, b in zip(words, words[1:], strict=False) if a == b)
    if runs > rules.max_run_share * (n - 1):
        return "repetition"
    if n <= rules.max_teaser_words and line.rstrip().endswith(TEASERS):
        return "teaser"
    if links and sum(len(w) for w in words if _LINK.search(w)) > rules.max_link_share * solid:
        return "links"
    if phrases:
        low = line.decode("utf-8", "replace").lower()
        if sum(low.count(p) * len(p.split()) for p in phrases) > rules.max_boiler_share * n:
            return "boilerplate"
    return None


def clean(text: str | None, rules: Rules) -> tuple[int, int, int, int, int, bool, bool, str, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, clean_text, n_lines_removed)."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    lines = data.split(b"\n")
    words = data.split()
    word_chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    low = text.lower()
    phrases, bars = [p for p in BOILERPLATE if p in low], [c for c in BARS if c in text]
    links = "://" in text or "www." in text
    seen: set[bytes] = set()
    dup, good, lost, solid, removed = 0, [], 0, 0, 0
    for line in lines:
        own = line.split()
        if own:
            dup += line in seen
            seen.add(line)
            size = sum(map(len, own))
            solid += size
            if line_fault(line, own, rules, phrases, bars, links):
                lost += size
                removed += 1
                continue
        good.append(line)
    repeat = repeated_words(words, rules.window)
    failed = len(words) < rules.min_words or 100 * repeat > rules.max_repeat_percent * len(words)
    kept = not failed and lost <= rules.max_lost_share * solid
    cleaned = b"\n".join(good).decode("utf-8", "surrogatepass") if removed else text
    return len(words), word_chars, sum(map(text.count, SYMBOLS)), dup, repeat, failed, kept, cleaned, removed


ADDED = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, clean_text string, n_lines_removed long"


def judge(docs: DataFrame, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """(row, statistics, base_failed, kept, clean_text, n_lines_removed) for every row of docs, without a shuffle.

    Words are runs without ASCII blanks. Each line with a word is held against the rules for punctuation,
    navigation, repetition, links and boilerplate, which are shares of the line and hold at any length, so a long line
    of good words with "click here" in it stays; a line of up to max_teaser_words that ends in dots or an arrow only
    leads elsewhere. Failing lines leave clean_text. How many documents hold a line is no rule here, as copies are still
    there: whole groups of them would lose their text; that is line dedup's work, behind this one. A document is kept if it passes
    the base rules (enough words, few repeated windows) and its failing lines hold at most max_lost_share of
    its text. A null or empty text has no words, fails, and is not kept.
    """
    names = [x.split()[0] for x in ADDED.split(", ")]

    def make():
        def work(texts: list) -> dict[str, list]:
            got = [clean(t, rules) for t in texts]
            return dict(zip(names, map(list, zip(*got, strict=True)), strict=True)) if got else {n: [] for n in names}

        return work

    return map_texts(packed(docs, text), "body", ADDED, make, drop=("body",))


def keep_good(docs: DataFrame, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The rows of docs that are kept, with their columns; the text loses its failing lines."""
    judged = judge(docs, text, rules).where("kept")
    size = F.char_length("clean_text")
    made = {text: F.col("clean_text")} | ({"n_chars": size.cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return judged.select(*[made.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
