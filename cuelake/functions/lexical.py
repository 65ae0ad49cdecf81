"""Word classes, tidying of English text, and the cost of ending a caption behind a word, as Columns."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from .text import strip

# Word lists and endings of English captions.
CONJUNCTIONS = "and but or nor for yet so because although though while if when unless until since then".split()
PREPOSITIONS = "in on at by for from to into onto with without about over under before after between through during across behind inside outside".split()
DETERMINERS = "a an the this that these those my your his her its our their some any each every either neither another".split()
SUBJECTS = "i you he she it we they".split()
NEGATIONS = "not n't never no".split()
AUXILIARIES = "am is are was were be been being do does did have has had can could will would shall should may might must".split()
PARTICLES = "up down out off in on away back over".split()
VERBS = "be have do say go get make know think take see come want look give use find tell work call try ask need feel become leave put mean".split()
FILLERS = "um uh hmm ah er eh like basically actually literally honestly well".split()
PAUSES = "well so now okay ok anyway right listen look alright actually basically honestly then".split()
VERB_ENDS = ("ing", "ed", "en", "ify", "ise", "ize")
ADJECTIVE_ENDS = ("ous", "ful", "ive", "able", "ible", "al", "ic", "less", "ary", "ory", "ish")
NOUN_ENDS = ("tion", "ment", "ness", "ity", "ship", "age", "ism", "ist", "er", "or")
#: Steps that tidy a line.
TIDY = (("[\\x{2013}\\x{2014}]", "-"), ("\\s+", " "), ("^ | $", ""), ("\\s+([,.;:!?])", "$1"), ("\\(\\s+", "("), ("\\s+\\)", ")"), ("\\s+'([A-Za-z])", "'$1"), ("\\s+", " "), ("^ | $", ""))


def clean(c: Column) -> Column:
    """One line without dashes, spaces before punctuation or inside brackets."""
    for a, b in TIDY:
        c = F.regexp_replace(c, f"(?U){a}", b)
    return c


#: White space as ``clean`` knows it, and what it may change in a line: lines without such a place stand as they are.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_TIDY_PY = [(re.compile(re.sub(r"\\x\{(\w{4})\}", r"\\u\1", a).replace("\\s", f"[{_SPACE}]")), b.replace("$1", r"\1")) for a, b in TIDY]
_UNTIDY = re.compile(f"[\u2013\u2014]|[{_SPACE.replace(' ', '')}]|^ | $| [ ,.;:!?)']|\\( ")


def untidy(token: Column) -> Column:
    """Whether ``clean`` may change a line with this word in it; joined by single spaces, words of which none is untidy stay as they are."""
    return (token == "") | token.rlike("(?U)[\\x{2013}\\x{2014}\\s]|^[,.;:!?)']|\\(\\z")


def clean_py(text: str) -> str:
    if _UNTIDY.search(text):
        for a, b in _TIDY_PY:
            text = a.sub(b, text)
    return text


def render(tokens: list[str]) -> str:
    return clean_py(" ".join(t.strip() for t in tokens))


def bare(token: Column) -> Column:
    """Lower-case word without punctuation at its ends; apostrophes stay."""
    return F.lower(F.regexp_replace(strip(token), "(?U)^[^\\w']+|[^\\w']+$", ""))


def _ends(w: Column, ends: tuple[str, ...]) -> Column:
    """``w`` is bare, so no line end follows."""
    return reduce(or_, (w.endswith(e) for e in ends))


def verb_like(w: Column) -> Column:
    return w.isin(VERBS + AUXILIARIES) | _ends(w, VERB_ENDS)


def adjective_like(w: Column) -> Column:
    return _ends(w, ADJECTIVE_ENDS)


def noun_like(w: Column) -> Column:
    return ~w.isin(CONJUNCTIONS + PREPOSITIONS + AUXILIARIES + NEGATIONS) & (_ends(w, NOUN_ENDS) | ((F.length(w) >= 4) & ~w.isin(SUBJECTS)))


def sentence_end(token: Column) -> Column:
    return token.rlike("[.!?]+$")


def with_signs(words: DataFrame) -> DataFrame:
    """Words with what a border beside them depends on: ``signs``, a struct of flags worked out once for each word."""
    # A generator between them, so that the stripped words are made once however many flags ask for them.
    rows = words.select("*", F.inline(F.array(F.struct(strip(F.col("word")).alias("t"), bare(F.col("word")).alias("w")))))
    return rows.withColumn("signs", _flags(F.col("t"), F.col("w"))).drop("t", "w")


def _flags(t: Column, w: Column) -> Column:
    flags = {
        "pause": w.isin(PAUSES + FILLERS), "conjunction": w.isin(CONJUNCTIONS), "preposition": w.isin(PREPOSITIONS), "determiner": w.isin(DETERMINERS), "subject": w.isin(SUBJECTS),
        "auxiliary": w.isin(AUXILIARIES), "negation": w.isin(NEGATIONS), "to": w == "to", "stem": w.isin(VERBS), "particle": w.isin(PARTICLES), "blank": w == "",
        "noun": noun_like(w), "verb": verb_like(w), "adjective": adjective_like(w), "done": _ends(t, (".", "!", "?")), "clause": _ends(t, (",", ";", ":")), "capital": t.rlike("^\\p{Lu}"),
    }
    return F.struct(*[f.alias(k) for k, f in flags.items()])


def border_cost(token: Column, mine: Column, after: Column, gap: Column) -> Column:
    """Cost of a border between ``token`` and the token behind it, ``gap`` seconds apart, by the ``signs`` of both; null ``after``: the last word.

    A sum of independent signs: each is a condition and its weight; signs that exclude each other share a list.
    """
    p, n = (lambda k: mine[k]), (lambda k: after[k])
    weights = [
        [(gap >= 0.8, -0.9), (gap >= 0.3, -0.35), (gap <= 0.08, 0.25)],
        [(p("pause"), -1.3)],
        [(n("pause"), -1.9)],
        [(p("done"), -3.4), (p("clause"), -1.3)],
        [(n("conjunction"), -1.45)],
        [(n("preposition"), -1.0)],
        [(p("determiner") & n("noun"), 5.6), (p("determiner"), 4.6)],
        [(p("subject") & n("verb"), 5.0)],
        [(p("auxiliary") & n("verb"), 4.5)],
        [(p("negation") & n("verb"), 4.2)],
        [(p("to") & n("verb"), 4.0)],
        [(p("preposition") & n("noun"), 4.2)],
        [(p("adjective") & n("noun"), 3.4)],
        [(p("conjunction") & ~n("blank") & ~p("done"), 2.7)],
        [(p("stem") & n("particle"), 4.2)],
        [(p("capital") & n("capital"), 2.8)],
    ]
    total = F.lit(0.0)
    for choice in weights:
        weight = F.lit(0.0)
        for condition, value in reversed(choice):
            weight = F.when(condition, value).otherwise(weight)
        total = total + weight
    return F.when(after.isNull(), F.when(sentence_end(token), -1.0).otherwise(0.2)).otherwise(total)
