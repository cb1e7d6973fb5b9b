"""Text and URL analysis as column expressions, and the English stemmer."""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: the schema's stop words and protected words
STOP_WORDS = ("stopworda", "stopwordb")
PROTECTED = ("dontstems", "zwhacky")


def collapse(text: Column) -> Column:
    """Runs of white space as one space, without trimming."""
    return F.regexp_replace(text, r"[ \t\n\x0B\f\r]+", " ")


def parts(word: Column) -> Column:
    """A word cut at other characters than letters and digits, between letters and digits, and before capitals."""
    spaced = F.regexp_replace(word, r"[^\p{L}\p{N}]+", " ")
    spaced = F.regexp_replace(spaced, r"(\p{Ll})(\p{Lu})", "$1 $2")
    spaced = F.regexp_replace(spaced, r"(\p{L})(\p{N})", "$1 $2")
    spaced = F.regexp_replace(spaced, r"(\p{N})(\p{L})", "$1 $2")
    return F.filter(F.split(spaced, " "), lambda x: x != "")


def _catenated(pieces: Column) -> Column:
    """The joined letters and the joined digits of a word of several parts."""
    words, numbers = F.filter(pieces, lambda x: x.rlike(r"^\p{L}")), F.filter(pieces, lambda x: x.rlike(r"^\p{N}"))

    def joined(some: Column) -> Column:
        return F.when(F.size(some) > 1, F.array(F.array_join(some, ""))).otherwise(F.array().cast("array<string>"))

    return F.concat(joined(words), joined(numbers))


def analyze(text: Column, stop_words: tuple[str, ...] = STOP_WORDS) -> Column:
    """Distinct terms: white-space words without stop words, their parts and joined parts, lower case, in order."""
    words = F.filter(F.split(text, r"[ \t\n\x0B\f\r]+"), lambda w: (w != "") & ~F.lower(w).isin(*stop_words))
    terms = F.flatten(F.transform(words, lambda w: F.transform(F.array(parts(w)), lambda p: F.concat(p, _catenated(p)))[0]))
    return F.array_distinct(F.transform(terms, F.lower))


def analyze_url(url: Column) -> Column:
    """Distinct lower-case runs of letters and digits, in order."""
    return F.array_distinct(F.filter(F.split(F.lower(url), "[^a-z0-9]+"), lambda x: x != ""))


def suggest(terms, prefix: str, field: str = "term"):
    """The distinct terms with a prefix, in order."""
    return terms.where(F.col(field).startswith(prefix)).select(field).distinct().orderBy(field)


def highlight(text: Column, term: str, before: str = "<em>", after: str = "</em>") -> Column:
    """Marks the whole-word matches of a term, without regard to case."""
    return F.regexp_replace(text, rf"(?i)(?<![A-Za-z0-9])({re.escape(term)})(?![A-Za-z0-9])", f"{before}$1{after}")


_VOWEL = "[aeiouy]"
_DOUBLE = re.compile(r"(bb|dd|ff|gg|mm|nn|pp|rr|tt)$")
_SHORT = re.compile(r"(^[aeiouy][^aeiouy]|[^aeiouy][aeiouy][^aeiouywxY])$")
# fixed values of the public English stemming algorithm
_STEP2 = [
    ("ization", "ize"), ("ational", "ate"), ("fulness", "ful"), ("ousness", "ous"), ("iveness", "ive"), ("tional", "tion"), ("biliti", "ble"), ("lessli", "less"),
    ("entli", "ent"), ("ation", "ate"), ("alism", "al"), ("aliti", "al"), ("ousli", "ous"), ("iviti", "ive"), ("fulli", "ful"), ("enci", "ence"), ("anci", "ance"),
    ("abli", "able"), ("izer", "ize"), ("ator", "ate"), ("alli", "al"), ("bli", "ble"), ("ogi", "og"), ("li", ""),
]
_STEP3 = [("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"), ("ative", ""), ("ical", "ic"), ("ness", ""), ("ful", "")]
_STEP4 = ["ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion", "al", "er", "ic"]
_EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
_AFTER_1A = {"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}


def stem(word: str, protected: frozenset[str] = frozenset(PROTECTED)) -> str:
    """The stem of a lower-case English word."""
    if word in protected or len(word) <= 2:
        return word
    if word in _EXCEPTIONS:
        return _EXCEPTIONS[word]
    w = word.lstrip("'")
    w = re.sub(rf"^y|(?<={_VOWEL})y", "Y", w)

    def region(s: str, at: int = 0) -> int:
        m = re.compile(rf"{_VOWEL}[^aeiouy]").search(s, at)
        return m.end() if m else len(s)

    start = re.match("gener|commun|arsen", w)
    r1 = start.end() if start else region(w)
    r2 = region(w, r1)
    w = re.sub(r"('s'|'s|')$", "", w)
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("s") and not w.endswith(("us", "ss")) and re.search(_VOWEL, w[:-2]):
        w = w[:-1]
    if w in _AFTER_1A:
        return w
    for end in ("eedly", "ingly", "edly", "eed", "ing", "ed"):
        if w.endswith(end):
            body = w[: -len(end)]
            if end in ("eed", "eedly"):
                if len(body) >= r1:
                    w = body + "ee"
            elif re.search(_VOWEL, body):
                w = body
                if w.endswith(("at", "bl", "iz")):
                    w += "e"
                elif _DOUBLE.search(w):
                    w = w[:-1]
                elif r1 >= len(w) and _SHORT.search(w):
                    w += "e"
            break
    if re.search(r".[^aeiouy][yY]$", w):
        w = w[:-1] + "i"
    for end, new in _STEP2:
        if w.endswith(end):
            at = len(w) - len(end)
            if at >= r1 and not (end == "ogi" and w[at - 1 : at] != "l") and not (end == "li" and w[at - 1 : at] not in tuple("cdeghkmnrt")):
                w = w[:at] + new
            break
    for end, new in _STEP3:
        if w.endswith(end):
            at = len(w) - len(end)
            if at >= (r2 if end == "ative" else r1):
                w = w[:at] + new
            break
    for end in _STEP4:
        if w.endswith(end):
            at = len(w) - len(end)
            if at >= r2 and (end != "ion" or w[at - 1 : at] in ("s", "t")):
                w = w[:at]
            break
    if w.endswith("e"):
        at = len(w) - 1
        if at >= r2 or (at >= r1 and not _SHORT.search(w[:at])):
            w = w[:at]
    elif w.endswith("ll") and len(w) - 1 >= r2:
        w = w[:-1]
    return w.lower()


@F.pandas_udf(T.ArrayType(T.StringType()))
def stem_terms(terms: pd.Series) -> pd.Series:
    """The distinct stems of arrays of terms, in order; null stays null."""
    return terms.map(lambda ts: None if ts is None else list(dict.fromkeys(stem(t) for t in ts)))


_GAP = regex.compile(r"[^\p{L}\p{N}]+")
_EDGES = (regex.compile(r"(?<=\p{Ll})(?=\p{Lu})"), regex.compile(r"(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})"))


def positions(value: str | None, stop_words: tuple[str, ...] = STOP_WORDS, stemmed: bool = True) -> list[tuple[str, int]]:
    """The whole chain on one text: (term, position), in order.

    Each part of a word has a position; joined parts stand at the last one. Stop words leave their position free.
    A term stands at a position once.
    """
    out, at = [], 0
    for word in re.split(r"[ \t\n\x0b\f\r]+", value or ""):
        if word:
            width, terms = analysed(word, tuple(stop_words), stemmed)
            out += [(t, at + i) for t, i in terms]
            at += width
    return list(dict.fromkeys(out))


def _terms(word: str, stop_words: tuple[str, ...], stemmed: bool) -> tuple[int, tuple[tuple[str, int], ...]]:
    """The number of positions of a word and its terms with their places in it."""
    if word.lower() in stop_words:
        return 1, ()
    pieces = [p for q in _GAP.split(word) if q for p in _EDGES[1].sub(" ", _EDGES[0].sub(" ", q)).split(" ")]
    here = [(p, i) for i, p in enumerate(pieces)]
    for some in ([p for p in pieces if p[0].isalpha()], [p for p in pieces if not p[0].isalpha()]):
        if len(some) > 1:
            here.append(("".join(some), len(pieces) - 1))
    return max(1, len(pieces)), tuple((stem(t.lower()) if stemmed else t.lower(), i) for t, i in here)


_known = lru_cache(1 << 16)(_terms)
LONG = 64


def analysed(word: str, stop_words: tuple[str, ...] = STOP_WORDS, stemmed: bool = True) -> tuple[int, tuple[tuple[str, int], ...]]:
    """_terms(): words recur, so most are known to the worker; long ones would fill its memory."""
    return (_known if len(word) <= LONG else _terms)(word, stop_words, stemmed)


POSTING = T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("positions", T.ArrayType(T.IntegerType()))]))


@F.pandas_udf(POSTING)
def postings(texts: pd.Series) -> pd.Series:
    """The terms of each text with their positions."""

    def one(value):
        found: dict[str, list[int]] = {}
        for t, p in positions(value):
            found.setdefault(t, []).append(p)
        return [{"term": t, "positions": p} for t, p in found.items()]

    return texts.map(one)


def query_terms(value: str) -> list[tuple[int, list[str]]]:
    """The terms of a query by position from the first one: alternatives at each."""
    found: dict[int, list[str]] = {}
    for t, p in positions(value):
        found.setdefault(p, []).append(t)
    first = min(found, default=0)
    return [(p - first, ts) for p, ts in sorted(found.items())]


def matches(value: str, phrase: bool):
    """A UDF: whether a text has any term of a query, or all of them in their places."""
    wanted = query_terms(value)
    every = frozenset(t for _, ts in wanted for t in ts)

    def hit(t) -> bool:
        if t is None or not wanted:
            return False
        if not phrase:
            # places don't matter, so each different word is looked at once
            return any(x in every for w in set(re.split(r"[ \t\n\x0b\f\r]+", t)) if w for x, _ in analysed(w)[1])
        found: dict[str, set[int]] = {}
        for term, p in positions(t):
            found.setdefault(term, set()).add(p)
        places = [(d, set().union(*(found.get(x, set()) for x in ts))) for d, ts in wanted]
        return any(all(at + d in p for d, p in places) for at in places[0][1])

    @F.pandas_udf("boolean")
    def found(texts: pd.Series) -> pd.Series:
        return texts.map(hit)

    return found
