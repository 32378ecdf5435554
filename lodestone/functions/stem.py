"""Russian stemmer, after the published Snowball algorithm. Words without Cyrillic letters pass unchanged."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the published algorithm.
VOWELS = "аеиоуыэюя"
GERUND_1 = "в вши вшись".split()
GERUND_2 = "ив ивши ившись ыв ывши ывшись".split()
ADJECTIVE = "ее ие ые ое ими ыми ей ий ый ой ем им ым ом его ого ему ому их ых ую юю ая яя ою ею".split()
PARTICIPLE_1 = "ем нн вш ющ щ".split()
PARTICIPLE_2 = "ивш ывш ующ".split()
REFLEXIVE = "ся сь".split()
VERB_1 = "ла на ете йте ли й л ем н ло но ет ют ны ть ешь нно".split()
VERB_2 = "ила ыла ена ейте уйте ите или ыли ей уй ил ыл им ым ен ило ыло ено ят ует уют ит ыт ены ить ыть ишь ую ю".split()
NOUN = "а ев ов ие ье е иями ями ами еи ии и ией ей ой ий й иям ям ием ем ам ом о у ах иях ях ы ь ию ью ю ия ья я".split()
SUPERLATIVE = "ейш ейше".split()
DERIVATIONAL = "ост ость".split()


def _cut(part: str, endings: list[str], after: str = "") -> str | None:
    """``part`` without its longest ending of the list, or None; ``after``: letters of which one must stand before it."""
    for e in sorted(endings, key=len, reverse=True):
        if part.endswith(e) and (not after or part[: -len(e)][-1:] in after and len(part) > len(e)):
            return part[: -len(e)]
    return None


def _either(part: str, first: list[str], second: list[str]) -> str | None:
    """The longer match of endings that need а or я before them and endings that don't."""
    found = [x for x in (_cut(part, first, "ая"), _cut(part, second)) if x is not None]
    return min(found, key=len) if found else None


def _region(word: str, start: int) -> int:
    """Where the part after the first non-vowel that follows a vowel begins."""
    for i in range(start + 1, len(word)):
        if word[i] not in VOWELS and word[i - 1] in VOWELS:
            return i + 1
    return len(word)


@lru_cache(maxsize=200_000)
def stem_word(word: str) -> str:
    if not any("а" <= c <= "я" for c in word):
        return word
    begin = next((i + 1 for i, c in enumerate(word) if c in VOWELS), len(word))
    r2 = _region(word, _region(word, 0))
    head, rest = word[:begin], word[begin:]
    cut = _either(rest, GERUND_1, GERUND_2)
    if cut is None:
        short = _cut(rest, REFLEXIVE)
        rest = rest if short is None else short
        cut = _cut(rest, ADJECTIVE)
        if cut is not None:
            also = _either(cut, PARTICIPLE_1, PARTICIPLE_2)
            cut = cut if also is None else also
        else:
            cut = _either(rest, VERB_1, VERB_2)
            if cut is None:
                cut = _cut(rest, NOUN)
    rest = rest if cut is None else cut
    rest = rest[:-1] if rest.endswith("и") else rest
    cut = _cut(rest, DERIVATIONAL)
    if cut is not None and len(head) + len(cut) >= r2:
        rest = cut
    if rest.endswith("нн"):
        rest = rest[:-1]
    else:
        cut = _cut(rest, SUPERLATIVE)
        if cut is not None:
            rest = cut[:-1] if cut.endswith("нн") else cut
        elif rest.endswith("ь"):
            rest = rest[:-1]
    return head + rest


def _any(endings: list[str]) -> str:
    return "|".join(sorted(endings, key=len, reverse=True))


def _ending(first: list[str], second: list[str]) -> str:
    """A pattern for the longer of an ending that needs а or я before it and one that doesn't."""
    return f"(?:(?:{_any(second)})|(?<=[ая])(?:{_any(first)}))$"


def stem_column(word: Column) -> Column:
    """``stem_word`` inside the plan: a pattern's leftmost match at the end of a word is its longest ending."""
    head = F.regexp_extract(word, f"^[^{VOWELS}]*[{VOWELS}]", 0)
    rest = F.substring(word, F.length(head) + 1, F.length(word))
    cut = lambda x, pattern: F.regexp_replace(x, pattern, "")
    gerund, verb = _ending(GERUND_1, GERUND_2), _ending(VERB_1, VERB_2)
    adjective, noun = f"(?:{_any(ADJECTIVE)})$", f"(?:{_any(NOUN)})$"
    plain = cut(rest, f"(?:{_any(REFLEXIVE)})$")
    ended = F.when(plain.rlike(adjective), cut(cut(plain, adjective), _ending(PARTICIPLE_1, PARTICIPLE_2))).when(plain.rlike(verb), cut(plain, verb)).otherwise(cut(plain, noun))
    ended = cut(F.when(rest.rlike(gerund), cut(rest, gerund)).otherwise(ended), "и$")
    # The second region begins after the second run of a vowel and a non-vowel; only there a derivational ending goes.
    region = F.length(F.regexp_extract(word, f"^[^{VOWELS}]*[{VOWELS}]+[^{VOWELS}][^{VOWELS}]*[{VOWELS}]+[^{VOWELS}]", 0))
    short = cut(ended, f"(?:{_any(DERIVATIONAL)})$")
    derived = F.when((region > 0) & (F.length(head) + F.length(short) >= region), short).otherwise(ended)
    best = cut(derived, f"(?:{_any(SUPERLATIVE)})$")
    double = lambda x: cut(x, "(?<=н)н$")
    last = F.when(derived.endswith("нн"), double(derived)).when(best != derived, double(best)).otherwise(cut(derived, "ь$"))
    return F.when((F.length(head) > 0) & word.rlike("[а-я]"), F.concat(head, last)).otherwise(word)
