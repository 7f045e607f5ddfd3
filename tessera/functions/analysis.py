"""Words of texts for lexical search: an analyzer is a function of a text to its terms.

`plain` takes runs of ASCII letters and digits. `english` also drops stop words and words of
more than LONGEST characters, and stems by the published Snowball rules for English."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

from tessera.functions.plugins import resolve

Analyzer = Callable[[str | None], list[str]]

_RUN = re.compile("[a-z0-9]+")
_WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?")
#: Fixed value: the longest word that is indexed.
LONGEST = 40
#: English function words.
STOP_WORDS = frozenset(
    """a about above after again against all am an and any are as at be because been before being below
    between both but by can could did do does doing down during each few for from further had has have having
    he her here hers herself him himself his how i if in into is it its itself just me more most my myself no
    nor not now of off on once only or other our ours ourselves out over own same she should so some such than
    that the their theirs them themselves then there these they this those through to too under until up very
    was we were what when where which while who whom why will with would you your yours yourself yourselves""".split()
)


def plain(text: str | None) -> list[str]:
    return _RUN.findall((text or "").lower())


def english(text: str | None) -> list[str]:
    words = (w.replace("’", "'") for w in _WORD.findall((text or "").lower().replace("’", "'")))
    return [stem(w) for w in words if len(w) <= LONGEST and w not in STOP_WORDS]


#: Sparse backends by name.
ANALYZERS: dict[str, Analyzer] = {"plain": plain, "english": english}


def analyzer_of(name: str) -> Analyzer:
    return resolve("analyzer", name, ANALYZERS)

# ---------------------------------------------------------------------- stemmer

_VOWEL = "aeiouy"
#: Fixed values of the published rules: words of their own, words left after step 1a,
#: beginnings that end region 1, and endings with what takes their place.
_WHOLE = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli",
    "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
_LEFT = {"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}
_BEGIN = ("gener", "commun", "arsen")
_STEP_2 = {
    "ization": "ize", "ational": "ate", "fulness": "ful", "ousness": "ous", "iveness": "ive", "tional": "tion", "biliti": "ble",
    "lessli": "less", "entli": "ent", "ation": "ate", "alism": "al", "aliti": "al", "ousli": "ous", "iviti": "ive", "fulli": "ful",
    "enci": "ence", "anci": "ance", "abli": "able", "izer": "ize", "ator": "ate", "alli": "al", "bli": "ble", "ogi": "og", "li": "",
}
_STEP_3 = {"ational": "ate", "tional": "tion", "alize": "al", "icate": "ic", "iciti": "ic", "ative": "", "ical": "ic", "ness": "", "ful": ""}
_STEP_4 = ("ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "ion", "al", "er", "ic")
_DOUBLE = {"bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt"}
_LI = "cdeghkmnrt"


def _regions(w: str) -> tuple[int, int]:
    """Where regions 1 and 2 begin: after the first consonant that follows a vowel."""

    def after(start: int) -> int:
        for i in range(start + 1, len(w)):
            if w[i - 1] in _VOWEL and w[i] not in _VOWEL:
                return i + 1
        return len(w)

    first = next((len(b) for b in _BEGIN if w.startswith(b)), None)
    first = after(0) if first is None else first
    return first, after(first)


def _short_end(w: str) -> bool:
    """Whether a word ends in a short syllable."""
    if len(w) == 2:
        return w[0] in _VOWEL and w[1] not in _VOWEL
    return len(w) > 2 and w[-3] not in _VOWEL and w[-2] in _VOWEL and w[-1] not in _VOWEL + "wxY"


@lru_cache(maxsize=100_000)
def stem(word: str) -> str:
    """The Snowball stem of a lower-case English word."""
    if len(word) <= 2 or not word.isascii():
        return word
    w = word.removeprefix("'")
    if w in _WHOLE:
        return _WHOLE[w]
    # A y that begins a word or follows a vowel is a consonant.
    w = "".join("Y" if c == "y" and (i == 0 or w[i - 1] in _VOWEL) else c for i, c in enumerate(w))
    r1, r2 = _regions(w)
    for end in ("'s'", "'s", "'"):
        if w.endswith(end):
            w = w[: -len(end)]
            break
    w = _step_1a(w)
    if w in _LEFT:
        return w
    w = _step_1b(w, r1)
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in _VOWEL:
        w = w[:-1] + "i"
    w = _replaced(w, _STEP_2, r1, r2)
    w = _replaced(w, _STEP_3, r1, r2)
    end = next((e for e in _STEP_4 if w.endswith(e)), "")
    if end and len(w) - len(end) >= r2 and (end != "ion" or w[-4:-3] in ("s", "t")):
        w = w[: -len(end)]
    if w.endswith("e") and (len(w) - 1 >= r2 or (len(w) - 1 >= r1 and not _short_end(w[:-1]))):
        w = w[:-1]
    elif w.endswith("ll") and len(w) - 1 >= r2:
        w = w[:-1]
    return w.replace("Y", "y")


def _step_1a(w: str) -> str:
    if w.endswith("sses"):
        return w[:-2]
    if w.endswith(("ied", "ies")):
        return w[:-2] if len(w) > 4 else w[:-1]
    if w.endswith(("us", "ss")) or not w.endswith("s"):
        return w
    return w[:-1] if any(c in _VOWEL for c in w[:-2]) else w


def _step_1b(w: str, r1: int) -> str:
    for end in ("eedly", "eed"):
        if w.endswith(end):
            return w[: -len(end)] + "ee" if len(w) - len(end) >= r1 else w
    end = next((e for e in ("ingly", "edly", "ing", "ed") if w.endswith(e)), "")
    left = w[: -len(end)] if end else ""
    if not any(c in _VOWEL for c in left):
        return w
    if left.endswith(("at", "bl", "iz")):
        return left + "e"
    if left[-2:] in _DOUBLE:
        return left[:-1]
    return left + "e" if _short_end(left) and r1 >= len(left) else left


def _replaced(w: str, ends: dict[str, str], r1: int, r2: int) -> str:
    """Step 2 or 3: the longest of the endings, if it lies in its region."""
    end = next((e for e in sorted(ends, key=len, reverse=True) if w.endswith(e)), "")
    if not end or len(w) - len(end) < (r2 if end == "ative" else r1):
        return w
    left = w[: -len(end)]
    if (end == "li" and left[-1:] not in _LI) or (end == "ogi" and not left.endswith("l")):
        return w
    return left + ends[end]
