"""Functions that no built-in expresses: sequence similarity, title case, coded characters. Arrow-batched pandas UDFs over plain
Python functions, which are the row-level specification and are tested as such."""

from __future__ import annotations

import difflib
import re
import unicodedata
from collections import Counter

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

def plain(s: str | None) -> str:
    """NFKD without combining marks."""
    return "".join(c for c in unicodedata.normalize("NFKD", s or "") if not unicodedata.combining(c))


def key(s: str | None) -> str:
    return " ".join(re.findall("[a-z0-9]+", plain(s).lower()))


def ratio(a: str | None, b: str | None) -> float:
    """Ratcliff-Obershelp similarity with difflib's defaults: asymmetric, and popular characters of b count as junk from 200 on."""
    a, b = a or "", b or ""
    return 1.0 if a == b else difflib.SequenceMatcher(None, a, b).ratio()


def common_letters(a: str, b: str) -> int:
    """Length of the longest string left of both when letters are deleted: the letters of each in bits of one number."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    whole = (1 << len(a)) - 1
    rest = whole
    for c in b:
        if met := rest & at.get(c, 0):
            rest = ((rest + met) | (rest - met)) & whole
    return len(a) - rest.bit_count()


def ratio_from(least: float, a: str | None, b: str | None) -> float | None:
    """ratio where it is `least` or more, else None: blocks that match are letters common to both, in order, so most pairs are told
    by bounds that cost little."""
    a, b = a or "", b or ""
    need = least * (len(a) + len(b)) * (1 - 1e-9)
    if a != b and (2 * (Counter(a) & Counter(b)).total() < need or 2 * common_letters(a, b) < need):
        return None
    found = ratio(a, b)
    return found if found >= least else None


#: Words that stay small inside a title.
SMALL_WORDS = frozenset(
    "a an the and but or nor for of in into on onto to from by with without at as over under after before between through during "
    "against about above across along among around per via vs versus is".split()
)
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")


def _capital(s: str) -> str:
    """With a capital first letter, where that is one letter: ß stays, as SS would be another word."""
    first = s[:1].upper()
    return first + s[1:] if len(first) == 1 else s


def title_case(title: str | None) -> str | None:
    """Sentence case to title case; words with capitals of their own stay, small words inside a clause are lower case."""
    if not title:
        return title
    first = True

    def cased(m: re.Match) -> str:
        nonlocal first
        word, head = m[0], first
        first = False
        if word.isupper() or word[1:] != word[1:].lower():
            return word
        return word.lower() if not head and word.lower() in SMALL_WORDS else _capital(word)

    pieces = []
    for token in re.split(r"(\s+)", title):
        if _WORD.search(token):
            pieces.append(_WORD.sub(cased, token))
            first = token.rstrip()[-1:] in tuple(":;?!")
        else:
            pieces.append(token)
    out = "".join(pieces)
    return _capital(out)


#: Accents by the letter of a character code.
MARKS = {"a": "́", "c": "̂", "d": "̀", "f": "̄", "h": "̧", "i": "̃", "j": "̈", "u": "̣"}


def decode_template(text: str | None, characters: dict[str, str]) -> str:
    """{code} as the character that the table gives, or a letter and its accent by rule; unknown codes stay."""

    def char(m: re.Match) -> str:
        if found := characters.get(m[1]):
            return found
        built = re.fullmatch(rf"g0n([{''.join(MARKS)}])([A-Za-z])", m[1])
        return unicodedata.normalize("NFC", built[2] + MARKS[built[1]]) if built else m[0]

    return re.sub(r"\{(\w+)\}", char, text or "").strip()


def _one(kind, f):
    @F.pandas_udf(kind)
    def run(c: pd.Series) -> pd.Series:
        return c.map(f)

    return run


def _similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


similarity = F.pandas_udf(_similarity, DoubleType())
#: The same where a filter on the answer must not make Spark ask for it twice.
similarity_in_place = F.pandas_udf(_similarity, DoubleType()).asNondeterministic()


def similarity_from(least: float):
    """similarity where it is `least` or more, null elsewhere; a filter on the answer does not make Spark ask for it twice."""

    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([ratio_from(least, x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    return F.pandas_udf(run, DoubleType()).asNondeterministic()


fold_exact = _one(StringType(), plain)
norm_exact = _one(StringType(), key)
to_title_case = _one(StringType(), title_case)
#: Composed where it can be: marks join the letters before them.
compose = _one(StringType(), lambda s: s and unicodedata.normalize("NFC", s))
