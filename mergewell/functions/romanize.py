"""Romanization: accents fold natively, other scripts by a vectorized function."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Latin letters that do not decompose.
_SPECIAL = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ł": "l", "Ł": "L", "ı": "i", "þ": "th", "Þ": "TH", "ð": "d", "Ð": "D", "ħ": "h", "Ħ": "H"}


def _folds() -> tuple[str, str]:
    """Letters of the Latin blocks whose decomposition begins with one ASCII letter, and those letters."""
    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c))) for c in range(0xC0, 0x250)]
    pairs = [(a, b[0]) for a, b in pairs if b[0].isascii() and b[0].isalpha() and a not in _SPECIAL]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


#: Nasal signs of the Indic scripts: the three first signs of each block.
NASAL_SIGNS = "".join(chr(block + k) for block in range(0x900, 0xD80, 0x80) for k in range(3))

#: Devanagari by place in its block; the other Indic blocks have the same places.
_CONSONANTS = dict(zip(range(0x15, 0x3A), "k kh g gh n c ch j jh n t th d dh n t th d dh n n p ph b bh m y r r l l l v s s s h".split(), strict=True))
_VOWELS = dict(zip(range(0x05, 0x15), "a a i i u u r l e e e ai o o o au".split(), strict=True))
_SIGNS = dict(zip(range(0x3E, 0x4D), "a i i u u r r e e e ai o o o au".split(), strict=True))
_INDIC = _CONSONANTS | _VOWELS | _SIGNS | {0x01: "n", 0x02: "n", 0x03: "h", 0x4D: "", 0x3C: "", 0x3D: "", 0x50: "om"}
_INDIC |= {0x58 + k: s for k, s in enumerate("k kh g z r rh f y".split())} | {0x66 + k: str(k) for k in range(10)}

#: Letters of other alphabets, in the order of their code points; "·" stands for nothing.
_ALPHABETS = {
    0x0391: "A V G D E Z I Th I K L M N X O P R · S T Y F Ch Ps O I Y a e i i y a v g d e z i th i k l m n x o p r s s t y f ch ps o i y o y o",
    0x0410: "A B V G D E Zh Z I Y K L M N O P R S T U F Kh Ts Ch Sh Shch · Y · E Yu Ya a b v g d e zh z i y k l m n o p r s t u f kh ts ch sh shch · y · e yu ya e yo dj gj ye z i yi j lj nj c kj i u dz",
    0x05D0: "a b g d h v z h t y k k l m m n n s p p p ts ts k r sh t",
    0x0621: "· a a w i y a b h t th j h kh d dh r z s sh s d t z a gh",
    0x0641: "f q k l m n h w y y",
    0x0561: "a b g d e z e y t zh i l kh ts k h dz gh ch m y n sh o ch p j rr s v t r ts w p k o f",
    0x10D0: "a b g d e v z t i k l m n o p zh r s t u p k gh q sh ch ts dz ts ch kh j h",
}
_LETTERS = {start + k: "" if s == "·" else s for start, row in _ALPHABETS.items() for k, s in enumerate(row.split())}


def _named(ch: str) -> str | None:
    """Kana and Hangul by their standard names, which spell them; None for other characters."""
    name = unicodedata.name(ch, "")
    for prefix in ("HIRAGANA LETTER ", "KATAKANA LETTER ", "HANGUL SYLLABLE "):
        if name.startswith(prefix):
            return name.removeprefix(prefix).removeprefix("SMALL ").lower()
    return None


@lru_cache(maxsize=1 << 16)
def _spelled(ch: str) -> str:
    """One character as ASCII; a blank if nothing is known of it, nothing for a combining mark."""
    c = ord(ch)
    if c < 128:
        return ch
    if ch in _SPECIAL:
        return _SPECIAL[ch]
    if 0x900 <= c < 0xD80:
        return "n" if ch in NASAL_SIGNS[: 3 * 9] and c % 0x80 in (1, 2) or c == 0x900 else _INDIC.get(c % 0x80, "")
    if c in _LETTERS:
        return _LETTERS[c]
    if unicodedata.category(ch) == "Nd":
        return str(unicodedata.digit(ch))
    if (name := _named(ch)) is not None:
        return name
    plain = unicodedata.normalize("NFKD", ch)
    if plain[0] != ch:
        return "".join(_spelled(x) for x in plain if not unicodedata.combining(x)) if plain[0].isalnum() else " "
    return "" if unicodedata.combining(ch) else " "


def romanize(text: str) -> str:
    """ASCII for a text, character by character.

    Accents fold. Indic scripts are spelled without inherent vowels; Greek,
    Cyrillic, Hebrew, Arabic, Armenian and Georgian by letter, kana and Hangul
    by syllable. Han and the remaining scripts are blanks.
    """
    return text if text.isascii() else "".join(map(_spelled, unicodedata.normalize("NFKC", text)))


@F.pandas_udf(StringType())
def _romanized(text: pd.Series) -> pd.Series:
    known = {t: romanize(t) for t in set(text.dropna())}
    return pd.Series([known.get(t) for t in text], dtype=object)


def romanized(text: Column) -> Column:
    """``romanize`` of a column; ASCII and accented Latin values stay in the JVM, which sends only the others."""
    source, target = _folds()
    folded = F.translate(text, source, target)
    for letter, ascii_ in _SPECIAL.items():
        folded = F.replace(folded, F.lit(letter), F.lit(ascii_))
    return F.coalesce(_romanized(F.when(folded.rlike(r"[^\x00-\x7F]"), folded)), folded)
