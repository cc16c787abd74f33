"""Text mining on ads, all of it as JVM expressions.

Patterns start with (?U) so that word boundaries know accented letters.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotline import fixed_values as fv
from lotline.functions.columns import _col

NUMBER = r"\d+(\.\d+)?"


def _accent_pairs() -> tuple[str, str]:
    """Latin letters with marks and the plain letters they stand for."""
    src, dst = [], []
    for code in range(0xC0, 0x250):
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base.isascii():
            src.append(chr(code))
            dst.append(base)
    return "".join(src), "".join(dst)


_MARKED, _PLAIN = _accent_pairs()
# fixed values: letters without a canonical decomposition
_SPELLED_OUT = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O"}


def strip_accents(column: Column | str) -> Column:
    c = F.translate(_col(column), _MARKED, _PLAIN)
    return reduce(lambda acc, kv: F.replace(acc, F.lit(kv[0]), F.lit(kv[1])), _SPELLED_OUT.items(), c)


def normalize_text(column: Column | str, accents: bool = True) -> Column:
    """Lower case, runs of white space as one blank; marks on letters go when `accents` is False.

    A blank on its own stays, so the pattern passes it over: most texts have no other white space.
    """
    c = _col(column)
    c = c if accents else strip_accents(c)
    return F.regexp_replace(F.lower(c), r" \s+|[\t\n\x0B\f\r]\s*", " ")


def known(text: Column) -> Column:
    """Null for an empty text. `nullif` says the same but names the text twice, and so works it out twice; nested ones four times."""
    return F.get(F.array_remove(F.array(text), ""), F.lit(0))


def named(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is worked out once, however often `use` names it.

    A function of an array element is not fused into the code of a whole stage either. Many patterns in one fused method make it
    longer than the JVM compiles (8,000 bytes), and then every row of the stage is interpreted.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def first_match(column: Column | str, pattern: str) -> Column:
    """What the pattern matches first, null where that is nothing."""
    return known(F.regexp_extract(_col(column), pattern, 0))


def context_window(
    column: Column | str,
    units: str = fv.CONTEXT_UNITS,
    before: int = fv.CONTEXT_WORDS,
    after: int = fv.CONTEXT_WORDS,
) -> Column:
    """First number with a unit, with up to `before` and `after` words around it.

    Texts without any number and unit are told apart first by the short pattern.
    """
    c = _col(column)
    window = first_match(c, "(?U)" + context_pattern(units, before, after))
    return F.when(c.rlike(rf"(?U)\d\s?({units})"), window)


def context_pattern(units: str, before: int, after: int) -> str:
    return (
        rf"(\b(?:\w+\b\W+){{0,{before}}})"
        rf"(\b{NUMBER}\s?({units}))"
        rf"((\W+\b\w+\b){{0,{after}}})"
    )


def unit_pattern(units: str) -> str:
    return rf"\b({NUMBER})\s?({units})"


def number_with_unit(column: Column | str, units: str = fv.SURFACE_UNITS) -> Column:
    """The number of the first "number unit" in the text, null when there is none."""
    return first_number(first_match(column, "(?U)" + unit_pattern(units)))


def first_number(column: Column | str) -> Column:
    return first_match(column, NUMBER).try_cast("double")


def veto(value: Column | str, context: Column | str, words: Sequence[str] = fv.EXCLUSION_WORDS) -> Column:
    """Null the value where the context has one of the words (whole word, any case)."""
    bad = _col(context).rlike("(?U)" + word_pattern(words, ignore_case=True))
    return F.when(~F.coalesce(bad, F.lit(False)), _col(value))


def word_pattern(words: Sequence[str], ignore_case: bool = False) -> str:
    return ("(?i)" if ignore_case else "") + r"\b(" + "|".join(words) + r")\b"


def dimension_pattern() -> str:
    side = rf"({NUMBER})(\s*({fv.LENGTH_UNITS}))?\s*(de)?\s*"
    return rf"\b{side}(frente|frente\s+norte)?\s*(de)?\s*({fv.LENGTH_SEPARATORS})\s*{side}(fondo)?\b"


def dimension_product(column: Column | str) -> Column:
    """Area out of "a x b"; opening hours such as 24x7 are no area."""
    def area(hit: Column) -> Column:
        first = first_match(hit, rf"^\s*{NUMBER}").try_cast("double")
        second = known(F.regexp_extract(hit, rf"(?i)(?:{fv.LENGTH_SEPARATORS})\s*({NUMBER})", 1)).try_cast("double")
        return F.when(~hit.rlike(fv.WATCH_HOURS), first * second)

    return named(first_match(column, "(?U)" + dimension_pattern()), area)


def labelled_pattern() -> str:
    return rf"\b{fv.AREA_LABEL}\b\s*{NUMBER}\s*({fv.AREA_LABEL_UNITS})"


def labelled_quantity(column: Column | str) -> Column:
    """Number of a labelled area such as "area construida 80 m2"."""
    return first_number(first_match(column, "(?U)" + labelled_pattern()))


def has_any(column: Column | str, words: Sequence[str]) -> Column:
    """Whether a text has any of the plain words as a substring; words that hold another one need no test."""
    c = _col(column)
    least = [w for w in dict.fromkeys(words) if not any(v in w for v in words if v != w)]
    return reduce(lambda a, b: a | b, [c.contains(w) for w in least])


def classify_by_keywords(
    columns: Sequence[Column | str],
    rules: Sequence[tuple] | None = None,
    fallback: Column | str | None = None,
    lowered: bool = False,
) -> Column:
    """First rule that matches the first column that matches any; else the stored value.

    `rules` are (pattern, label) in order of precedence, tried on lower-case text; a third item has plain words of which every
    match holds one, which spares other texts the pattern. `lowered` says that the columns are in lower case already.
    """
    rules = rules or _HOUSING
    parts = []
    for column in columns:
        text = _col(column) if lowered else F.lower(_col(column))
        expr = None
        for pattern, label, *words in rules:
            test = text.rlike("(?U)" + pattern)
            test = has_any(text, words[0]) & test if words else test
            expr = F.when(test, label) if expr is None else expr.when(test, label)
        parts.append(expr)
    if fallback is not None:
        parts.append(_col(fallback))
    return F.coalesce(*parts)


HOUSING_RULES = [
    ("|".join(fv.HOUSE_WORDS), fv.HOUSE),
    (word_pattern(fv.FLAT_WORDS), fv.FLAT),
]
_HOUSING = [(*rule, words) for rule, words in zip(HOUSING_RULES, (fv.HOUSE_WORDS, fv.FLAT_WORDS))]


def count_pattern(words: Mapping[str, int], noun: str) -> str:
    return rf"(?i)(\d+|{'|'.join(words)})\s*(?:{noun})"


def digit_or_word_count(
    column: Column | str,
    noun: str = fv.BATH_NOUN,
    words: Mapping[str, int] = fv.NUMBER_WORDS,
    limit: float = fv.BATH_LIMIT,
) -> Column:
    """A count before a noun, in digits or in words; counts at or over the limit are null.

    Texts without the noun are told apart first by its own pattern.
    """
    c = _col(column)
    token = F.when(c.rlike(f"(?i){noun}"), known(F.regexp_extract(c, count_pattern(words, noun), 1)))
    spelled = F.create_map(*[F.lit(v) for w, n in words.items() for v in (w, float(n))])
    value = named(token, lambda t: F.coalesce(t.try_cast("double"), F.try_element_at(spelled, F.lower(t))))
    return named(value, lambda v: F.when(v < limit, v))


def _edited(word: str, start: int, end: int, rest: str) -> str:
    """The word from `start` on with at most one edit before `end`; `rest` stands for what follows where there was none.

    Letter by letter: either the letter and the rest within one edit, or the edit here and the rest
    as it stands. Sharing prefixes this way keeps the tries per text position few.
    """
    pattern = rest
    for i in reversed(range(start, end)):
        ways = [word[i] + pattern, ".?" + word[i + 1:]]
        if i:
            ways.append("." + word[i:])
        pattern = "(?:" + "|".join(ways) + ")"
    return pattern


def one_edit_pattern(word: str) -> str:
    """Everything within one insertion, deletion or substitution of the word."""
    return "(?s)" + _edited(word, 0, len(word), "")


def half_patterns(word: str) -> list[tuple[str, str]]:
    """(half, pattern) for either half of the word: everything within one edit that leaves this half whole, found from the half on."""
    cut = len(word) // 2
    left, right = word[:cut], word[cut:]
    return [
        (left, f"(?s){left}{_edited(word, cut, len(word), '')}"),
        (right, f"(?s){right}(?<={_edited(word, 0, cut, right)})"),
    ]


def fuzzy_contains(column: Column | str, words: Sequence[str]) -> Column:
    """1 where any word occurs as a substring within one edit, else 0 (null text too).

    One edit leaves one half of the word whole, so a plain substring test of a half goes before the pattern
    of the edits in the other one, which starts from the half: few places of a text are tried.
    """
    c = _col(column)
    tests = [c.contains(half) & c.rlike(pattern) for word in words for half, pattern in half_patterns(word)]
    return F.coalesce(reduce(lambda a, b: a | b, tests).cast("int"), F.lit(0))


def split_label(column: Column | str, separator: str, names: Sequence[str]) -> list[Column]:
    """Parts of a composed label, in order, under the given names."""
    parts = F.split_part
    return [parts(_col(column), F.lit(separator), F.lit(i + 1)).alias(n) for i, n in enumerate(names)]
