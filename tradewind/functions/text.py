"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is a run of cased characters; everything else separates words ("3x" -> "3X", "d'oeste" ->
# "D'Oeste"; a letter without case, as in most scripts, separates too).
_RUNS = r"([\p{IsLowercase}\p{IsUppercase}\p{Lt}]+|[^\p{IsLowercase}\p{IsUppercase}\p{Lt}]+)"

# Characters whose title case is one character of its own, not upper case: four
# digraphs, the Greek letters with iota subscript (in rows of eight, small then title), and the Georgian
# letters, which stay as they are.
_DIGRAPHS = {"\u01c4\u01c5\u01c6": "\u01c5", "\u01c7\u01c8\u01c9": "\u01c8", "\u01ca\u01cb\u01cc": "\u01cb",
             "\u01f1\u01f2\u01f3": "\u01f2"}
_GEORGIAN = (*range(0x10D0, 0x10FB), 0x10FD, 0x10FE, 0x10FF)
_IOTA_ROWS, _IOTA_SINGLE = (0x1F80, 0x1F90, 0x1FA0), ((0x1FB3, 0x1FBC), (0x1FC3, 0x1FCC), (0x1FF3, 0x1FFC))


def _titles() -> dict[str, str]:
    out = {c: t for group, t in _DIGRAPHS.items() for c in group}
    for row in _IOTA_ROWS:
        out |= {chr(row + half + i): chr(row + 8 + i) for half in (0, 8) for i in range(8)}
    for small, title in _IOTA_SINGLE:
        out |= {chr(small): chr(title), chr(title): chr(title)}
    return out | {chr(i): chr(i) for i in _GEORGIAN}


_FROM, _TO = ("".join(x) for x in zip(*_titles().items()))


def title_case(col: Column | str) -> Column:
    """``str.title()`` as a JVM expression; empty or NULL input gives NULL.

    A character that upper case turns into several keeps the first of them upper (as the sharp s
    and ligatures do).  Not so in Python: the letter n after an apostrophe in one character (U+0149) and nine Greek
    letters with an accent and iota subscript; and letters whose case the Unicode tables of Java
    and Python know from different versions on."""
    c = F.col(col) if isinstance(col, str) else col
    runs = F.regexp_extract_all(F.nullif(c, F.lit("")), F.lit(_RUNS), 1)

    def titled(t: Column) -> Column:
        first = F.left(t, F.lit(1))
        upper = F.upper(first)
        head = F.when(F.instr(F.lit(_FROM), first) > 0, F.translate(first, _FROM, _TO)) \
            .otherwise(F.concat(F.left(upper, F.lit(1)), F.lower(F.substr(upper, F.lit(2)))))
        # The whole run is lower-cased, so that a last sigma takes its final form.
        return F.concat(head, F.substr(F.lower(t), F.length(F.lower(first)) + 1))

    return F.array_join(F.transform(runs, titled), "")


def category_label(col: Column | str) -> Column:
    """Display label of a category key: underscores to spaces, then title case."""
    c = F.col(col) if isinstance(col, str) else col
    return title_case(F.replace(c, F.lit("_"), F.lit(" ")))
