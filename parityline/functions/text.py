"""Text rules for view descriptions and view definitions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The heading of a key section, and the headings that end it.
KEY_HEADING = "Primary Key"
SECTION_HEADINGS = (
    "Change Log",
    "Changelog",
    "Not null",
    "MEGA Equivalent Table",
    "Foreign Key",
    "Not Null",
    "Data grain",
)

# Words that make a view more than a plain select, in the order
# in which they are tried.
SQL_KEYWORDS = (
    "join", "inner join", "left join", "right join", "full join", "cross join",
    "left outer join", "right outer join", "full outer join",
    "union", "union all", "intersect", "except", "minus",
    "with", "exists", "in", "not in", "any", "all",
    "group by", "having", "order by", "distinct",
    "count", "sum", "avg", "min", "max",
    "over", "partition by", "row_number", "rank", "dense_rank", "lead", "lag", "ntile",
    "case", "when", "then", "else", "end", "coalesce", "nullif", "decode",
    "explode", "posexplode", "unnest", "lateral view", "json_extract", "get_json_object",
    "cast", "convert", "like", "ilike", "regexp", "between", "is null", "is not null",
    "insert", "update", "delete", "merge", "truncate",
)


def _any_of(words: list[str]) -> str:
    """Regex for any of ``words``, the first listed one winning at each place.

    Words are grouped by initial and every four initials share a test, so a place
    where no word starts is left after a few steps, however many words there are.
    """
    rests: dict[str, list[str]] = {}
    for word in words:
        rests.setdefault(word[0], []).append(re.escape(word[1:]).replace(r"\ ", " "))
    initials = list(rests)
    fours = [initials[i : i + 4] for i in range(0, len(initials), 4)]
    return "|".join(
        f"(?=[{''.join(four)}])(?:" + "|".join(f"{c}(?:{'|'.join(rests[c])})" for c in four) + ")"
        for four in fours
    )


def section_end_forms() -> list[str]:
    """The ending headings: as is, unspaced or snake, each in three cases."""
    spaced = [h.replace(" ", sep) for h in SECTION_HEADINGS for sep in (" ", "", "_")]
    return list(dict.fromkeys(f for s in spaced for f in (s, s.lower(), s.upper())))


def key_section(description: Column) -> Column:
    """Text from the last key heading up to the next heading; null without one."""
    tail = F.substring_index(description, KEY_HEADING, -1)
    body = F.get(F.split(tail, _any_of(section_end_forms()), 2), F.lit(0))
    return F.when(F.contains(description, F.lit(KEY_HEADING)), F.concat(F.lit(KEY_HEADING), body))


def columns_named_in(section: Column, columns: Column, whole_words: bool = False) -> Column:
    """Declared columns mentioned in ``section``, in declared order, else null.

    A mention is any substring, so ``id`` is found inside ``order_id``;
    ``whole_words`` asks for the name as a word of its own.
    """
    if whole_words:
        words = F.split(section, r"[^A-Za-z0-9_]+")
        found = F.filter(columns, lambda c: F.array_contains(words, c))
    else:
        found = F.filter(columns, lambda c: F.contains(section, c))
    return F.when(F.size(found) > 0, found)


def without_comment_lines(sql: Column) -> Column:
    """Drop every line that contains ``--`` anywhere."""
    kept = F.filter(F.split(sql, "\n"), lambda line: ~F.contains(line, F.lit("--")))
    return F.when(F.contains(sql, F.lit("--")), F.array_join(kept, "\n")).otherwise(sql)


def first_keyword(code: Column, loose: bool = False) -> Column:
    """First listed keyword standing between blanks, all lower or all upper case.

    One pass finds all keywords; the blank after a keyword may also open the
    next one. With ``loose`` the code must come from ``loosened``, and longer
    keywords go first.
    """
    words = sorted(SQL_KEYWORDS, key=lambda w: -w.count(" ")) if loose else list(SQL_KEYWORDS)
    forms = words if loose else words + [w.upper() for w in words]
    found = F.array_distinct(F.regexp_extract_all(code, F.lit(f" (?=({_any_of(forms)}) )"), F.lit(1)))
    listed = F.array(*[F.lit(w) for w in words])
    return F.get(F.array_intersect(listed, F.transform(found, F.lower)), F.lit(0))


def loosened(code: Column) -> Column:
    """Lower case, with brackets, commas and any white space turned into blanks."""
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(code), r"[\s(),;]+", " "), F.lit(" "))
