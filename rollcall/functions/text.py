"""Text columns: cleaning, casing, tags, keys and search."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, functions as F

from . import lookups


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once, however often `use` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def collapse(text: Column) -> Column:
    """Runs of white space, no-break spaces included, become one space; ends trimmed."""
    return F.trim(F.regexp_replace(text, lookups.SPACES, " "))


def clean_html(fragment: Column) -> Column:
    """Text of an HTML fragment; null gives ''. Only what has tags or entities is searched for them."""

    def plain(text: Column) -> Column:
        for entity, character in lookups.ENTITIES:
            text = F.replace(text, F.lit(entity), F.lit(character))
        return F.regexp_replace(text, lookups.NUMERIC_ENTITY, " ")

    def no_tags(text: Column) -> Column:
        return F.when(F.contains(text, F.lit("<")), F.regexp_replace(text, lookups.HTML_TAG, " ")).otherwise(text)

    def no_entities(text: Column) -> Column:
        return F.when(F.contains(text, F.lit("&")), plain(text)).otherwise(text)

    return collapse(let(no_tags(F.coalesce(fragment, F.lit(""))), no_entities))


def spaced_ampersand(text: Column) -> Column:
    return F.regexp_replace(text, lookups.AMPERSAND, " & ")


def tidy(text: Column) -> Column:
    """Single spaces, ` & ` and `. ` spacing; text with neither mark is not searched for them."""
    marks = F.contains(text, F.lit("&")) | F.contains(text, F.lit("."))
    spaced = F.trim(F.regexp_replace(spaced_ampersand(collapse(text)), lookups.FULL_STOP, ". "))
    return F.when(marks, spaced).otherwise(collapse(text))


#: Not in printable ASCII; the space makes `initcap` begin a word.
_CUT = "\x01 "


def title_case(text: Column) -> Column:
    """Upper case after every non-letter, so `10th` gives `10Th` and `(nct)` gives `(Nct)`.

    Plain ASCII needs no list of runs: `initcap` capitalises after spaces, which are put before the letters behind other marks.
    """

    def capital(run: Column) -> Column:
        head = F.upper(F.substring(run, 1, 1))
        return F.concat(
            F.substring(head, 1, 1), F.lower(F.substr(head, F.lit(2))), F.substr(run, F.lit(2))
        )

    runs = F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    any_text = F.array_join(F.transform(runs, capital), "")
    marked = F.initcap(F.regexp_replace(text, r"(?<=[^A-Za-z ])(?=[A-Za-z])", _CUT))
    return (
        F.when(text.rlike(r"^[A-Za-z ]*\z"), F.initcap(text))
        .when(text.rlike(r"^[ -~]*\z"), F.replace(marked, F.lit(_CUT), F.lit("")))
        .otherwise(any_text)
    )


def and_to_ampersand(text: Column) -> Column:
    """The whole word `And` becomes `&`; `Andhra` is left alone."""
    return F.regexp_replace(text, lookups.WORD_AND, "&")


def alias(text: Column, names: dict[str, str]) -> Column:
    """The listed name for `text`, or `text` itself."""
    table = F.create_map(*[F.lit(part) for pair in names.items() for part in pair])
    return F.coalesce(F.try_element_at(table, text), text)


def conform_state(text: Column) -> Column:
    """One spelling of a state; `Jammu&Kashmir` and `Jammu And Kashmir` are one."""
    name = and_to_ampersand(title_case(spaced_ampersand(collapse(text))))
    return let(name, lambda n: alias(n, lookups.STATE_ALIASES))


def seat_category(seat: Column) -> Column:
    """SC, ST or GEN from the tag in a seat name."""
    return (
        F.when(seat.rlike(lookups.SEAT_IS_SC), "SC")
        .when(seat.rlike(lookups.SEAT_IS_ST), "ST")
        .otherwise("GEN")
    )


def strip_seat_tag(seat: Column) -> Column:
    return F.trim(F.regexp_replace(seat, lookups.SEAT_TAG_AT_END, ""))


def label(text: Column, default: str = "UNKNOWN") -> Column:
    """Upper-case tidy label; missing gives `default`."""
    return F.upper(F.coalesce(tidy(text), F.lit(default)))


def key_part(text: Column) -> Column:
    """Letters A-Z only, seat tags dropped and `&` read as AND."""
    text = F.regexp_replace(F.upper(F.coalesce(text, F.lit(""))), lookups.SEAT_TAG_IN_KEY, "")
    return F.regexp_replace(F.replace(text, F.lit("&"), F.lit(" AND ")), "[^A-Z]", "")


def place_key(state: Column, seat: Column) -> Column:
    """`STATE|SEAT` join key tolerant of case, spacing, tags and `&`."""
    return F.concat_ws("|", key_part(state), key_part(seat))


def contains_any(needle: str, columns: list[str]) -> Column:
    """Case-blind substring test over several columns; null holds no text."""
    tests = [
        F.contains(F.lower(F.coalesce(F.col(name), F.lit(""))), F.lit(needle.lower()))
        for name in columns
    ]
    return reduce(lambda a, b: a | b, tests)
