"""Author lists: JSON or delimited text in, an ordered distinct list out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordmill.functions.strings import let, or_blank, strip, stripped

# Output separator, and input separators by priority.
AUTHOR_SEPARATOR = " | "
SEPARATORS = ["|", ";", ","]
# Object members that may hold a name, by priority.
ITEM_NAME_KEYS = ["name", "author", "full_name"]
TOP_LEVEL_NAME_KEYS = ["name", "author"]


def _member_text(item: Column, key: str) -> Column:
    """A member as text, null when it is absent or empty (0, false, "", [] and {})."""

    def if_true(member: Column, text: Column, kind: Column) -> Column:
        return (
            F.when(kind == "STRING", F.when(text != "", text))
            .when(kind == "BOOLEAN", F.when(text == "true", F.lit("True")))
            .when(text.rlike(r"^-?0*\.?0*(?:[eE].*)?\z") | text.isin("[]", "{}"), F.lit(None))
            .otherwise(text)
        )

    return let(
        F.try_variant_get(item, f"$.{key}", "variant"),
        lambda m: if_true(m, F.try_variant_get(m, "$", "string"), F.schema_of_variant(m)),
    )


def _name(item: Column, keys: list[str]) -> Column:
    return F.coalesce(*[_member_text(item, k) for k in keys])


def authors_from_json(c: Column) -> Column:
    """Names of a JSON list or object; null when the text holds none of these."""
    s = stripped(c)

    def name_of(item: Column) -> Column:
        kind = F.schema_of_variant(item)
        return F.when(kind == "STRING", F.try_variant_get(item, "$", "string")).when(
            F.startswith(kind, F.lit("OBJECT")), _name(item, ITEM_NAME_KEYS)
        )

    def names_of(doc: Column) -> Column:
        names = F.when(
            F.startswith(s, F.lit("[")),
            F.transform(F.try_variant_get(doc, "$", "array<variant>"), name_of),
        ).otherwise(F.array(_name(doc, TOP_LEVEL_NAME_KEYS)))
        return F.filter(names, lambda n: n.isNotNull())

    def if_any(found: Column) -> Column:
        return F.when(F.size(found) > 0, F.transform(found, strip))

    return F.when(
        s.rlike(r"^[\[{]"), let(F.try_parse_json(s), lambda doc: let(names_of(doc), if_any))
    )


def authors_from_delimited(c: Column) -> Column:
    """Parts of the text at the first separator kind that occurs in it."""
    s = stripped(c)
    parts = F.array(s)
    for mark in reversed(SEPARATORS):
        parts = F.when(F.contains(s, F.lit(mark)), F.split(s, f"[{mark}]")).otherwise(parts)
    return F.transform(parts, strip)


def dedup_ci_ordered(names: Column) -> Column:
    """First spelling of each name, compared without letter case; empty names dropped."""

    def first_spellings(kept: Column, lowered: Column) -> Column:
        repeats = F.size(F.array_distinct(lowered)) < F.size(lowered)
        return F.when(
            repeats,
            F.filter(kept, lambda n, i: F.array_position(lowered, lowered[i]) == i + 1),
        ).otherwise(kept)

    return let(
        F.filter(names, lambda n: n != ""),
        lambda kept: let(
            F.transform(kept, F.lower), lambda lowered: first_spellings(kept, lowered)
        ),
    )


def author_list(c: Column) -> Column:
    return dedup_ci_ordered(F.coalesce(authors_from_json(c), authors_from_delimited(c)))


def normalize_authors(c: Column) -> Column:
    return or_blank(F.array_join(author_list(c), AUTHOR_SEPARATOR))


def split_people(c: Column) -> Column:
    """Names of a page's author field: split, stripped, empties dropped, repeats kept."""
    return F.filter(
        F.transform(F.split(or_blank(c), r"[;,\n]"), strip), lambda n: n != ""
    )
