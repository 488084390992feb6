"""Texts made from columns: documents, prompts and strict templates."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

_FIELD = re.compile(r"\{(\w+)\}")


def template(text: str, values: Mapping[str, Column]) -> Column:
    """text with each {field} replaced by its column (null: empty). Unknown and unused fields raise KeyError."""
    fields = _FIELD.findall(text)
    if missing := set(fields) - set(values):
        raise KeyError(f"no value for {sorted(missing)}")
    if extra := set(values) - set(fields):
        raise KeyError(f"no place for {sorted(extra)}")
    parts = _FIELD.split(text)
    return F.concat(*[F.coalesce(values[p].cast("string"), F.lit("")) if i % 2 else F.lit(p) for i, p in enumerate(parts)])


def ad_text(title: Column, description: Column, longest: int | None = None) -> Column:
    """"title. description", with nulls as empty; the description trimmed to its first characters where longest is set."""
    d = F.coalesce(description, F.lit(""))
    if longest is not None:
        d = F.trim(F.substring(d, 1, longest))
    return F.concat(F.coalesce(title, F.lit("")), F.lit(". "), d)


def joined(items: Column, separator: str, most: int | None = None) -> Column:
    """The list's items in one text; null if there are none, so that concat_ws leaves the section out."""
    items = F.slice(items, 1, most) if most is not None else items
    return F.when(F.size(items) > 0, F.array_join(items, separator))


def occupation_text(title: Column, description: Column, alternate: Column, tasks: Column, most_titles: int | None = None, most_tasks: int | None = None) -> Column:
    """Title, other titles, description and key tasks, a blank line between, empty sections left out."""
    also, key = joined(alternate, ", ", most_titles), joined(tasks, "; ", most_tasks)
    section = lambda name, x: F.when(x.isNotNull() & (x != ""), F.concat(F.lit(name + ": "), x))
    return F.concat_ws("\n\n", section("Title", title), section("Also known as", also), section("Description", description), section("Key tasks", key))


def numbered(items: Column) -> Column:
    """"1. first\\n2. second" of a list of texts."""
    return F.array_join(F.transform(items, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n")


def shortened(text: Column, longest: int) -> Column:
    """text, or its beginning with three dots, in at most `longest` characters."""
    return F.when(F.length(text) <= longest, text).otherwise(F.concat(F.substring(text, 1, longest - 3), F.lit("...")))


def without_tags(html: Column) -> Column:
    return F.regexp_replace(html, r"<[^>]+>", "")
