"""Canonical rows of profiles and job posts: one declarative description a source, compiled into one projection."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillweave.functions import text as t


@dataclass(frozen=True)
class Source:
    """What a source's rows hold.

    name: the source's part of keys. keys: column -> (type of entity, the column that it is made of). titles: columns whose parsed title and
    prefix words are given too. nested: array column -> keys of its elements (with `start` and `end`, dates are repaired and `days` added).
    history: "career" (first, last and current experience, first and last education), "starts" (least and greatest start only)
    or "" for none. lengths: columns, or column.field of arrays, whose characters make `text_length`."""

    name: str
    keys: dict[str, tuple[str, str]]
    titles: tuple[str, ...] = ()
    nested: dict[str, dict[str, tuple[str, str]]] = field(default_factory=dict)
    history: str = ""
    lengths: tuple[str, ...] = ()
    company_flag: str | None = None
    location: tuple[str, ...] = ()


CAREERS = Source(
    "careers",
    {"nrm_title": ("title", "title"), "nrm_curr_title": ("title", "curr_title"), "nrm_first_title": ("title", "first_title"), "nrm_sector": ("sector", "sector"), "nrm_company": ("company", "company"),
     "nrm_first_company": ("company", "first_company"), "nrm_last_institute": ("institute", "last_institute"), "nrm_last_degree": ("degree", "last_degree"), "nrm_last_subject": ("subject", "last_subject")},
    ("title", "curr_title", "first_title"),
    {"experiences": {"nrm_title": ("title", "title"), "nrm_company": ("company", "company")}, "educations": {"nrm_institute": ("institute", "institute"), "nrm_degree": ("degree", "degree"), "nrm_subject": ("subject", "subject")}, "skills": {"nrm_name": ("skill", "name")}},
    "career", ("title", "description", "experiences.title", "experiences.description", "skills.name"), "name", ("location",))
FREELANCERS = Source("freelancers", {"nrm_title": ("title", "title")}, ("title",), {"experiences": CAREERS.nested["experiences"], "educations": CAREERS.nested["educations"], "skills": CAREERS.nested["skills"]}, "starts", CAREERS.lengths, None, ("location",))
POSTS = Source("posts", {"nrm_title": ("job_title", "title"), "nrm_company": ("company", "company")}, ("title",), {"skills": CAREERS.nested["skills"]}, "", ("title", "description", "skills.name"), None, ("location4", "location3", "location2", "location1", "location0"))


def _prefix(title: Column) -> Column:
    words = t.split_title(F.split(t.parsed_title(title), " "))["prefix"]
    return F.nullif(words, F.lit(""))


def _dated(column: str, fields: list[str]) -> Column:
    """An array's elements with dates that run backwards both null, and an end without a start null."""

    def one(e: Column) -> Column:
        bad = F.coalesce(e["start"] > e["end"], F.lit(False))
        start, end = F.when(~bad, e["start"]), F.when(~bad & e["start"].isNotNull(), e["end"])
        value = {c: e[c] for c in fields} | {"start": start, "end": end, "days": F.datediff(end, start)}
        return F.struct(*[v.alias(k) for k, v in value.items()])

    return F.transform(column, one)


def _keyed(column: str, source: Source, lang: Column, fields: list[str], stop: tuple[str, ...]) -> Column:
    """An array's elements with their keys."""

    def one(e: Column) -> Column:
        keys = [t.entity_key(entity, source.name, lang, e[made_of], stop).alias(name) for name, (entity, made_of) in source.nested[column].items() if made_of in fields]
        return F.struct(*[e[c].alias(c) for c in fields], *keys)

    return F.transform(column, one)


def _by_start(array: str, last: bool, where=None) -> Column:
    """The element of an array with the least or greatest start, the first of equal ones; null when none has a start."""
    places = F.filter(F.transform(array, lambda e, i: F.struct(e["start"].alias("start"), (-i if last else i).alias("i"), (where(e) if where else F.lit(True)).alias("fits"))), lambda x: x["start"].isNotNull() & x["fits"])
    best = F.array_max(places) if last else F.array_min(places)
    return F.get(array, F.abs(best["i"]))


def _single(array: str) -> Column:
    return F.when(F.size(array) == 1, F.get(F.col(array), F.lit(0)))


def _history(df: DataFrame, source: Source) -> DataFrame:
    starts = lambda c: F.transform(c, lambda e: e["start"])
    if source.history == "starts":
        ends = {f"{which}_{what}_start": f(starts(f"{what}s")) for what in ("experience", "education") for which, f in (("first", F.array_min), ("last", F.array_max))}
        return df.withColumns(ends)
    if source.history != "career":
        return df
    both = df.withColumns({
        "__first": F.coalesce(_single("experiences"), _by_start("experiences", False)), "__last": F.coalesce(_single("experiences"), _by_start("experiences", True)),
        "__now": F.coalesce(_single("experiences"), _by_start("experiences", True, lambda e: e["end"].isNull())),
        "__school": F.coalesce(_single("educations"), _by_start("educations", True)), "__school1": F.coalesce(_single("educations"), _by_start("educations", False))})
    # a headline of two parts names what the experiences don't
    parts = F.split("title", " at ")
    filled = lambda c: F.nullif(c, F.lit(""))
    out = both.withColumns({
        "first_title": F.col("__first.title"), "first_company": F.col("__first.company"), "first_experience_start": F.col("__first.start"), "last_experience_start": F.col("__last.start"),
        "curr_title": F.coalesce(filled(F.col("__now.title")), filled(parts[0])), "company": F.coalesce(filled(F.col("__now.company")), filled(F.get(parts, F.lit(1)))),
        "last_institute": F.col("__school.institute"), "last_degree": F.col("__school.degree"), "last_subject": F.col("__school.subject"),
        "first_education_start": F.col("__school1.start"), "last_education_start": F.col("__school.start"), "last_education_end": F.col("__school.end"),
        "n_experiences": F.coalesce(F.size("experiences"), F.lit(0)).cast("long"), "n_educations": F.coalesce(F.size("educations"), F.lit(0)).cast("long")})
    return out.drop("__first", "__last", "__now", "__school", "__school1")


def _length(df: DataFrame, path: str) -> Column:
    head, _, inner = path.partition(".")
    if head not in df.columns:
        return F.lit(0)
    if not inner:
        return F.coalesce(F.length(head), F.lit(0))
    fields = df.schema[head].dataType.elementType.names
    return F.coalesce(F.aggregate(head, F.lit(0), lambda s, e: s + F.coalesce(F.length(e[inner]), F.lit(0))), F.lit(0)) if inner in fields else F.lit(0)


def canonical(rows: DataFrame, source: Source, lang: str = "language", stop: tuple[str, ...] = ()) -> DataFrame:
    """rows of a source with nested elements keyed and dated, their history, keys, titles, location and length of text.

    A null array counts as empty, a null name has a null key; columns of the source that rows don't have give nothing.
    Everything is a projection: no row meets another, nothing is shuffled."""
    language = F.col(lang)
    nested = [c for c in source.nested if c in rows.columns]
    fields = {c: rows.schema[c].dataType.elementType.names for c in nested}
    out = _history(rows.withColumns({c: _dated(c, f) for c, f in fields.items() if {"start", "end"} <= set(f)}), source)
    # keys come last, so that those which nobody reads are pruned
    new = {c: _keyed(c, source, language, out.schema[c].dataType.elementType.names, stop) for c in nested}
    for name, (entity, made_of) in source.keys.items():
        if made_of in out.columns:
            new[name] = t.entity_key(entity, source.name, language, F.col(made_of), stop)
    for c in source.titles:
        if c in out.columns:
            new["parsed_title" if c == "title" else f"parsed_{c}"] = t.parsed_title(F.col(c))
            new[f"{c}_prefix"] = _prefix(F.col(c))
    places = [c for c in source.location if c in out.columns]
    if places:
        # the most specific level first, repeats and empty ones left out
        levels = F.array_distinct(F.filter(F.array(*[t.squeeze(F.lower(F.trim(c))) for c in places]), lambda x: F.coalesce(x, F.lit("")) != ""))
        new["nrm_location"] = F.nullif(F.array_join(levels, ", "), F.lit(""))
    if source.company_flag and source.company_flag in out.columns:
        new["is_company"] = t.is_company(F.col(source.company_flag))
    new["text_length"] = sum((_length(out, p) for p in source.lengths), F.lit(0)).cast("long")
    return out.withColumns(new)
