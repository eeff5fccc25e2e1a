"""Fields of web pages by selectors, as Column expressions."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillweave.functions.text import squeeze

#: Elements that hold nothing.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
#: Character references of texts; the ampersand's comes last.
REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&"))

_QUOTED = r""""[^"]*+"|'[^']*+'"""
_TAG = rf"""</?[a-zA-Z](?:[^>"']++|{_QUOTED})*+>"""
_TOKEN = rf"(?s)<!--.*?-->|<![^>]*+>|(?i:<(?:script|style)\b[^>]*+>.*?</(?:script|style)\s*>)|{_TAG}|[^<]++|<"


@dataclass(frozen=True)
class Field:
    """What a field of a page is: the text of the elements of a selector, or one of their attributes.

    A selector is a list of elements, each inside the one before it, or its child if `>` stands between; an element is a tag
    or `*`, with `#id` and `.class` if wanted; the last may end with `[name]` or `[name=value]`. A field has one element at
    most unless it is `many` (then it is an array, in the page's order); `required` ones have at least one."""

    selector: str
    attr: str | None = None
    many: bool = False
    required: bool = False


def _compiled(selector: str) -> tuple[str, str | None, str | None]:
    """(pattern of the path of open elements, attribute that has to be there, its value)."""
    wanted = re.fullmatch(r"(.*?)(?:\[([\w-]+)(?:=([^\]]*))?\])?", selector.strip())
    pattern, child = "^", False
    for step in wanted[1].split():
        if step == ">":
            child = True
            continue
        tag, names = re.match(r"[\w*-]*", step)[0], re.findall(r"[#.][\w-]+", step)
        if tag + "".join(names) != step:
            raise ValueError(f"no selector: {selector}")
        pattern += "" if child else "(?:/[^/]*)*?"
        pattern += "/" + ("[^/#.]*" if tag in ("", "*") else re.escape(tag.lower()))
        pattern += "".join(rf"(?=[^/]*{re.escape(n)}(?:[#./]|$))" for n in names) + "(?:[#.][^/]*)?"
        child = False
    return pattern + "$", wanted[2], wanted[3]


def attribute(tag: Column, name: str) -> Column:
    """The value of an attribute inside a tag; null when it has none of that name."""
    pattern = rf"""(?is)^<[^\s>/]+(?:\s+(?!{name}[\s=/>])[^\s=>/]+(?:\s*=\s*(?:{_QUOTED}|[^\s"'>]++))?)*+\s+{name}(?=[\s=/>])(?:\s*=\s*(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?"""
    return F.when(tag.rlike(pattern), references(F.concat(*[F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)])))


def references(text: Column) -> Column:
    for name, char in REFERENCES:
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def _let(value: Column, f) -> Column:
    """f(value) with the value worked out once."""
    return F.transform(F.array(value), lambda v: f(v))[0]


def _element(tag: Column) -> Column:
    """The step of an element in a path: /tag#id.class.class."""
    name = F.lower(F.regexp_extract(tag, r"^</?([a-zA-Z][^\s/>]*)", 1))
    safe = lambda v: F.regexp_replace(v, r"[/#.]", "_")
    names = F.filter(F.split(F.coalesce(attribute(tag, "class"), F.lit("")), r"\s+"), lambda c: c != "")
    own_id = F.coalesce(F.concat(F.lit("#"), safe(F.trim(F.nullif(attribute(tag, "id"), F.lit(""))))), F.lit(""))
    return F.concat(F.lit("/"), name, own_id, F.array_join(F.transform(names, lambda c: F.concat(F.lit("."), safe(c))), ""))


def elements(tokens: Column, paths: list[str]) -> Column:
    """array<struct<from, to, path>> of the elements whose path fits one of the patterns, by their place: the tokens from
    their tag to the one that ends them.

    Tags are folded into a stack of open elements. An end closes the last open element of its name and all inside it; an end of none
    is passed over; a paragraph ends where the next one of the same parent begins; what is open at the end of the page ends there."""
    node = "struct<at: int, tag: string, path: string>"
    hit = "struct<`from`: int, `to`: int, path: string>"
    none = lambda t: F.array().cast(f"array<{t}>")
    fits = lambda path: path.rlike("|".join(f"(?:{p})" for p in paths))
    marked = F.transform(tokens, lambda t, i: F.struct(i.alias("i"), t.alias("t")))
    tags = F.transform(
        F.filter(marked, lambda x: x["t"].rlike(r"^</?[a-zA-Z]") & ~x["t"].rlike(r"(?is)^<(?:script|style)\b.*</(?:script|style)\s*>$")),
        lambda x: F.struct(x["i"].alias("i"), x["t"].startswith("</").alias("end"), F.lower(F.regexp_extract(x["t"], r"^</?([a-zA-Z][^\s/>]*)", 1)).alias("tag"), x["t"].endswith("/>").alias("alone"), _element(x["t"]).alias("step")))

    def closed(s: Column, keep: Column, to: Column) -> Column:
        """The state with only so many open elements left."""
        gone = F.filter(F.slice(s["open"], keep + 1, F.greatest(F.size(s["open"]) - keep, F.lit(0))), lambda n: fits(n["path"]))
        return F.struct(F.slice(s["open"], F.lit(1), keep).alias("open"), F.concat(s["found"], F.transform(gone, lambda n: F.struct(n["at"].alias("from"), to.cast("int").alias("to"), n["path"].alias("path"))).cast(f"array<{hit}>")).alias("found"))

    def opened(s: Column, x: Column) -> Column:
        path = F.concat(F.coalesce(F.element_at(F.transform(s["open"], lambda n: n["path"]), F.when(F.size(s["open"]) > 0, F.lit(-1)).otherwise(F.lit(None).cast("int"))), F.lit("")), x["step"])
        single = x["alone"] | x["tag"].isin(*VOID)
        alone = F.when(single & fits(path), F.array(F.struct(x["i"].alias("from"), x["i"].alias("to"), path.alias("path")))).otherwise(none(hit))
        return F.struct(
            F.when(single, s["open"]).otherwise(F.concat(s["open"], F.array(F.struct(x["i"].alias("at"), x["tag"].alias("tag"), path.alias("path"))).cast(f"array<{node}>"))).alias("open"),
            F.concat(s["found"], alone.cast(f"array<{hit}>")).alias("found"))

    def step(s: Column, x: Column) -> Column:
        # how many elements lie below the last open one of this name; all when there is none
        n = F.size(s["open"])
        same = F.array_position(F.reverse(F.transform(s["open"], lambda o: o["tag"])), x["tag"]).cast("int")
        below = F.when(same > 0, n - same).otherwise(n)
        ends = x["end"] | ((x["tag"] == "p") & (same == 1))
        left = F.when(ends, _let(below, lambda b: closed(s, b, x["i"]))).otherwise(s)
        return F.when(x["end"], left).otherwise(_let(left, lambda t: opened(t, x)))

    start = F.struct(none(node).alias("open"), none(hit).alias("found"))
    return F.array_sort(F.aggregate(tags, start, step, lambda s: closed(s, F.lit(0), F.size(tokens))["found"]))


def page_fields(pages: DataFrame, spec: dict[str, Field], html: str = "html") -> tuple[DataFrame, DataFrame]:
    """(pages with the spec's fields as columns, pages with the reason of the first field that is not as declared).

    Texts have their tags, comments, scripts and styles taken out, their references read and their blanks squeezed; empty
    ones are null. A null page has no element. An element without the attribute that a field asks for is an error."""
    compiled = {name: _compiled(f.selector) for name, f in spec.items()}
    paths = sorted({c[0] for c in compiled.values()})

    def fields(tokens: Column, found: Column) -> Column:
        tag = lambda e: F.element_at(tokens, e["from"] + 1)

        def text(e: Column) -> Column:
            inside = F.slice(tokens, e["from"] + 2, F.greatest(e["to"] - e["from"] - 1, F.lit(0)))
            words = F.filter(inside, lambda t: ~t.rlike(r"^<[!/a-zA-Z]"))
            return F.nullif(F.trim(squeeze(references(F.array_join(words, "")))), F.lit(""))

        values = []
        for name, field in spec.items():
            path, attr, value = compiled[name]
            own = F.filter(found, lambda e: e["path"].rlike(path))
            if attr is not None:
                own = F.filter(own, lambda e: attribute(tag(e), attr).isNotNull() if value is None else attribute(tag(e), attr).eqNullSafe(F.lit(value)))
            values.append(F.transform(own, lambda e: text(e) if field.attr is None else attribute(tag(e), field.attr)).alias(name))
        return F.struct(*values)

    tokens = F.coalesce(F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(0)), F.array().cast("array<string>"))
    # generated, so that no filter is pushed below it and has all fields worked out a second time
    page = pages.select("*", F.explode(F.array(_let(tokens, lambda t: _let(elements(t, paths), lambda e: fields(t, e))))).alias("__page"))
    reason = F.lit(None).cast("string")
    for name, field in spec.items():
        held = F.col(f"__page.{name}")
        wrong = F.when(F.lit(field.required) & (F.size(held) == 0), f"missing {name}").when(F.lit(not field.many) & (F.size(held) > 1), f"several {name}")
        if field.attr is not None:
            wrong = wrong.when(F.exists(held, lambda v: v.isNull()), f"no {field.attr} of {name}")
        reason = F.coalesce(reason, wrong)
    page = page.withColumn("__reason", reason)
    columns = [(F.col(f"__page.{name}") if f.many else F.get(F.col(f"__page.{name}"), F.lit(0))).alias(name) for name, f in spec.items()]
    own = [c for c in pages.columns if c != html]
    return page.filter("__reason IS NULL").select(*own, *columns), page.filter("__reason IS NOT NULL").select(*pages.columns, F.col("__reason").alias("reason"))
