"""Fields out of landed HTML pages by CSS paths, as column expressions.

A page is cut into tags and texts, and one pass over its tags keeps the open elements:
for each how far the path leads to it, as bits, and how many children it has had. So
nested and repeated tags are told apart, whatever the order of attributes; comments,
scripts and styles are passed over, and what is left open is closed by what follows.
Pages stay in the JVM and nothing is shuffled.

A path is made of steps ``tag.class#id[attribute][attribute=value]:first-child`` or
``:nth-child(n)`` (any part may be missing), joined by a space (somewhere inside) or
``>`` (a child of).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from martflow.sources.pages import unescaped

# A tag ends at the first ">"; attributes that hold one aren't read whole.
_TOKEN = (
    r"(?is)<!--.*?(?:-->|\z)|<script\b[^>]*>.*?(?:</script\s*>|\z)|<style\b[^>]*>.*?(?:</style\s*>|\z)"
    r"|<[!?][^>]*>|</?[a-z][^>]*>|[^<]+|<"
)
# Elements without content, and what an opening tag closes, up to which outer element.
_EMPTY = "area base br col embed hr img input link meta source track wbr script style".split()
_CLOSES = {
    "li": (["li"], ["ul", "ol"]), "dt": (["dt", "dd"], ["dl"]), "dd": (["dt", "dd"], ["dl"]), "option": (["option"], ["select"]),
    "tr": (["tr"], ["table", "thead", "tbody", "tfoot"]), "td": (["td", "th"], ["tr"]), "th": (["td", "th"], ["tr"]),
    "p": (["p"], ["div", "td", "th", "li", "dd", "section", "article", "body"]),
}
_TEXT, _OPEN, _CLOSE, _ALONE, _OTHER = range(5)


class Step(NamedTuple):
    child: bool  # of the element of the step before, else somewhere inside it
    tag: str
    classes: list[str]
    attributes: list[tuple[str, str | None]]
    place: int | None


def parse(path: str) -> list[Step]:
    steps, child = [], False
    for part in re.findall(r">|(?:[^\s>\[]|\[[^\]]*\])+", path):
        if part == ">":
            child = True
            continue
        rest = re.fullmatch(r"(\*|[\w-]*)((?:\.[\w-]+|#[\w-]+|\[[\w-]+(?:=[^\]]*)?\]|:first-child|:nth-child\(\d+\))*)", part)
        if rest is None:
            raise ValueError(f"{part!r} in {path!r} is no step of a path")
        classes = re.findall(r"\.([\w-]+)", re.sub(r"\[[^\]]*\]", "", rest[2]))
        attributes = [("id", x) for x in re.findall(r"#([\w-]+)", re.sub(r"\[[^\]]*\]", "", rest[2]))]
        attributes += [(name, value[1:].strip("\"'") if value else None) for name, value in re.findall(r"\[([\w-]+)(=[^\]]*)?\]", rest[2])]
        place = re.search(r":nth-child\((\d+)\)", rest[2])
        steps.append(Step(child and bool(steps), rest[1].lower().replace("*", ""), classes, attributes,
                          int(place[1]) if place else 1 if ":first-child" in rest[2] else None))
        child = False
    if not 0 < len(steps) <= 60:
        raise ValueError(f"{path!r} has {len(steps)} steps")
    return steps


def page_tokens(html: Column) -> Column:
    """The tags, comments and texts of a page, in order."""
    return F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(0))


def _attribute(tag: Column, name: str) -> Column:
    """An attribute's value, empty where it has none; null where the tag lacks it."""
    start = rf"(?is)\s{re.escape(name)}"
    value = F.concat(*[F.regexp_extract(tag, rf"""{start}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", i) for i in (1, 2, 3)])
    return F.when(tag.rlike(rf"{start}(?:\s*=|[\s/>])"), unescaped(value))


def _fits(tag: Column, name: Column, step: Step) -> Column:
    found = name == step.tag if step.tag else F.lit(True)
    words = F.split(F.coalesce(_attribute(tag, "class"), F.lit("")), r"\s+")
    for each in step.classes:
        found = found & F.array_contains(words, each)
    for attribute, value in step.attributes:
        own = _attribute(tag, attribute)
        found = found & (own.isNotNull() if value is None else F.coalesce(own == value, F.lit(False)))
    return found


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _one_of(values: list[str]) -> Callable[[Column], Column]:
    return lambda x: x.isin(values)


def _bits(found: list[Column]) -> Column:
    return reduce(Column.bitwiseOR, [F.when(x, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, x in enumerate(found)])


def _tag_of(token: Column, i: Column, steps: list[Step]) -> Column:
    """What the pass needs to know of a token: place, kind, name, and the steps it fits."""
    # Inside a lambda nothing is shared by itself: the name is taken out once.
    return _let(F.lower(F.regexp_extract(token, r"^</?([A-Za-z][^\s/>]*)", 1)), lambda name: _named(token, i, name, steps))


def _named(token: Column, i: Column, name: Column, steps: list[Step]) -> Column:
    kind = (
        F.when(~token.startswith("<") | (token == "<"), _TEXT).when(name == "", _OTHER).when(token.startswith("</"), _CLOSE)
        .when(name.isin(_EMPTY) | token.endswith("/>"), _ALONE).otherwise(_OPEN)
    )
    return F.struct(i.alias("i"), kind.alias("kind"), name.alias("name"), _bits([_fits(token, name, s) for s in steps]).alias("fits"))


_ELEMENT = "struct<name:string,at:bigint,above:bigint,start:int,kids:int>"
_FOUND = "struct<start:int,stop:int,at:bigint>"
_STATE = f"struct<open:array<{_ELEMENT}>,found:array<{_FOUND}>>"


def matches(tokens: Column, path: str) -> Column:
    """array<struct<start, stop>>: first and last token of every element that ``path`` leads to, in order of their starts."""
    return F.transform(_elements(tokens, [parse(path)]), lambda e: F.struct(e["start"].alias("start"), e["stop"].alias("stop")))


def _ends(paths: list[list[Step]]) -> list[int]:
    """The bit of each path's last step."""
    return [1 << (n - 1) for n in accumulate(map(len, paths))]


def _elements(tokens: Column, paths: list[list[Step]]) -> Column:
    """array<struct<start, stop, at>>: the elements that any of ``paths`` leads to, by one pass; ``at`` has the paths' last bits."""
    steps = [s for path in paths for s in path]
    firsts = [0, *accumulate(map(len, paths))][:-1]
    first = F.lit(sum(1 << i for i in firsts)).cast("long")
    last = F.lit(sum(_ends(paths))).cast("long")
    children = F.lit(sum(1 << i for i, s in enumerate(steps) if i not in firsts and s.child)).cast("long")
    inside = F.lit(sum(1 << i for i, s in enumerate(steps) if i not in firsts and not s.child)).cast("long")

    def placed(n: Column) -> Column:
        return _bits([F.lit(True) if s.place is None else n == s.place for s in steps])

    def left_open(state: Column, tag: Column) -> Column:
        """How many elements are open still before an opening tag, or after a closing one. The first one is the page."""
        n, names = F.size(state["open"]), F.reverse(F.transform(state["open"], lambda e: e["name"]))
        closed = F.array_position(names, tag["name"])
        size = F.when(tag["kind"] == _CLOSE, F.when(closed > 0, n - closed).otherwise(n))
        for name, (own, scope) in _CLOSES.items():
            first = F.array_position(F.transform(names, _one_of(own + scope)), True)
            ends = F.get(names, (first - 1).cast("int")).isin(own)
            size = size.when((tag["name"] == name) & (first > 0) & ends, n - first)
        return size.otherwise(n).cast("int")

    def step(state: Column, tag: Column) -> Column:
        return _let(left_open(state, tag), lambda n: _let(F.get(state["open"], n - 1), lambda parent: after(state, tag, n, parent)))

    def after(state: Column, tag: Column, n: Column, parent: Column) -> Column:
        ended = F.filter(F.slice(state["open"], n + 1, F.greatest(F.size(state["open"]) - n, F.lit(0))), lambda e: e["at"].bitwiseAND(last) != 0)
        found = F.concat(state["found"], F.transform(ended, lambda e: F.struct(e["start"].alias("start"), tag["i"].alias("stop"), e["at"].alias("at"))))
        kept = F.slice(state["open"], 1, n)
        reached = first.bitwiseOR(F.shiftleft(parent["at"], 1).bitwiseAND(children)).bitwiseOR(
            F.shiftleft(parent["above"], 1).bitwiseAND(inside))
        at = tag["fits"].bitwiseAND(reached).bitwiseAND(placed(parent["kids"] + 1))

        def opened(at: Column) -> Column:
            grown = F.struct(parent["name"].alias("name"), parent["at"].alias("at"), parent["above"].alias("above"),
                             parent["start"].alias("start"), (parent["kids"] + 1).alias("kids"))
            new = F.struct(tag["name"].alias("name"), at.alias("at"), parent["above"].bitwiseOR(at).alias("above"),
                           tag["i"].alias("start"), F.lit(0).alias("kids"))
            line = F.concat(F.slice(state["open"], 1, n - 1), F.array(grown))
            alone = F.when((tag["kind"] == _ALONE) & (at.bitwiseAND(last) != 0), F.array(F.struct(tag["i"].alias("start"), tag["i"].alias("stop"), at.alias("at"))))
            return F.struct(
                F.when(tag["kind"] == _OPEN, F.concat(line, F.array(new))).otherwise(line).alias("open"),
                F.when(alone.isNull(), found).otherwise(F.concat(found, alone)).alias("found"),
            )

        closing = F.struct(kept.alias("open"), found.alias("found"))
        return F.when(tag["kind"] == _CLOSE, closing).otherwise(_let(at, opened))

    page = F.struct(F.lit("").alias("name"), F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("above"),
                    F.lit(-1).alias("start"), F.lit(0).alias("kids"))
    none = F.array().cast(f"array<{_FOUND}>")
    start = F.struct(F.array(page).alias("open"), none.alias("found")).cast(_STATE)
    tags = F.filter(F.transform(tokens, lambda t, i: _tag_of(t, i, steps)), lambda t: t["kind"].isin(_OPEN, _CLOSE, _ALONE))

    def finished(state: Column) -> Column:
        ended = F.filter(state["open"], lambda e: e["at"].bitwiseAND(last) != 0)
        return F.array_sort(F.concat(state["found"], F.transform(ended, lambda e: F.struct(e["start"].alias("start"), F.size(tokens).alias("stop"), e["at"].alias("at")))))

    return F.aggregate(tags, start, step, finished)


def _content(tokens: Column, span: Column) -> Column:
    return F.slice(tokens, span["start"] + 1, F.least(span["stop"] - span["start"] + 1, F.size(tokens) - span["start"]))


def text_of(tokens: Column) -> Column:
    """The texts among the tokens, unescaped, with white space folded."""
    texts = F.filter(tokens, lambda t: ~t.startswith("<") | (t == "<"))
    return F.trim(F.regexp_replace(unescaped(F.array_join(texts, "")), r"\s+", " "))


def _value(tokens: Column, span: Column, name: str) -> Column:
    value = _attribute(F.get(tokens, span["start"]), name) if name else text_of(_content(tokens, span))
    return F.when(span.isNotNull(), value)


def first_of(tokens: Column, spec: str) -> Column:
    """The text of the first element that a path leads to, or with ``path@name`` an attribute of it; null without one."""
    path, _, name = spec.partition("@")
    return _let(F.get(matches(tokens, path), F.lit(0)), lambda span: _value(tokens, span, name))


def _firsts(tokens: Column, paths: list[list[Step]]) -> Column:
    """For each path the first element it leads to, from one pass for all of them."""

    def first(found: Column, end: int) -> Column:
        return F.get(F.filter(found, lambda e: e["at"].bitwiseAND(F.lit(end).cast("long")) != 0), F.lit(0))

    return _let(_elements(tokens, paths), lambda found: F.array(*(first(found, end) for end in _ends(paths))))


def extract_paths(
    df: DataFrame, fields: Mapping[str, str], item: str | None = None, keep: Sequence[str] = (), html: str = "html",
) -> DataFrame:
    """``fields`` by path: one row per page, or one per element of ``item``, whose fields are looked for inside it.

    A field is a path (its first element's text) or ``path@name`` (an attribute);
    inside an item, paths begin at the item's own element. A null page has no
    items, and as a page null fields.
    """
    pages = df.select(*keep, page_tokens(F.col(html)).alias("_tokens"))
    if item is not None:
        # The outer form: for a plain explode Catalyst adds a filter that looks for the items again.
        spans = pages.select(*keep, "_tokens", F.explode_outer(matches(F.col("_tokens"), item)).alias("_span")).where("_span is not null")
        pages = spans.select(*keep, _content(F.col("_tokens"), F.col("_span")).alias("_tokens"))
    paths, groups = {name: parse(spec.partition("@")[0]) for name, spec in fields.items()}, [[]]
    for name, steps in paths.items():
        if sum(len(paths[x]) for x in groups[-1]) + len(steps) > 60:
            groups.append([])
        groups[-1].append(name)
    spans = {name: (f"_spans{k}", i) for k, group in enumerate(groups) for i, name in enumerate(group)}
    pages = pages.select(*keep, "_tokens", *(
        _firsts(F.col("_tokens"), [paths[name] for name in group]).alias(f"_spans{k}") for k, group in enumerate(groups) if group))

    def picked(name: str) -> Column:
        group, i = spans[name]
        return _let(F.get(F.col(group), F.lit(i)), lambda span: _value(F.col("_tokens"), span, fields[name].partition("@")[2])).alias(name)

    return pages.select(*keep, *map(picked, fields))
