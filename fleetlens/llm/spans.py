"""Spans of pattern matches in texts, as Spark expressions: places in code points, ends exclusive.

Patterns are written so that Java's matcher neither recurses nor looks at a long run again from each of its characters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

ITEM = "struct<start:bigint,kind:int,end:bigint,value:string>"
SPAN = f"array<{ITEM}>"


#: Items that are folded one by one; an array grows by copying, so long ones are made of blocks.
BLOCK = 256


def running(items: Column, ddl: str, value: Callable[[Column], Column], merge: Callable[[Column, Column], Column]) -> Column:
    """(before, item) of each of the items (an array of type `ddl`): what `merge` makes of the longs of all items before it, 0 first.

    Takes time in proportion to the number of items times BLOCK, not to its square.
    """
    pair = f"struct<before:bigint,item:{ddl}>"
    zero = F.lit(0).cast("long").alias("at")

    def folded(part: Column) -> Column:
        def step(state: Column, item: Column) -> Column:
            out = F.concat(state["out"], F.array(F.struct(state["at"].alias("before"), item.alias("item"))))
            return F.struct(merge(state["at"], value(item)).cast("long").alias("at"), out.alias("out"))

        return F.aggregate(part, F.struct(zero, F.array().cast(f"array<{pair}>").alias("out")), step)

    def together(blocks: Column) -> Column:
        def step(state: Column, block: Column) -> Column:
            out = F.concat(state["out"], F.array(F.struct(state["at"].alias("base"), block["out"].alias("out"))))
            return F.struct(merge(state["at"], block["at"]).cast("long").alias("at"), out.alias("out"))

        based = F.array().cast(f"array<struct<base:bigint,out:array<{pair}>>>").alias("out")
        return F.aggregate(blocks, F.struct(zero, based), step, lambda state: state["out"])

    def all_of(items: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.size(items), F.lit(BLOCK))
        blocks = F.transform(firsts, lambda first: folded(F.slice(items, first, F.lit(BLOCK))))
        moved = F.transform(
            together(blocks),
            lambda b: F.transform(
                b["out"], lambda x: F.struct(merge(b["base"], x["before"]).cast("long").alias("before"), x["item"].alias("item"))
            ),
        )
        return F.flatten(moved)

    # One element, so that a transform binds the items to a variable and they are computed once.
    return F.when(F.size(items) > 0, F.transform(F.array(items), all_of)[0]).otherwise(F.array().cast(f"array<{pair}>"))


def placed(text: Column, found: Column, pattern: str | Column, kind: int) -> Column:
    """Spans (start, kind, end, value) of the leftmost non-overlapping matches.

    `found` is what all_matches() gives for the same text and pattern; the gaps between matches give their places.
    """

    def pieces(found: Column, gaps: Column) -> Column:
        return F.transform(
            found, lambda value, i: F.struct(F.char_length(F.get(gaps, i)).cast("long").alias("gap"), value.alias("value"))
        )

    def span(x: Column) -> Column:
        start = x["before"] + x["item"]["gap"]
        end = start + F.char_length(x["item"]["value"])
        return F.struct(
            start.cast("long").alias("start"), F.lit(kind).alias("kind"), end.cast("long").alias("end"), x["item"]["value"].alias("value")
        )

    bound = F.array(F.struct(found.alias("found"), F.split(text, pattern, -1).alias("gaps")))
    items = F.transform(bound, lambda v: pieces(v["found"], v["gaps"]))[0]
    length = lambda item: item["gap"] + F.char_length(item["value"])
    spans = F.transform(running(items, "struct<gap:bigint,value:string>", length, lambda a, b: a + b), span)
    return F.when(F.size(found) > 0, spans).otherwise(F.array().cast(SPAN))


def all_matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def only(spans: Column, keep: Callable[[Column], Column]) -> Column:
    """The spans whose value passes."""
    return F.filter(spans, lambda span: keep(span["value"]))


def in_order(*spans: Column) -> Column:
    """All spans by start, then kind."""
    return F.array_sort(F.concat(*spans))


def as_text(spans: Column, kinds: list[str]) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(kind) for kind in kinds])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def of_kind(spans: Column, kind: int) -> Column:
    """How many spans are of one kind."""
    return F.size(F.filter(spans, lambda span: span["kind"] == kind)).cast("long")


def _reaching(spans: Column) -> Column:
    """(before, item) of each span: the greatest end of the spans before it."""
    return running(spans.cast(SPAN), ITEM, lambda span: span["end"], lambda a, b: F.greatest(a, b))


def uncovered(spans: Column, base: Column, kind: int) -> Column:
    """Those of `spans`, all of this kind, that share no character with one of `base`, whose kinds are smaller.

    `spans` don't overlap each other.  So in the order of all starts a span is free if what lies before it ends in time, and
    what comes next begins in time.
    """

    def free(all_of: Column) -> Column:
        kept = F.filter(
            F.transform(
                all_of,
                lambda x, i: F.struct(
                    x["item"].alias("item"),
                    ((x["before"] <= x["item"]["start"]) & (F.coalesce(F.get(all_of, i + 1)["item"]["start"], x["item"]["end"]) >= x["item"]["end"])).alias("free"),
                ),
            ),
            lambda x: x["free"] & (x["item"]["kind"] == kind),
        )
        return F.transform(kept, lambda x: x["item"])

    found = F.transform(F.array(_reaching(F.array_sort(F.concat(base.cast(SPAN), spans.cast(SPAN))))), free)[0]
    return F.when((F.size(base) == 0) | (F.size(spans) == 0), spans.cast(SPAN)).otherwise(found)


def redacted(text: Column, spans: Column, kinds: list[str]) -> Column:
    """`text` with [KIND] in place of each span; of overlapping spans the first one counts, extended to the last end."""
    names = F.array(*[F.lit(f"[{kind.upper()}]") for kind in kinds])

    def cut(text: Column, start: Column, end: Column) -> Column:
        return F.substring(text, (start + 1).cast("int"), (end - start).cast("int"))

    def written(spans: Column) -> Column:
        # A block's part of the text is cut out first, as counting characters from the text's beginning takes its length.
        def block(first: Column) -> Column:
            part = F.slice(spans, first, F.lit(BLOCK))
            base = part[0]["before"]
            bound = F.array(F.struct(cut(text, base, F.element_at(part, -1)["item"]["start"]).alias("text"), base.alias("base"), part.alias("spans")))
            return F.transform(bound, lambda v: F.array_join(F.transform(v["spans"], lambda s: F.concat(
                cut(v["text"], s["before"] - v["base"], s["item"]["start"] - v["base"]), F.get(names, s["item"]["kind"])
            )), ""))[0]

        opening = F.transform(F.sequence(F.lit(1), F.size(spans), F.lit(BLOCK)), block)
        return F.array_join(opening, "")

    def result(reaching: Column) -> Column:
        # A span that begins before the end of another one is part of it.
        opening = F.filter(reaching, lambda x: x["item"]["start"] >= x["before"])
        end = F.array_max(F.transform(reaching, lambda x: x["item"]["end"]))
        return F.concat(F.transform(F.array(opening), written)[0], F.substring(text, (end + 1).cast("int"), F.char_length(text)))

    return F.when(F.size(spans) > 0, F.transform(F.array(_reaching(spans)), result)[0]).otherwise(text)
