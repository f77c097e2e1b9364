"""Spans of regular-expression matches as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,hit:string>>"


def let(value: Column, use) -> Column:
    """`use(value)` with the value computed once for each row, however often it is used."""
    return F.transform(F.array(value), use)[0]


#: Matches of a text are placed in blocks of this many, so that arrays never grow by more than one block or list of blocks.
BLOCK = 256


def match_spans(text: Column, pattern: Column | str) -> Column:
    """The leftmost non-overlapping matches of `pattern`: start, end (code points, exclusive) and text.

    Splitting gives what lies between the matches, so running sums of lengths
    give the places: within blocks of matches first, then over the blocks.
    The pattern must not match the empty string.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit"))
    none = F.struct(F.lit(0).alias("at"), F.from_json(F.lit("[]"), SPAN).alias("out"))

    def add(state: Column, pair: Column) -> Column:
        gap, hit = pair["gap"], pair["hit"]
        start = state["at"] + F.length(gap)

        def placed(span: Column) -> Column:
            return F.struct(span["end"].alias("at"), F.when(span["hit"].isNull(), state["out"]).otherwise(F.concat(state["out"], F.array(span))).alias("out"))

        return let(F.struct(start.alias("start"), (start + F.coalesce(F.length(hit), F.lit(0))).alias("end"), hit.alias("hit")), placed)

    def in_blocks(pairs: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.size(pairs), F.lit(BLOCK))
        blocks = F.transform(firsts, lambda first: F.aggregate(F.slice(pairs, first, F.lit(BLOCK)), none, add))
        nothing = F.struct(F.lit(0).alias("at"), F.from_json(F.lit("[]"), f"array<{SPAN}>").alias("out"))

        def follow(state: Column, block: Column) -> Column:
            moved = F.transform(block["out"], lambda s: F.struct((s["start"] + state["at"]).alias("start"), (s["end"] + state["at"]).alias("end"), s["hit"].alias("hit")))
            return F.struct((state["at"] + block["at"]).alias("at"), F.concat(state["out"], F.array(moved)).alias("out"))

        return F.aggregate(blocks, nothing, follow, lambda s: F.flatten(s["out"]))

    return let(pairs, lambda pairs: F.when(F.size(pairs) <= BLOCK, F.aggregate(pairs, none, add, lambda s: s["out"])).otherwise(in_blocks(pairs)))


#: Code points of a piece of text that a place is looked up in.
PIECE = 4096


def pieces(text: Column) -> Column:
    """The text in pieces of PIECE code points, so that a place in a long text is found without counting from its start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def between(parts: Column, start: Column, end: Column) -> Column:
    """The text from code point `start` to `end`, from its `pieces`; empty if end is not above start."""
    first = F.floor(start / PIECE).cast("int")
    count = F.greatest(F.floor((end - 1) / PIECE).cast("int") - first + 1, F.lit(1))
    own = F.array_join(F.slice(parts, first + 1, count), "")
    return F.when(end > start, F.substring(own, start - first * PIECE + 1, end - start)).otherwise("")


def highest_before(values: Column) -> Column:
    """Of each number, the greatest of those before it and 0; in blocks, so that arrays never grow by the number over more than one."""

    def step(state: Column, v: Column) -> Column:
        return F.struct(F.greatest(state["top"], v).alias("top"), F.concat(state["out"], F.array(state["top"])).alias("out"))

    def in_blocks(values: Column) -> Column:
        firsts = F.when(F.size(values) > 0, F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(BLOCK))).otherwise(F.array().cast("array<int>"))

        def block(state: Column, first: Column) -> Column:
            begin = F.struct(state["top"].alias("top"), F.array().cast("array<int>").alias("out"))
            return let(F.aggregate(F.slice(values, first, F.lit(BLOCK)), begin, step), lambda b: F.struct(b["top"].alias("top"), F.concat(state["out"], F.array(b["out"])).alias("out")))

        start = F.struct(F.lit(0).alias("top"), F.array().cast("array<array<int>>").alias("out"))
        return F.aggregate(firsts, start, block, lambda s: F.flatten(s["out"]))

    return let(values, in_blocks)
