"""Places of all matches of a pattern in a text, as a Column."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from fieldstar.llm.common import bind

CONTEXT_CHARS = 48
# Matches before a place that its context may reach over.
REACH = 3
CHUNK = 256


def running_sums(sizes: Column) -> Column:
    """Inclusive running sums of an array, chunk by chunk so that appending stays cheap."""

    def sums(values, start):
        zero = F.struct(start.cast("int").alias("at"), F.array().cast("array<int>").alias("all"))
        step = lambda acc, x: F.struct(
            (acc["at"] + x).alias("at"), F.array_append(acc["all"], acc["at"] + x).alias("all")
        )
        return F.aggregate(values, zero, step, lambda acc: acc["all"])

    total = lambda values: F.aggregate(values, F.lit(0), lambda acc, x: acc + x)

    def by_chunks(values):
        last = F.floor((F.size(values) - 1) / CHUNK).cast("int")
        chunks = F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(values, c * CHUNK + 1, CHUNK))
        ends = lambda cs: sums(F.transform(cs, total), F.lit(0))
        return bind(
            chunks,
            lambda cs: F.flatten(F.zip_with(cs, ends(cs), lambda chunk, end: sums(chunk, end - total(chunk)))),
        )

    return F.when(F.size(sizes) == 0, F.array().cast("array<int>")).otherwise(bind(sizes, by_chunks))


def matches(text: Column, pattern: str, needs: str) -> Column:
    """All matches of a pattern as structs: s, e (start and end in code points), v (value), c and a.

    c and a are the text before and after the match, up to `CONTEXT_CHARS`
    marks; c goes back over up to `REACH` earlier matches, a ends at the next one.
    """

    def placed(found):
        count = F.size(found["m"])
        before = F.slice(found["b"], 1, count)
        sizes = F.zip_with(before, found["m"], lambda b, m: F.length(b) + F.length(m))
        tail = lambda c: F.right(c, F.lit(CONTEXT_CHARS))

        def context(b, i):
            back = []
            for k in range(REACH, 0, -1):
                back += [F.get(found["m"], i - k), F.get(found["b"], i - k + 1) if k > 1 else b]
            return tail(F.concat(*[F.coalesce(tail(x), F.lit("")) for x in back]))

        contexts = F.transform(before, context)
        after = F.transform(F.slice(found["b"], 2, count), lambda b: F.left(b, F.lit(CONTEXT_CHARS)))
        with_context = F.zip_with(found["m"], contexts, lambda m, c: F.struct(m.alias("v"), c.alias("c")))
        with_both = F.zip_with(with_context, after, lambda x, a: F.struct(x["v"].alias("v"), x["c"].alias("c"), a.alias("a")))
        return F.zip_with(
            with_both,
            running_sums(sizes),
            lambda x, e: F.struct(
                (e - F.length(x["v"])).alias("s"), e.alias("e"), x["v"].alias("v"), x["c"].alias("c"), x["a"].alias("a")
            ),
        )

    both = F.struct(
        F.split(text, pattern, -1).alias("b"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m")
    )
    none = F.array().cast("array<struct<s:int,e:int,v:string,c:string,a:string>>")
    return F.when(text.rlike(needs), bind(both, placed)).otherwise(none)


def overlapped(marked: Column, row: str = "_row", start: str = "s", end: str = "e") -> Column:
    """Whether a place of a text meets a marked one; to be read where a place is not marked itself.

    Two walks over a text's places by start: the farthest end of the marked ones
    before, and the nearest start of those behind. A text with many places takes
    time in proportion, but for the sort.
    """
    first = marked.cast("int").desc()
    onward = Window.partitionBy(row).orderBy(F.col(start).asc(), first)
    back = Window.partitionBy(row).orderBy(F.col(start).desc(), first)
    so_far = lambda w: w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ended = F.max(F.when(marked, F.col(end))).over(so_far(onward))
    begun = F.min(F.when(marked, F.col(start))).over(so_far(back))
    return F.coalesce(ended > F.col(start), F.lit(False)) | F.coalesce(begun < F.col(end), F.lit(False))
