"""Chunks of documents for classification and retrieval."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.markdown import lines
from quillspark.functions.text import stripped
from quillspark.functions.binding import let


def check_window(window: int) -> int:
    """Windows of 200 to 8000 tokens; anything else is an error."""
    if not 200 <= window <= 8000:
        raise ValueError("window must be between 200 and 8000")
    return window


def clamp_top_k(k: int) -> int:
    return min(max(k, 1), 10)


def _outside_fences(body: Column) -> Column:
    """(line, fence line?, inside?) of every line; only ``` fences count here."""
    ls = F.transform(lines(body), lambda x, i: F.struct(i.alias("n"), x.alias("x"), stripped(x).startswith("```").alias("fence")))
    marks = lambda l: F.transform(F.filter(l, lambda z: z["fence"]), lambda z: z["n"])  # noqa: E731, E741
    return let(ls, lambda l: let(marks(l), lambda fs: F.transform(l, lambda z: F.struct(z["x"].alias("x"), z["fence"].alias("fence"), (F.size(F.filter(fs, lambda f: f < z["n"])) % 2 == 1).alias("inside")))))  # noqa: E741


def headers(body: Column) -> Column:
    """Heading lines outside fences, joined."""
    found = F.filter(_outside_fences(body), lambda z: ~z["fence"] & ~z["inside"] & F.ltrim(z["x"]).startswith("#"))
    return F.array_join(F.transform(found, lambda z: z["x"]), "\n")


def prose(body: Column) -> Column:
    found = F.filter(_outside_fences(body), lambda z: z["fence"] | z["inside"] | ~F.ltrim(z["x"]).startswith("#"))
    return F.array_join(F.transform(found, lambda z: z["x"]), "\n")


def _rfind(text: Column, needle: str) -> Column:
    """0-based place of the last occurrence, -1 if there is none."""
    at = F.instr(F.reverse(text), needle[::-1])
    return F.when(at > 0, F.length(text) - at - len(needle) + 1).otherwise(-1)


def first_window(body: Column, window: int, outline: bool = True) -> Column:
    """the first ``4 * window`` characters; a tenth may go to an outline; a cut falls behind the last sentence or line end of the last 400."""
    budget = 4 * window

    def cut(part: Column, over: Column) -> Column:
        at = let(F.right(part, F.lit(400)), lambda tail: F.greatest(_rfind(tail, ". "), _rfind(tail, "\n")))
        return let(at, lambda k: F.when(over & (k > 0), F.substring(part, F.lit(1), F.length(part) - 400 + k + 1)).otherwise(part))

    def with_heads(heads: Column, room: Column) -> Column:
        trimmed = let(F.substring(body, F.lit(1), budget - room), lambda part: cut(part, F.length(body) > budget - room))
        return F.concat(trimmed, F.when(room > 0, F.concat(F.lit("\n\n## Outline\n"), F.substring(heads, F.lit(1), room))).otherwise(""))

    return let(headers(body) if outline else F.lit(""), lambda heads: let(F.least(F.length(heads), F.lit(budget // 10)), lambda room: with_heads(heads, room)))


def header_aware(body: Column, window: int) -> Column:
    """headings up to a third of the budget, then the prose without them."""
    budget = 4 * window
    return let(F.substring(headers(body), 1, budget // 3), lambda heads: F.concat(heads, F.lit("\n\n"), F.substring(prose(body), F.lit(1), budget - F.length(heads))))


def index_chunks(text: Column, size: int, overlap: int) -> Column:
    """V9: (pos, chunk) of at most ``size`` tokens of four characters, each starting ``size - overlap`` after the one before."""
    step, n = 4 * (size - overlap), 4 * size
    starts = F.sequence(F.lit(0), F.greatest(F.length(text) - 1, F.lit(0)), F.lit(step))
    return F.transform(starts, lambda s: F.struct(s.alias("pos"), F.substring(text, s + 1, F.lit(n)).alias("chunk")))


def page_plan(pages: Column, most: int = 100, part: int = 50) -> Column:
    """Sizes of the parts in which a document of so many pages is converted."""
    whole = F.transform(F.sequence(F.lit(0), F.greatest(pages - 1, F.lit(0)), F.lit(part)), lambda s: F.least(F.lit(part), pages - s).cast("int"))
    return F.when(pages <= most, F.array(pages.cast("int"))).otherwise(whole)


MODES = ("first_window", "header_aware", "full")


def chunk(body: Column, mode: str, window: int) -> Column:
    """A document's chunk in one of the modes; ``full`` is the body itself. The window is checked first."""
    window = check_window(window)
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}")
    return {"first_window": first_window, "header_aware": header_aware}[mode](body, window) if mode != "full" else body
