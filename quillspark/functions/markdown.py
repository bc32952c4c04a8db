"""Markdown documents: frontmatter, content lines, links, titles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.binding import let
from quillspark.functions.text import stripped

#: Line ends as a text editor's line splitter knows them.
LINE_END = "\r\n|[\n\r\\x0B\\x0C\\x1C-\\x1E\\x85\\u2028\\u2029]"


def lines(text: Column) -> Column:
    """The lines of a text; no empty one after a last line end."""
    return let(F.split(text, LINE_END), lambda f: F.when(F.try_element_at(f, F.lit(-1)) == "", F.slice(f, 1, F.greatest(F.size(f) - 1, F.lit(0)))).otherwise(f))


def _fence_end(text: Column) -> Column:
    """0-based number of the line that closes the frontmatter; null if there is none."""
    parts = F.split(text, "\n")
    at = F.filter(F.transform(parts, lambda x, i: F.struct(i.alias("i"), stripped(x).alias("x"))), lambda z: (z["i"] > 0) & (z["x"] == "---"))
    return F.when(F.startswith(text, F.lit("---")), F.try_element_at(at, F.lit(1))["i"])


def body(text: Column) -> Column:
    """What follows the frontmatter; the whole text if there is none."""
    rest = lambda end, parts: F.array_join(F.slice(parts, end + 2, F.greatest(F.size(parts) - end - 1, F.lit(0))), "\n")
    return let(_fence_end(text), lambda end: F.when(end.isNull(), text).otherwise(let(F.split(text, "\n"), lambda parts: rest(end, parts))))


def body_by_split(text: Column) -> Column:
    """The part after the second ``---``, wherever that is; the whole text if it doesn't start with one."""
    parts = F.split(text, "---", 3)
    return F.when(F.startswith(text, F.lit("---")) & (F.size(parts) == 3), F.try_element_at(parts, F.lit(3))).otherwise(text)


def frontmatter(text: Column) -> Column:
    """Map of key to values (a scalar has one).

    A ``- item`` line belongs to the key before it only if that key has no value on
    its own line; double quotes are taken off, nothing else; a later key replaces an
    earlier one of that name.
    """
    head = let(_fence_end(text), lambda end: F.when(end.isNull(), F.array().cast("array<string>")).otherwise(F.slice(F.split(text, "\n"), F.lit(2), F.greatest(end - 1, F.lit(0)))))
    kind = "struct<key:string,scalar:boolean,items:array<string>>"
    start = F.array().cast(f"array<{kind}>")

    def unquoted(x: Column) -> Column:
        x = stripped(x)
        return F.when((F.length(x) >= 2) & x.startswith('"') & x.endswith('"'), F.substring(x, F.lit(2), F.length(x) - 2)).otherwise(x)

    def step(acc: Column, line: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        item = F.regexp_extract(line, "^\\s*-\\s+(.*)$", 1)
        is_item = line.rlike("^\\s*-\\s+")
        key, value = F.regexp_extract(line, "^([^:\\s][^:]*):(.*)$", 1), F.regexp_extract(line, "^([^:\\s][^:]*):(.*)$", 2)
        entry = F.struct(F.trim(key).alias("key"), (stripped(value) != "").alias("scalar"), F.when(stripped(value) == "", F.array().cast("array<string>")).otherwise(F.array(unquoted(value))).alias("items")).cast(kind)
        grown = F.struct(last["key"].alias("key"), last["scalar"].alias("scalar"), F.concat(last["items"], F.array(unquoted(item))).alias("items")).cast(kind)
        with_item = F.when(last.isNotNull() & ~last["scalar"], F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(grown))).otherwise(acc)
        return F.when(is_item, with_item).when(key != "", F.concat(acc, F.array(entry))).otherwise(acc)

    entries = F.aggregate(head, start, step)
    final = let(entries, lambda es: F.filter(es, lambda e, i: ~F.exists(F.slice(es, i + 2, F.greatest(F.size(es), F.lit(1))), lambda o: o["key"] == e["key"])))
    return F.map_from_entries(F.transform(final, lambda e: F.struct(e["key"], e["items"])))


def wikilinks(text: Column) -> Column:
    """link targets in order, without alias and anchor; embeds count, and fences are not looked at."""
    return F.transform(F.regexp_extract_all(text, F.lit("\\[\\[([^\\]|#]+)"), F.lit(1)), lambda x: stripped(x))


def title(meta: Column, text: Column, stem: Column) -> Column:
    """from the metadata, else the first heading, else the stem."""
    heading = F.regexp_extract(text, "(?m)^#+\\s+(.+)", 1)
    return F.coalesce(F.nullif(meta, F.lit("")), F.nullif(stripped(heading), F.lit("")), stem)


def user_zone(text: Column, start: str, end: str) -> Column:
    """F8: what lies between two markers; null if one is missing or they are the wrong way round."""
    a, b = F.instr(text, start), F.instr(text, end)
    return F.when((a > 0) & (b >= a + len(start)), F.substring(text, a + len(start), b - a - len(start)))


def content(text: Column) -> Column:
    """Array of (n, line): the lines without frontmatter and fenced code, numbered from 1.

    A line that starts with ``` or ~~~ switches the fence and isn't content itself.
    """
    every = F.transform(lines(text), lambda x, i: F.struct((i + 1).alias("n"), x.alias("line"), x.rlike("^\\s*(```|~~~)").alias("fence"), (stripped(x) == "---").alias("rule")))
    shut = lambda l: F.coalesce(F.array_min(F.transform(F.filter(l, lambda z: (z["n"] > 1) & z["rule"]), lambda z: z["n"])), F.lit(0))  # noqa: E731, E741
    start = lambda l: F.when(F.try_element_at(l, F.lit(1))["rule"], shut(l)).otherwise(0)  # noqa: E731, E741
    fences = lambda l, s: F.transform(F.filter(l, lambda z: z["fence"] & (z["n"] > s)), lambda z: z["n"])  # noqa: E731, E741
    kept = lambda l, s, fs: F.filter(l, lambda z: (z["n"] > s) & ~z["fence"] & (F.size(F.filter(fs, lambda f: f <= z["n"])) % 2 == 0))  # noqa: E731, E741
    whole = let(every, lambda l: let(start(l), lambda s: let(fences(l, s), lambda fs: kept(l, s, fs))))  # noqa: E741
    return F.transform(whole, lambda z: F.struct(z["n"].alias("n"), z["line"].alias("line")))


def content_lines(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, line_no, line) of the content. Worked out in the row with array functions: no shuffle, whatever the length."""
    return docs.select(key, F.explode(content(F.col(text))).alias("l")).select(key, F.col("l.n").alias("line_no"), F.col("l.line").alias("line"))
