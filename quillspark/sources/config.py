"""Small configuration files, read on the driver: policies, taxonomies, glossaries."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession

#: Names that look like classes in a taxonomy file and aren't.
_NOT_CLASSES = {"subdomains", "version", "campaign"}


def merged(defaults: dict, overrides: dict) -> dict:
    """Section by section; unknown keys are kept, a section of one side alone too."""
    out = dict(defaults)
    for key, value in overrides.items():
        out[key] = {**out[key], **value} if isinstance(value, dict) and isinstance(out.get(key), dict) else value
    return out


def load_json(text: str, defaults: dict) -> dict:
    return merged(defaults, json.loads(text))


def _scalar(text: str):  # noqa: ANN202
    text = text.strip()
    if text[:1] in "\"'" and text[-1:] == text[:1] and len(text) > 1:
        return text[1:-1]
    known = {"true": True, "false": False, "null": None, "~": None, "": None, "[]": [], "{}": {}}
    if text.lower() in known:
        return known[text.lower()]
    if text.startswith("[") and text.endswith("]"):
        return [_scalar(x) for x in text[1:-1].split(",")]
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return text


def parse_yaml(text: str) -> dict:
    """The part of YAML that configuration files use: nested sections, scalars, lists of scalars, comments. Anything else is an error."""
    rows = []
    for n, raw in enumerate(text.splitlines(), 1):
        line = re.sub(r"(^|\s)#(?=([^\"']|\"[^\"]*\"|'[^']*')*$).*$", "", raw).rstrip()
        if line.strip() and line.strip() != "---":
            if "\t" in line[: len(line) - len(line.lstrip())]:
                raise ValueError(f"line {n}: indented by a tab")
            rows.append((len(line) - len(line.lstrip()), line.strip(), n))

    def block(at: int, indent: int) -> tuple[object, int]:
        listed = rows[at][1].startswith("- ") or rows[at][1] == "-"
        out: list | dict = [] if listed else {}
        while at < len(rows) and rows[at][0] == indent:
            _, line, n = rows[at]
            if listed:
                if not line.startswith("-") or ": " in line or line.endswith(":"):
                    raise ValueError(f"line {n}: only lists of scalars are read")
                out.append(_scalar(line[1:]))
                at += 1
                continue
            m = re.match(r"([^:\s][^:]*):(?:\s+(.*))?$", line)
            if not m or (m[2] or "").startswith(("|", ">", "&", "*", "!")):
                raise ValueError(f"line {n}: not a key and a scalar")
            at += 1
            deeper = at < len(rows) and (rows[at][0] > indent or (rows[at][0] == indent and rows[at][1].startswith("- ")))
            if m[2] is None and deeper:
                out[m[1].strip("\"'")], at = block(at, rows[at][0])
            else:
                out[m[1].strip("\"'")] = _scalar(m[2] or "")
        if at < len(rows) and rows[at][0] > indent:
            raise ValueError(f"line {rows[at][2]}: indented too far")
        return out, at

    if not rows:
        return {}
    found, at = block(0, rows[0][0])
    if at < len(rows) or not isinstance(found, dict):
        raise ValueError("not one mapping")
    return found


def load_config(text: str, defaults: dict) -> dict:
    """JSON or YAML, by its first character."""
    return load_json(text, defaults) if text.lstrip().startswith("{") else merged(defaults, parse_yaml(text))


def campaign_classes(text: str | None) -> list[str]:
    """The classes of a campaign's own taxonomy; without a file or without classes it is an error, there is no other to fall back on."""
    classes = [name for name, _ in taxonomy_blocks(text)] if text is not None else []
    if not classes:
        raise ValueError("the campaign has no taxonomy")
    return classes


def taxonomy_blocks(text: str) -> list[tuple[str, str]]:
    """(class, block) in order: two blanks, a name and a colon start a class, the next one ends it."""
    heads = [m for m in re.finditer(r"^  ([\w-]+):[ \t]*$", text, re.M) if m[1] not in _NOT_CLASSES]
    ends = [m.start() for m in heads[1:]] + [len(text)][: len(heads)]
    return [(m[1], text[m.end() : end]) for m, end in zip(heads, ends, strict=True)]


def taxonomy(spark: SparkSession, text: str) -> DataFrame:
    """(ord, name, definition, examples): ord keeps the order of the file, which breaks ties."""
    rows = []
    for i, (name, block) in enumerate(taxonomy_blocks(text)):
        definition = re.search(r"^\s+definition:\s*(.+)$", block, re.M)
        examples = re.findall(r"^\s+-?\s*text:\s*(.+)$", block, re.M)
        rows.append((i, name, definition[1].strip().strip('"') if definition else "", [e.strip().strip('"') for e in examples]))
    return spark.createDataFrame(rows, "ord int, name string, definition string, examples array<string>")


def policy_value(text: str, name: str, default: int) -> int:
    """C14: a number of a policy file."""
    m = re.search(rf"^\s+{re.escape(name)}:\s*(\d+)", text, re.M)
    return int(m[1]) if m else default
