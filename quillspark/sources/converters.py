"""Clients of outside converters and models: the caller gives what talks to them, this gives when and how often.

X4, X5, S4, C16, T5: no endpoint is called by itself.  A runner takes one request
and returns its answer; ``mapInPandas`` runs it where the rows are.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame

from quillspark.functions.shipping import ship


class ConverterDown(RuntimeError):
    """The service doesn't answer: the batch ends, and names what wasn't converted."""


@dataclass(frozen=True)
class Endpoint:
    """Where a service is and its key, from environment variables of the caller's naming."""

    url: str
    key: str = ""

    @staticmethod
    def named(url_variable: str, key_variable: str | None = None, default: str | None = None) -> Endpoint:
        url = os.environ.get(url_variable, default)
        if not url:
            raise KeyError(f"{url_variable} isn't set")
        return Endpoint(url.rstrip("/"), os.environ.get(key_variable, "") if key_variable else "")


@dataclass(frozen=True)
class Converter:
    """``run(name, data) -> markdown``; ``healthy()`` is asked before a partition and after a failure; a failing file is tried ``attempts`` times."""

    run: Callable[[str, bytes], str]
    healthy: Callable[[], bool] = lambda: True
    attempts: int = 5

    def one(self, name: str, data: bytes) -> tuple[str | None, str | None]:
        error = None
        for _ in range(self.attempts):
            try:
                return self.run(name, data), None
            except Exception as e:  # noqa: BLE001 - whatever a converter raises is that file's failure
                error = str(e) or type(e).__name__
                if not self.healthy():
                    raise ConverterDown(f"the converter went down at {name}") from e
        return None, error


def convert_files(files: DataFrame, converter: Converter) -> DataFrame:
    """(path, md, error) of files (path, raw). If the service is down the job fails rather than leave files out; Spark tries the task again."""
    ship(files.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if not converter.healthy():
            raise ConverterDown("the converter can't be reached")
        for batch in batches:
            results = [converter.one(p, bytes(r) if r is not None else b"") for p, r in zip(batch["path"], batch["raw"], strict=True)]
            yield pd.DataFrame({"path": batch["path"], "md": [m for m, _ in results], "error": [e for _, e in results]})

    return files.select("path", "raw").mapInPandas(run, "path string, md string, error string")
