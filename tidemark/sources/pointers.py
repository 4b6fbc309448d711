"""Resume pointers of the pipelines: one small numbered file for each move, created only if absent.

A run remembers the number it saw when it began. Of two runs of one pipeline that end at the same
time, one creates the next number; the other meets it, reads it, and moves on only if its own date is
later. So no pointer goes back and no move is lost. The file before the newest one stays, in case a
run stopped between creating the newest and writing it; older ones go.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import date, datetime
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from tidemark.session import folder, listed

KEPT = 2


@dataclass(frozen=True)
class Pointer:
    """The newest number of a pipeline, 0 before the first, and the date last processed."""

    number: int = 0
    processed: date | None = None


def _home(root: str, pipeline_name: str) -> str:
    return f"{root}/{quote(pipeline_name, safe='').replace('.', '%2E')}"


def _numbers(spark: SparkSession, home: str) -> list[int]:
    names = (path.rsplit("/", 1)[-1] for path in listed(spark, home.replace("%", "?") + "/*.json"))
    return sorted(int(name.removesuffix(".json")) for name in names)


def _path(home: str, number: int) -> str:
    return f"{home}/{number:012d}.json"


def _text(spark: SparkSession, path: str) -> str:
    place, files = folder(spark, path)
    stream = files.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def read(spark: SparkSession, root: str, pipeline_name: str) -> Pointer:
    """The newest move that was written; the number counts unfinished ones too."""
    home = _home(root, pipeline_name)
    numbers = _numbers(spark, home)
    for number in reversed(numbers):
        if text := _text(spark, _path(home, number)).strip():
            return Pointer(numbers[-1], date.fromisoformat(json.loads(text)["last_processed_date"]))
    return Pointer(numbers[-1] if numbers else 0)


def move(
    spark: SparkSession, root: str, pipeline_name: str, seen: Pointer, processed: date, now: datetime
) -> Pointer:
    """Move the pointer to ``processed`` unless another run has moved it as far since ``seen``."""
    home = _home(root, pipeline_name)
    row = {
        "pipeline_name": pipeline_name,
        "last_processed_date": processed.isoformat(),
        "updated_at": now.isoformat(),
    }
    while True:
        number = seen.number + 1
        if _created(spark, _path(home, number), json.dumps(row) + "\n"):
            for old in _numbers(spark, home)[:-KEPT]:
                place, files = folder(spark, _path(home, old))
                files.delete(place, False)
            return Pointer(number, processed)
        seen = read(spark, root, pipeline_name)
        if seen.processed and seen.processed >= processed:
            return seen


def _created(spark: SparkSession, path: str, text: str) -> bool:
    place, files = folder(spark, path)
    try:
        out = files.create(place, False)
    except Py4JJavaError:
        if files.exists(place):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True
