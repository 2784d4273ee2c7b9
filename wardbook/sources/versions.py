"""Atomic publishing: which folders make up a table now.

New content is written to folders of its own. A manifest, a small JSON file that is renamed
into place, names the folders; the manifest with the highest number holds. So readers see
a table before a change or after it, never between, and a failed change leaves what was
there. One writer at a time is assumed.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from wardbook.sources.folders import names, put_text, remove, remove_all, text_of

MANIFESTS = "_manifests"


def _manifest(root: str, number: int) -> str:
    return f"{root}/{MANIFESTS}/{number:012d}.json"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return [int(n[:12]) for n in names(spark, f"{root}/{MANIFESTS}") if n.endswith(".json") and n[:12].isdigit()]


def current(spark: SparkSession, root: str) -> dict[str, str] | None:
    """What is published: folders by name; None before the first time."""
    numbers = _numbers(spark, root)
    return json.loads(text_of(spark, _manifest(root, numbers[-1]))) if numbers else None


def current_number(spark: SparkSession, root: str) -> int | None:
    """The number of the manifest that holds."""
    numbers = _numbers(spark, root)
    return numbers[-1] if numbers else None


def publish(spark: SparkSession, root: str, folders: dict[str, str]) -> int:
    """Make these folders, relative to root, the content from now on; returns the manifest's number.

    Folders that neither this nor the last manifest names are removed afterwards: a
    reader that has just looked up the last one can still finish.
    """
    numbers = _numbers(spark, root)
    older = [json.loads(text_of(spark, _manifest(root, n))) for n in numbers]
    number = numbers[-1] + 1 if numbers else 0
    put_text(spark, _manifest(root, number), json.dumps(folders))
    needed = set(folders.values()) | set(older[-1].values() if older else ())
    remove_all(spark, root, {f for m in older for f in m.values()} - needed, needed)
    for old in numbers[:-1]:
        remove(spark, _manifest(root, old))
    return number
