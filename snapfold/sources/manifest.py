"""CSV files listed in a manifest, each with the tags its rows get."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapfold.schema import GENDER_TAG, YEAR_TAG
from snapfold.session import hadoop_path


@dataclass(frozen=True)
class FileEntry:
    """A CSV file (or a folder of them with one header) and the tag columns of its rows.

    With ``columns`` its header is known and not looked up; one that differs fails when the file is read.
    """

    path: str
    tags: Mapping[str, int | str] = field(default_factory=dict)
    columns: tuple[str, ...] = ()


def snapshot_manifest(folder: str = "data") -> list[FileEntry]:
    """The yearly player files: men 2015 to 2022, women 2016 to 2022."""
    folder = folder.rstrip("/")
    men = [
        FileEntry(f"{folder}/players_{year % 100}.csv", {YEAR_TAG: year, GENDER_TAG: "male"})
        for year in range(2015, 2023)
    ]
    women = [
        FileEntry(f"{folder}/female_players_{year % 100}.csv", {YEAR_TAG: year, GENDER_TAG: "female"})
        for year in range(2016, 2023)
    ]
    return men + women


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    return tuple(spark.read.csv(path, header=True).columns)


def read_text_csv(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """CSV files of one header, all columns as text: no pass over the data to guess types.

    A file whose header differs is refused: its values would land under the wrong names.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    names = columns or _header(spark, paths[0])
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return spark.read.schema(schema).csv(paths, header=True, enforceSchema=False)


def fingerprints(spark: SparkSession, paths: Sequence[str], lookups: int = 16) -> list[str]:
    """For each file or folder a hash of its files' names, sizes and times of change: another one means that it was changed."""

    def look(path: str) -> str:
        files, place = hadoop_path(spark, path)
        listing, found = files.listFiles(place, True), []
        while listing.hasNext():
            status = listing.next()
            name = status.getPath().getName()
            if not name.startswith(("_", ".")):
                found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
        return hashlib.sha256(repr(sorted(found)).encode()).hexdigest()

    with ThreadPoolExecutor(max(1, min(lookups, len(paths)))) as pool:
        return list(pool.map(look, paths))


def _tag(value: int | str) -> Column:
    return F.lit(value).cast("int" if isinstance(value, int) else "string")


def read_manifest(spark: SparkSession, entries: Sequence[FileEntry], lookups: int = 16) -> DataFrame:
    """All files of the manifest as one frame, columns matched by name, with their tags.

    CSV columns are positional, so a file is only ever read with its own header. Files that share
    header and tags are one scan. As tags are literals, a filter on them drops whole scans from the
    plan before anything is read.
    """
    if not entries:
        raise ValueError("the manifest is empty.")
    with ThreadPoolExecutor(min(lookups, len(entries))) as pool:
        headers = list(pool.map(lambda entry: tuple(entry.columns) or _header(spark, entry.path), entries))
    groups: dict[tuple, list[str]] = {}
    for entry, header in zip(entries, headers, strict=True):
        groups.setdefault((header, tuple(entry.tags.items())), []).append(entry.path)
    frames = [
        read_text_csv(spark, paths, header).withColumns({name: _tag(value) for name, value in tags})
        for (header, tags), paths in groups.items()
    ]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
