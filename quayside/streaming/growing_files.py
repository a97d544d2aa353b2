"""Lines of files that grow and are renamed, as a stream.

Spark's file source reads a file once. Log files are appended to, and rotation gives a full file the next
number and starts a new one under the old name. This source reads each whole line once, whatever happens
to the names.

An offset is a snapshot: for each file its length, the hash of its head (the first line, up to 256
bytes) and the hash of the 256 bytes before its end. A file of one snapshot goes on in the file of the next one
that has the same head and, where the old one ended, the same bytes; files of the same name are
tried first, then the others of the folder, each file once. What was there stays read, the rest is read by
tasks in ranges of bytes. A line belongs to the range that holds its line feed, so it is read whole
by one task, and a last line without a line feed waits for it.

The driver lists the folders and opens the files that have changed; it holds one entry of about 150 bytes for each file
that is there. Very many folders are divided over several sources by their roots.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from fnmatch import fnmatchcase

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as DS
from pyspark.sql import functions as F

from quayside.session import register_source

LINES = "message STRING, file STRING, timestamp TIMESTAMP, position LONG"
_LINES_SCHEMA = pa.schema(
    [
        ("message", pa.string()),
        ("file", pa.string()),
        ("timestamp", pa.timestamp("us", "UTC")),
        ("position", pa.int64()),
    ]
)
#: Bytes of the head and of the end that tell a file, of a range, and of a block that is read at once.
SEEN, RANGE_BYTES, BLOCK = 256, 64 * 1024 * 1024, 1024 * 1024
RANGES_EACH, BATCH_ROWS, REQUESTS = 1000, 10_000, 16


class FileIsGone(Exception):
    """The file of an offset is there under no name."""


@dataclass(frozen=True)
class Seen:
    """What an offset knows of a file."""

    length: int
    changed: int
    head: str
    tail: str

    def text(self) -> str:
        return f"{self.length} {self.changed} {self.head} {self.tail}"

    @classmethod
    def of(cls, text: str) -> Seen:
        length, changed, head, tail = text.split(" ")
        return cls(int(length), int(changed), head, tail)


@dataclass(frozen=True)
class Range:
    file: str
    seen: Seen
    start: int
    end: int


@dataclass
class Ranges(DS.InputPartition):
    ranges: list[Range]


def _hash(data: bytes) -> str:
    return hashlib.blake2b(data, digest_size=12).hexdigest()


class Files:
    """The files below a root, with the calls that reading them takes."""

    def __init__(self, root: str, depth: int, names: str) -> None:
        from quayside.sources.store_io import Store

        self.root, self.depth, self.names, self.store = root.rstrip("/"), depth, names, Store()

    def bytes(self, file: str, start: int, end: int) -> bytes:
        system, path = self.store.locate(f"{self.root}/{file}")
        with system.open_input_file(path) as source:
            source.seek(start)
            return source.read(end - start)

    def head(self, file: str) -> str | None:
        """Hash of the first line, of SEEN bytes if it is longer; null while it is shorter and has no end."""
        data = self.bytes(file, 0, SEEN)
        line, end, _ = data.partition(b"\n")
        return _hash(line + end) if end or len(data) == SEEN else None

    def tail(self, file: str, length: int) -> str:
        return _hash(self.bytes(file, max(0, length - SEEN), length))

    def listed(self) -> Iterator[tuple[str, int, int]]:
        """Path below the root, length and time of change (in microseconds) of each file."""
        folders = [""]
        for _ in range(self.depth):
            folders = [
                f"{folder}{name}/"
                for folder in folders
                for name, is_folder, _ in self._entries(folder)
                if is_folder
            ]
        for folder in folders:
            for name, is_folder, measure in self._entries(folder):
                if not is_folder and fnmatchcase(name, self.names):
                    try:
                        seconds, length = measure()
                    except FileNotFoundError:
                        continue
                    yield folder + name, length, int((seconds or 0) * 1_000_000)

    def _entries(self, folder: str):
        try:
            yield from self.store.entries(f"{self.root}/{folder}")
        except FileNotFoundError:
            return

    def holds(self, file: str, seen: Seen) -> bool:
        """Whether a file is the one that was seen, or what it has grown to."""
        try:
            return self.head(file) == seen.head and self.tail(file, seen.length) == seen.tail
        except OSError:
            return False

    def find(self, file: str, seen: Seen) -> str | None:
        """The name under which a file is there now: its own, or another one in its folder."""
        if self.holds(file, seen):
            return file
        folder = file[: file.rfind("/") + 1]
        for name, is_folder, measure in self._entries(folder):
            if not is_folder and folder + name != file and self._long_enough(measure, seen):
                if self.holds(folder + name, seen):
                    return folder + name
        return None

    @staticmethod
    def _long_enough(measure, seen: Seen) -> bool:
        try:
            return measure()[1] >= seen.length
        except FileNotFoundError:
            return False


def continued(
    old: dict[str, Seen], new: dict[str, Seen], holds
) -> dict[str, int]:
    """Where each file of the new snapshot goes on: the length that was read already, 0 for a new file.

    ``holds(file, seen)`` tells whether a file now holds what was seen at its end then.
    """

    def same(file: str, seen: Seen, before: Seen) -> bool:
        if before.head != seen.head or before.length > seen.length:
            return False
        if before.length == seen.length:
            return before.tail == seen.tail
        return holds(file, before)

    found, left, open_ = {}, dict(old), []
    for file in sorted(new):
        if file in left and same(file, new[file], left[file]):
            found[file] = left.pop(file).length
        else:
            open_.append(file)
    by_head: dict[tuple[str, str], list[str]] = {}
    for file in sorted(left):
        by_head.setdefault((file[: file.rfind("/") + 1], left[file].head), []).append(file)
    for file in open_:
        others = by_head.get((file[: file.rfind("/") + 1], new[file].head), [])
        for other in sorted(others, key=lambda other: -left[other].length):
            if same(file, new[file], left[other]):
                found[file] = left[other].length
                others.remove(other)
                break
        else:
            found[file] = 0
    return found


class GrowingReader(DS.DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.place = options["root"], int(options.get("depth", 1)), options.get("names", "*")
        self.range_bytes = int(options.get("rangebytes", RANGE_BYTES))
        self.fail_on_loss = options.get("failonloss", "true").lower() == "true"
        self.known: dict[str, Seen] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        files = Files(*self.place)

        def seen(found: tuple[str, int, int]) -> tuple[str, Seen | None]:
            file, length, changed = found
            before = self.known.get(file)
            if before and (before.length, before.changed) == (length, changed):
                return file, before
            try:
                head = files.head(file)
                return file, Seen(length, changed, head, files.tail(file, length)) if head else None
            except OSError:
                return file, None

        with ThreadPoolExecutor(REQUESTS) as pool:
            self.known = {file: entry for file, entry in pool.map(seen, files.listed()) if entry}
        return {file: self.known[file].text() for file in sorted(self.known)}

    def partitions(self, start: dict, end: dict) -> list[Ranges]:
        files = Files(*self.place)
        old, new = ({file: Seen.of(text) for file, text in offset.items()} for offset in (start, end))
        begins = continued(
            {file: old[file] for file in old if new.get(file) != old[file]},
            {file: new[file] for file in new if new[file] != old.get(file)},
            # By now the file of the new snapshot may have been renamed.
            lambda file, before: files.holds(files.find(file, new[file]) or file, before),
        )
        parts, held = [[]], 0
        for file in sorted(begins):
            for low in range(begins[file], new[file].length, self.range_bytes):
                high = min(low + self.range_bytes, new[file].length)
                if held and (held + high - low > self.range_bytes or len(parts[-1]) == RANGES_EACH):
                    parts.append([])
                    held = 0
                parts[-1].append(Range(file, new[file], low, high))
                held += high - low
        return [Ranges(ranges) for ranges in parts if ranges]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        files, rows = Files(*self.place), []
        for one in partition.ranges:
            name = files.find(one.file, one.seen)
            if name is None:
                if self.fail_on_loss:
                    raise FileIsGone(f"{one.file} is gone before it was read; failOnLoss=false goes on without it")
                continue
            for position, line in lines_between(lambda a, b: files.bytes(name, a, b), one.start, one.end):
                message = line.decode("utf-8", "replace")
                rows.append((message, f"{files.root}/{one.file}", one.seen.changed, position))
                if len(rows) == BATCH_ROWS:
                    yield _batch(rows)
                    rows = []
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(column, field.type) for column, field in zip(zip(*rows), _LINES_SCHEMA)]
    return pa.RecordBatch.from_arrays(columns, schema=_LINES_SCHEMA)


def lines_between(read, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Lines whose line feed lies from ``start`` to ``end``, and where they begin."""
    begin, held = start, b""
    while begin > 0 and b"\n" not in held:
        back = max(0, begin - max(SEEN, len(held)))
        held = read(back, begin) + held
        begin = back
    kept = held.rpartition(b"\n")[2]
    at, rest = start - len(kept), [kept]
    for low in range(start, end, BLOCK):
        *whole, last = read(low, min(low + BLOCK, end)).split(b"\n")
        if whole:
            whole[0] = b"".join([*rest, whole[0]])
            for line in whole:
                yield at, line
                at += len(line) + 1
            rest = []
        rest.append(last)


class GrowingLines(DS.DataSource):
    """``format("growing_lines")``: options ``root``, ``depth`` (folders between root and files), ``names``
    (a pattern), ``rangeBytes`` and ``failOnLoss``."""

    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return LINES

    def streamReader(self, schema) -> GrowingReader:
        return GrowingReader(self.options)


def read_growing_lines(
    spark: SparkSession, root: str, names: str, depth: int = 1, options: dict | None = None
) -> DataFrame:
    """Lines of the growing files called ``names`` in the folders ``depth`` levels below a root.

    Gives path and time of the file with each line, as ``read_lines`` does, and the position of the line in it.
    """
    register_source(spark, GrowingLines)
    given = {"root": root, "names": names, "depth": str(depth)} | (options or {})
    lines = spark.readStream.format("growing_lines").options(**given).load()
    return lines.withColumn("message", F.regexp_replace("message", r"\r\z", ""))
