"""Files that are appended to and renamed: every whole line is read once."""

from __future__ import annotations

import os
import random

import pytest

from quayside.streaming import growing_files as G


def lines_of(data, start, end):
    found, at = [], 0
    for line in data.split(b"\n")[:-1]:
        if start <= at + len(line) < end:
            found.append((at, line))
        at += len(line) + 1
    return found


def test_ranges_share_no_line(monkeypatch):
    draw = random.Random(1)
    for block in (3, 7, G.BLOCK):
        monkeypatch.setattr(G, "BLOCK", block)
        monkeypatch.setattr(G, "SEEN", 4)
        for _ in range(200):
            data = bytes(draw.choice(b"ab\n") for _ in range(draw.randrange(60)))
            cuts = sorted({0, len(data), *(draw.randrange(len(data) + 1) for _ in range(4))})
            found = []
            for low, high in zip(cuts, cuts[1:]):
                part = list(G.lines_between(lambda a, b: data[a:b], low, high))
                assert part == lines_of(data, low, high)
                found += part
            assert found == lines_of(data, 0, len(data))


class Folder:
    """A stream over a folder, its reader made anew at will as after a restart."""

    def __init__(self, root, **options):
        self.root, self.options = str(root), {"root": f"file://{root}", "names": "*.log"} | options
        self.reader, self.offset, self.found = None, {}, []

    def write(self, name, text, mode="wb"):
        path = os.path.join(self.root, "svc", name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, mode) as out:
            out.write(text)

    def rename(self, old, new):
        os.rename(os.path.join(self.root, "svc", old), os.path.join(self.root, "svc", new))

    def poll(self, restart=False, between=None):
        if restart or self.reader is None:
            self.reader = G.GrowingReader(self.options)
        end = self.reader.latestOffset()
        if between:
            between()
        parts = self.reader.partitions(self.offset, end)
        self.offset = end
        got = [r["message"] for p in parts for b in self.reader.read(p) for r in b.to_pylist()]
        self.found += got
        return got


def test_growth_and_rotation(tmp_path):
    f = Folder(tmp_path)
    assert f.poll() == []
    f.write("a.0.log", b"one\ntwo\nthr")
    f.write("ignored.txt", b"x\n")
    assert f.poll() == ["one", "two"]
    f.write("a.0.log", b"ee\nfour\n", "ab")
    assert f.poll(restart=True) == ["three", "four"]
    assert f.poll() == []
    # A full file gets the next number while it has lines that are not read yet.
    f.write("a.0.log", b"five\n", "ab")
    f.rename("a.0.log", "a.1.log")
    f.write("a.0.log", b"new one\n")
    assert sorted(f.poll(restart=True)) == ["five", "new one"]
    f.rename("a.1.log", "a.2.log")
    f.rename("a.0.log", "a.1.log")
    f.write("a.1.log", b"new two\n", "ab")
    f.write("a.0.log", b"newest")
    assert f.poll() == ["new two"]
    f.write("a.0.log", b" line\r\n", "ab")
    assert f.poll() == ["newest line\r"]


def test_same_head_and_same_content(tmp_path):
    """Every file begins with the same line; files of equal content are files of their own."""
    f = Folder(tmp_path)
    head = b"banner\n"
    f.write("a.0.log", head + b"1\n2\n")
    f.write("twin.log", head + b"1\n2\n")
    assert sorted(f.poll()) == sorted(["banner", "1", "2"] * 2)
    f.rename("a.0.log", "a.1.log")
    f.write("a.0.log", head + b"3\n4\n5\n6\n")
    assert f.poll() == ["banner", "3", "4", "5", "6"]
    f.write("third.log", head + b"1\n2\n")
    assert f.poll() == ["banner", "1", "2"]
    # A file that is written anew is read from its start.
    f.write("twin.log", head + b"9\n")
    assert f.poll() == ["banner", "9"]


def test_renamed_after_it_was_listed(tmp_path):
    f = Folder(tmp_path)
    f.write("a.0.log", b"one\n")

    def rotate():
        f.rename("a.0.log", "a.1.log")
        f.write("a.0.log", b"other\n")

    assert f.poll(between=rotate) == ["one"]
    assert f.poll() == ["other"]
    f.write("a.1.log", b"two\n", "ab")

    def again():
        f.rename("a.1.log", "a.2.log")
        f.rename("a.0.log", "a.1.log")

    assert f.poll(between=again, restart=True) == ["two"]
    assert f.poll() == []
    f.write("b.log", b"x\n")
    with pytest.raises(G.FileIsGone):
        f.poll(between=lambda: os.remove(tmp_path / "svc" / "b.log"))
    f.options["failonloss"] = "false"
    f.write("c.log", b"y\n")
    assert f.poll(between=lambda: os.remove(tmp_path / "svc" / "c.log"), restart=True) == []


def test_long_files_are_divided(tmp_path):
    f = Folder(tmp_path, rangebytes="1000")
    lines = [f"{i} " + "x" * (i % 300) for i in range(500)]
    f.write("a.log", "\n".join(lines).encode() + b"\n")
    for n in range(20):
        f.write(f"s{n}.log", b"short\n")
    f.reader = G.GrowingReader(f.options)
    parts = f.reader.partitions({}, f.reader.latestOffset())
    assert len(parts) > 50 and any(len(p.ranges) > 10 for p in parts)
    assert f.poll() == lines + ["short"] * 20


def test_stream_over_two_runs(spark, tmp_path):
    """The second run goes on where the checkpoint of the first one says."""
    f = Folder(tmp_path / "logs")

    def run():
        lines = G.read_growing_lines(spark, f"file://{tmp_path}/logs", "*.log")
        query = (
            lines.writeStream.format("parquet").option("path", f"{tmp_path}/out")
            .option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        found = spark.read.parquet(f"{tmp_path}/out").collect()
        return sorted((r.message, os.path.basename(r.file), r.position) for r in found)

    f.write("a.0.log", b"one\r\ntw")
    assert run() == [("one", "a.0.log", 0)]
    f.write("a.0.log", b"o\nthree\n", "ab")
    f.rename("a.0.log", "a.1.log")
    f.write("a.0.log", "ünf\n".encode() + b"\xff\n")
    want = [("one", "a.0.log", 0), ("three", "a.1.log", 9), ("two", "a.1.log", 5), ("ünf", "a.0.log", 0)]
    want.append(("�", "a.0.log", 5))
    assert run() == sorted(want)
    assert run() == sorted(want)


def test_no_folder_yet(tmp_path):
    f = Folder(tmp_path / "none")
    assert f.poll() == []
