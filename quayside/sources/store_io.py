"""Object reads and writes of single tasks, used inside Python workers.

Stores are reached through Arrow file systems. On a mounted file system objects appear by
renaming a hidden file. On object stores they are written under a key of their own, copied to the
target by the store when they are whole, and deleted there; a write that fails never touches the
target. Uploads of one object by many tasks, copies inside a store and listings by pages are requests
of ``s3_requests``. A task that runs twice leaves the same object.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid

import pyarrow as pa
from pyarrow import fs

from quayside.sources.s3_requests import DEFAULT_REGION, Credential, S3Client

BLOCK = 8 * 1024 * 1024
# File systems whose URIs name a host, and which rename files.
ON_HOST = ("hdfs://", "viewfs://")
S3_SCHEMES = ("s3a://", "s3n://", "s3://")
# Files and keys of objects that are not complete yet.
COLLECTING, COLLECTING_END = ".quayside-", ".part"


class StoreError(Exception):
    """A request that cannot be served; its text becomes the error of the status row."""


# What a single bad row may raise: Arrow refuses some names and schemes with a ValueError.
FAILURES = (StoreError, OSError, ValueError, pa.ArrowException)


def is_local(uri: str) -> bool:
    return uri.startswith(("/", "file:"))


def is_s3(uri: str) -> bool:
    return uri.startswith(S3_SCHEMES)


def read_credential(root: str, alias: str) -> dict[str, str]:
    """The key pair of an alias from a folder that is mounted on this machine."""
    if not alias or "/" in alias or "\0" in alias or alias in (".", ".."):
        raise StoreError("the credential alias is not valid")
    found = {}
    for name in ("access_key", "secret_key"):
        path = os.path.join(local_path(root), alias, name)
        if not os.path.isfile(path):
            raise StoreError("the credential is not there")
        with open(path) as file:
            found[name] = file.read().strip()
    return found


def open_store(
    uri: str, endpoint: str | None = None, credential: dict[str, str] | None = None
) -> tuple[fs.FileSystem, str]:
    """File system and path of an object. Without a credential the worker's environment counts."""
    if is_local(uri):
        return fs.LocalFileSystem(), local_path(uri)
    if uri.startswith(S3_SCHEMES):
        options = dict(credential or {})
        if endpoint:
            options["endpoint_override"] = endpoint
        return fs.S3FileSystem(**options), uri.partition("://")[2]
    return fs.FileSystem.from_uri(uri)


def local_path(uri: str) -> str:
    """Path of a ``file:`` URI; names are not percent-encoded in these URIs."""
    return re.sub("^file:(//[^/]*)?", "", uri)


def is_collecting(name: str) -> bool:
    """Whether a file of this name holds an object that is not complete yet."""
    return name.startswith(COLLECTING) and name.endswith(COLLECTING_END)


def collecting_name(mark: str) -> str:
    return f"{COLLECTING}{mark}{COLLECTING_END}"


class Digests:
    """SHA-256 of some bytes, and of each of their ranges of a fixed length."""

    def __init__(self, range_bytes: int | None = None) -> None:
        self.length = 0
        self._whole, self._range = hashlib.sha256(), hashlib.sha256()
        self._range_bytes, self._ranges = range_bytes, []

    def update(self, block) -> None:
        self._whole.update(block)
        view = memoryview(block)
        while len(view) and self._range_bytes:
            if self.length and self.length % self._range_bytes == 0:
                self._ranges.append(self._range.hexdigest())
                self._range = hashlib.sha256()
            part = view[: self._range_bytes - self.length % self._range_bytes]
            self._range.update(part)
            self.length += len(part)
            view = view[len(part) :]
        self.length += len(view)

    def whole(self) -> str:
        return self._whole.hexdigest()

    def ranges(self) -> str:
        """Digests of the ranges, joined; an object without bytes has one empty range."""
        return "".join([*self._ranges, self._range.hexdigest()])


def _times(status: os.stat_result) -> tuple[float, int]:
    return status.st_mtime, status.st_size


def check_address(bucket: str | None, name: str | None) -> None:
    """Refuse buckets and names that lead out of their root or bucket, or that files can't have."""
    if not bucket or "/" in bucket or "\0" in bucket or bucket in (".", ".."):
        raise StoreError("the bucket name is not valid")
    if not name:
        raise StoreError("the object has no name")
    if name.startswith("/") or ".." in name.split("/"):
        raise StoreError("the object name leaves its bucket")
    if "\0" in name:
        raise StoreError("the object name is not valid")


class Store:
    """Objects below one root, with the file systems and bucket checks of a task kept."""

    def __init__(self, credentials_root: str | None = None) -> None:
        self._credentials_root = credentials_root
        self._systems: dict[tuple[str, str | None, str | None], fs.FileSystem] = {}
        self._clients: dict[tuple[str | None, str | None], S3Client] = {}
        self._buckets: dict[tuple[str, str | None, str | None], bool] = {}

    def locate(
        self, uri: str, endpoint: str | None = None, alias: str | None = None
    ) -> tuple[fs.FileSystem, str]:
        scheme, _, rest = uri.partition("://")
        on_host = uri.startswith(ON_HOST)
        alias = alias if self._credentials_root else None
        key = (f"{scheme}://{rest.partition('/')[0]}" if on_host else scheme, endpoint, alias)
        if is_local(uri):
            key = ("file", None, None)
        if key not in self._systems:
            credential = None
            if alias is not None and not is_local(uri):
                credential = read_credential(self._credentials_root, alias)
            self._systems[key] = open_store(uri, endpoint, credential)[0]
        system = self._systems[key]
        if is_local(uri):
            return system, local_path(uri)
        return system, "/" + rest.partition("/")[2] if on_host else rest

    def client(
        self, uri: str, endpoint: str | None = None, alias: str | None = None
    ) -> tuple[S3Client, str, str]:
        """Requests to the store of an object, its bucket and its key."""
        alias = alias if self._credentials_root else None
        if (endpoint, alias) not in self._clients:
            credential = Credential.of_environment() if alias is None else None
            if credential is None:
                pair = read_credential(self._credentials_root, alias)
                region = os.environ.get("AWS_REGION") or os.environ.get("AWS_DEFAULT_REGION")
                credential = Credential(pair["access_key"], pair["secret_key"], region=region or DEFAULT_REGION)
            self._clients[endpoint, alias] = S3Client(endpoint, credential)
        bucket, _, key = uri.partition("://")[2].partition("/")
        return self._clients[endpoint, alias], bucket, key

    def measure(
        self, uri: str, endpoint: str | None = None, alias: str | None = None
    ) -> tuple[int, int | None] | None:
        """Length and time of change (in microseconds) of an object, null when there is none."""
        system, path = self.locate(uri, endpoint, alias)
        info = system.get_file_info(path)
        if info.type != fs.FileType.File:
            return None
        return info.size, info.mtime_ns // 1000 if info.mtime_ns is not None else None

    def length(self, uri: str, endpoint: str | None = None) -> int | None:
        """Length of an object, null when there is none."""
        found = self.measure(uri, endpoint)
        return found[0] if found else None

    def entries(self, uri: str, endpoint: str | None = None, collecting: bool = False):
        """Children of a folder as (name, whether it is a folder, a function that measures it).

        Files that a write is still collecting are left out, or, if asked for, given alone. A measure is the time of change in seconds and
        the length; on mounted file systems it costs a call for each file, in stores it is known.
        """
        system, path = self.locate(uri, endpoint)
        if is_local(uri):
            with os.scandir(path) as found:
                for entry in found:
                    folder = entry.is_dir(follow_symlinks=False)
                    if folder or is_collecting(entry.name) == collecting:
                        yield entry.name, folder, lambda entry=entry: _times(entry.stat(follow_symlinks=False))
            return
        for info in system.get_file_info(fs.FileSelector(path)):
            if info.type != fs.FileType.Directory and is_collecting(info.base_name) != collecting:
                continue
            measure = (info.mtime.timestamp() if info.mtime else None, info.size)
            yield info.base_name, info.type == fs.FileType.Directory, lambda measure=measure: measure

    def stat(self, uri: str, endpoint: str | None = None) -> tuple[float | None, int] | None:
        """Time of change in seconds and length of a listed file, null if it is gone."""
        if is_local(uri):
            try:
                return _times(os.lstat(local_path(uri)))
            except FileNotFoundError:
                return None
        found = self.measure(uri, endpoint)
        return found and (None if found[1] is None else found[1] / 1e6, found[0])

    def has_bucket(self, bucket_uri: str, endpoint: str | None = None, alias: str | None = None) -> bool:
        system, path = self.locate(bucket_uri, endpoint, alias)
        return system.get_file_info(path).type == fs.FileType.Directory

    def require_bucket(
        self, uri: str, name: str, endpoint: str | None = None, alias: str | None = None
    ) -> None:
        bucket_uri = uri[: len(uri) - len(name) - 1]
        key = (bucket_uri, endpoint, alias)
        if key not in self._buckets:
            self._buckets[key] = self.has_bucket(bucket_uri, endpoint, alias)
        if not self._buckets[key]:
            raise StoreError("the bucket does not exist")

    def create_bucket(
        self, uri: str, name: str, endpoint: str | None = None, alias: str | None = None
    ) -> None:
        """Create the bucket of an object if it is not there; safe to run twice."""
        bucket_uri = uri[: len(uri) - len(name) - 1]
        key = (bucket_uri, endpoint, alias)
        if not self._buckets.get(key):
            system, path = self.locate(bucket_uri, endpoint, alias)
            system.create_dir(path, recursive=is_local(uri) or uri.startswith(ON_HOST))
            self._buckets[key] = True

    def _staged(
        self, uri: str, mark: str, endpoint: str | None, alias: str | None
    ) -> tuple[fs.FileSystem, str, str]:
        """File system, target, and what collects the bytes of the target until it is whole."""
        system, path = self.locate(uri, endpoint, alias)
        return system, path, f"{os.path.dirname(path)}/{collecting_name(mark)}"

    def stage(
        self,
        uri: str,
        mark: str,
        blocks,
        endpoint: str | None = None,
        range_bytes: int | None = None,
        alias: str | None = None,
    ) -> Digests:
        """Write an object from an iterable of byte blocks beside its target; gives its length and hashes."""
        system, path, staged = self._staged(uri, mark, endpoint, alias)
        digests = Digests(range_bytes)
        if is_local(uri) or uri.startswith(ON_HOST):
            system.create_dir(os.path.dirname(path), recursive=True)
        try:
            with system.open_output_stream(staged) as out:
                for block in blocks:
                    out.write(block)
                    digests.update(block)
        except Exception:
            # Closing the stream has left what was written so far.
            self.discard(uri, mark, endpoint, alias)
            raise
        return digests

    def publish(
        self, uri: str, mark: str, endpoint: str | None = None, length: int | None = None, alias: str | None = None
    ) -> None:
        """Give a staged object its name. With its length this may run again."""
        system, path, staged = self._staged(uri, mark, endpoint, alias)
        if length is not None and system.get_file_info(staged).type != fs.FileType.File:
            there = system.get_file_info(path)
            if there.type != fs.FileType.File or there.size != length:
                raise StoreError("the collected object is gone")
            return
        if is_local(uri):
            os.replace(staged, path)
        elif uri.startswith(ON_HOST):
            if system.get_file_info(path).type != fs.FileType.NotFound:
                system.delete_file(path)
            system.move(staged, path)
        else:
            system.copy_file(staged, path)
            system.delete_file(staged)

    def remove(self, uri: str, endpoint: str | None = None) -> None:
        system, path = self.locate(uri, endpoint)
        if system.get_file_info(path).type == fs.FileType.File:
            system.delete_file(path)

    def discard(self, uri: str, mark: str, endpoint: str | None = None, alias: str | None = None) -> None:
        system, _, staged = self._staged(uri, mark, endpoint, alias)
        if system.get_file_info(staged).type == fs.FileType.File:
            system.delete_file(staged)

    def write(
        self,
        uri: str,
        blocks,
        endpoint: str | None = None,
        range_bytes: int | None = None,
        alias: str | None = None,
    ) -> Digests:
        """Write an object from an iterable of byte blocks; gives its length and hashes."""
        mark = uuid.uuid4().hex
        digests = self.stage(uri, mark, blocks, endpoint, range_bytes, alias)
        self.publish(uri, mark, endpoint, alias=alias)
        return digests

    def blocks(self, uri: str, offset: int, length: int, endpoint: str | None = None):
        """Bytes ``offset .. offset + length`` of an object, block by block."""
        system, path = self.locate(uri, endpoint)
        left = length
        with system.open_input_file(path) as source:
            source.seek(offset)
            while left > 0:
                block = source.read(min(BLOCK, left))
                if not block:
                    raise StoreError("the source object became shorter")
                left -= len(block)
                yield block

    def write_range(self, path: str, offset: int, blocks) -> Digests:
        """Write blocks at a position of a file on a mounted file system."""
        digests, at = Digests(), offset
        os.makedirs(os.path.dirname(path), exist_ok=True)
        handle = os.open(path, os.O_WRONLY | os.O_CREAT, 0o644)
        try:
            for block in blocks:
                view = memoryview(block)
                while view:
                    done = os.pwrite(handle, view, at)
                    view, at = view[done:], at + done
                digests.update(block)
        finally:
            os.close(handle)
        return digests
