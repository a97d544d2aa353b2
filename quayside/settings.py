"""Values that belong to a deployment, passed in by the caller."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TransferSettings:
    """Where objects live and which address type this installation serves.

    ``store_type`` is the address type that is routed here, ``default_endpoint`` is used
    when a credential exists but the destination names no storage, and
    ``connector_endpoint`` when there is no credential. ``source_root`` and
    ``target_root`` are the URIs under which buckets are found (``s3a://``,
    ``file:///mount/objects``).

    ``credentials_root`` is a folder that is mounted on every executor, with a folder for each
    credential alias that holds the files ``access_key`` and ``secret_key``. Targets of requests whose
    alias has a token are opened with them; without this folder, and for sources, the
    environment of the executors counts.

    With ``copy_by_store``, objects whose source and target are in one store with the S3 interface, both
    under the credential of the environment, are copied by the store. Their bytes pass no task, so
    they have no checksum.
    """

    store_type: str
    default_endpoint: str
    connector_endpoint: str
    source_root: str = "s3a://"
    target_root: str = "s3a://"
    credentials_root: str | None = None
    copy_by_store: bool = False


@dataclass(frozen=True)
class Deployment:
    """The four labels every log event of one deployment carries."""

    namespace: str
    cluster: str
    role: str
    role_group: str
