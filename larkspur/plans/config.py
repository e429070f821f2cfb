"""Settings of a build: defaults, a TOML file over them, command-line values over both."""

from __future__ import annotations

import datetime
import os
import tomllib
from dataclasses import dataclass, field, fields, replace
from pathlib import Path
from typing import Any

UNITS = {"": 1, "B": 1, "K": 1 << 10, "M": 1 << 20, "G": 1 << 30, "T": 1 << 40}


def parse_size(text: str) -> int:
    """Bytes of "1.5GiB", "300 MB", "2k", "77": all units are powers of 1024, in either case."""
    text = text.strip().upper()
    number = text.rstrip("ABCDEFGHIJKLMNOPQRSTUVWXYZ").strip()
    unit = text[len(text.rstrip("ABCDEFGHIJKLMNOPQRSTUVWXYZ")) :]
    short = unit.removesuffix("IB") if len(unit) == 3 else unit.removesuffix("B") if len(unit) == 2 else unit
    try:
        return int(float(number) * UNITS[short])
    except (ValueError, KeyError, OverflowError):
        raise ValueError(f"not a size: {text!r}") from None


def format_bytes(n: int) -> str:
    """Bytes in the largest unit of 1024**k that is not above them, PiB at most, to two places."""
    k = min(max(abs(n).bit_length() - 1, 0) // 10, 5)
    return f"{n / (1 << 10 * k):.2f} {' KMGTP'[k].strip()}{'iB' if k else 'B'}"


def percent(done: int, total: int) -> str:
    return f"{100 * done / total:.1f}" if total else "?"


def _read_int(path: str) -> int | None:
    try:
        return int(Path(path).read_text().strip())
    except (OSError, ValueError):
        return None


def auto_memory(limit: int | None = None, ram: int | None = None) -> str:
    """80 % of what the container or machine has, 128 GiB at most, in MiB."""
    limit = limit or _read_int("/sys/fs/cgroup/memory.max") or _read_int("/sys/fs/cgroup/memory/memory.limit_in_bytes")
    ram = ram or os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    return f"{min(int(min(limit or ram, ram) * 0.8), 128 << 30) >> 20}MiB"


#: Where the store's credentials are read from; without them Hadoop's own providers are asked.
CREDENTIALS = {"fs.s3a.access.key": "AWS_ACCESS_KEY_ID", "fs.s3a.secret.key": "AWS_SECRET_ACCESS_KEY"}


@dataclass(frozen=True)
class Upload:
    kind: str = "files"
    bucket: str = ""
    prefix: str = ""
    endpoint: str | None = None
    account_id: str | None = None
    region: str = "auto"
    concurrency: int = 8
    include: tuple[str, ...] = ("raw", "snapshot")

    def root(self) -> str:
        """The URI that uploads go under: a folder for `files`, an s3a bucket for `s3a`."""
        if self.kind == "files":
            return self.bucket
        if self.kind == "s3a":
            return f"s3a://{self.bucket}"
        raise ValueError(f"no such kind of store: {self.kind}")

    def options(self) -> dict[str, str]:
        """Hadoop settings of the store; a stated endpoint wins over one made from the account. Credentials come from the environment only."""
        if self.kind != "s3a":
            return {}
        endpoint = self.endpoint or (f"https://{self.account_id}.r2.cloudflarestorage.com" if self.account_id else None)
        secrets = {option: os.environ[name] for option, name in CREDENTIALS.items() if os.environ.get(name)}
        if len(secrets) == 1:
            raise ValueError(f"{' and '.join(CREDENTIALS.values())} go together")
        return {"fs.s3a.endpoint.region": self.region} | ({"fs.s3a.endpoint": endpoint} if endpoint else {}) | secrets


@dataclass(frozen=True)
class Config:
    source: str = "./index"
    work_dir: str = "./var"
    snapshot_date: str | None = None
    memory_limit: str = "4GiB"
    batch_size: int = 100_000
    mirror_concurrency: int = 32
    backup_id: int | None = None
    chunks: int | None = None
    chunk_dry_run: bool = False
    upload: Upload | None = field(default=None)

    @classmethod
    def load(cls, path: str | None = None, **given: Any) -> Config:
        """Unknown keys of the file are let pass; given values that are None don't count."""
        read = tomllib.loads(Path(path).read_text()) if path else {}
        known = {f.name for f in fields(cls)}
        values = {k: v for k, v in read.items() if k in known} | {k: v for k, v in given.items() if v is not None}
        if isinstance(up := values.get("upload"), dict):
            values["upload"] = Upload(**{k: tuple(str(x).lower() for x in v) if k == "include" else v for k, v in up.items() if k in {f.name for f in fields(Upload)}})
        return cls(**values)

    def dated(self) -> Config:
        return self if self.snapshot_date else replace(self, snapshot_date=datetime.datetime.now(datetime.UTC).date().isoformat())

    def spark_memory(self) -> str:
        """The memory limit as Spark writes sizes, in MiB."""
        return f"{max(parse_size(self.memory()) >> 20, 512)}m"

    def memory(self) -> str:
        return auto_memory() if self.memory_limit == "auto" else self.memory_limit

    @property
    def mirror_dir(self) -> str:
        return f"{self.work_dir}/index"

    @property
    def scratch_dir(self) -> str:
        return f"{self.work_dir}/scratch/{self.snapshot_date}"

    @property
    def raw_dir(self) -> str:
        return f"{self.work_dir}/raw/{self.snapshot_date}"

    @property
    def snapshot_dir(self) -> str:
        return f"{self.work_dir}/snapshot/{self.snapshot_date}"
