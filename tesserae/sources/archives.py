"""Archives: what may be opened, and what is in them. Checks fail closed."""

from __future__ import annotations

import hashlib
import io
import re
import zipfile
from dataclasses import dataclass

from ..errors import BuildError

# How a file of each kind begins.
MAGIC = {"zip": (b"PK\x03\x04", b"PK\x05\x06"), "xlsx": (b"PK\x03\x04",), "doc": (b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1",), "xls": (b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1",), "gz": (b"\x1f\x8b",)}


@dataclass(frozen=True)
class Limits:
    members: int = 1000
    ratio: float = 200.0
    bytes: int = 4 << 30


def check_magic(kind: str, content: bytes) -> None:
    """An error page saved under an archive's name must not reach a parser."""
    if kind in MAGIC and not content.startswith(MAGIC[kind]):
        raise BuildError("SOURCE_FETCH_FAILED", f"not a {kind} file", begins=content[:16])


def safe_members(archive: zipfile.ZipFile, limits: Limits = Limits()) -> list[zipfile.ZipInfo]:
    """The files of an archive, in its order, or an error: paths that leave it, too many members, too much in too little."""
    found = [i for i in archive.infolist() if not i.is_dir()]
    if len(found) > limits.members:
        raise BuildError("UNSAFE_ARCHIVE", "too many members", members=len(found))
    for i in found:
        path = i.filename.replace("\\", "/")
        if path.startswith("/") or re.match(r"[A-Za-z]:", path) or ".." in path.split("/"):
            raise BuildError("UNSAFE_ARCHIVE", "a path leaves the archive", member=i.filename)
        if i.file_size > limits.ratio * max(1, i.compress_size):
            raise BuildError("UNSAFE_ARCHIVE", "compressed too well", member=i.filename, ratio=i.file_size / max(1, i.compress_size))
    if sum(i.file_size for i in found) > limits.bytes:
        raise BuildError("UNSAFE_ARCHIVE", "too large")
    return found


def read_members(content: bytes, suffix: str = "", limits: Limits = Limits(), depth: int = 2):
    """(name, bytes) of the members that end in ``suffix``, those of archives in the archive included, ``depth`` archives deep; a deeper one is an error."""
    check_magic("zip", content)
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        for i in safe_members(archive, limits):
            if i.filename.lower().endswith(".zip") and suffix.lower() != ".zip":
                if depth <= 1:
                    raise BuildError("UNSAFE_ARCHIVE", "archives too deep in one another", member=i.filename)
                for name, data in read_members(archive.read(i), suffix, limits, depth - 1):
                    yield f"{i.filename}/{name}", data
            elif i.filename.lower().endswith(suffix.lower()):
                yield i.filename, archive.read(i)


def mask_digits(member: str) -> str:
    """A member's name for comparison from year to year."""
    return re.sub(r"\d", "N", member.rsplit("/", 1)[-1])


@dataclass(frozen=True)
class SchemaInfo:
    """What a payload looks like; ``notes`` are footnotes, whose change is a change of meaning."""

    columns: tuple[str, ...]
    encoding: str
    container: str
    members: tuple[str, ...] = ()
    delimiter: str | None = None
    has_header: bool = True
    notes: tuple[str, ...] = ()

    @property
    def fingerprint(self) -> str:
        parts = [*self.columns, *(f"note:{n}" for n in self.notes), self.encoding, self.container, *map(mask_digits, self.members), self.delimiter or "", str(self.has_header)]
        return hashlib.sha256("\x1f".join(parts).encode()).hexdigest()


def check_drift(resource: str, found: SchemaInfo, expected: SchemaInfo) -> None:
    """Any difference stops the build: columns added, removed or re-ordered, another encoding, other members but for digits."""
    if found.fingerprint != expected.fingerprint:
        raise BuildError("SOURCE_SCHEMA_CHANGED", f"{resource} does not look as pinned", found=found.columns, expected=expected.columns, encoding=found.encoding)


def change_signature(discovered: dict[str, str]) -> str:
    """Resources and their versions as one text, in order: equal if nothing changed."""
    return "\n".join(f"{k}\t{discovered[k]}" for k in sorted(discovered))


def fallbacks(resolved_via: dict[str, str]) -> list[str]:
    """Resources that were not found by discovery."""
    return sorted(k for k, via in resolved_via.items() if via != "discovery")


def check_shape_container(content: bytes, encoding: str = "UTF-8", datum: str = "JGD_2011") -> None:
    """A shapefile's archive states its encoding and datum exactly once each; anything else is not what the reader assumes."""
    for suffix, wanted in ((".cpg", encoding), (".prj", datum)):
        found = [data.decode("ascii", "replace").strip() for _, data in read_members(content, suffix)]
        if len(found) != 1 or wanted.lower() not in found[0].lower():
            raise BuildError("SOURCE_SCHEMA_CHANGED", f"{suffix} is not as expected", found=found[:3], expected=wanted)
