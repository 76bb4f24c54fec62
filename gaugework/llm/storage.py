"""Files that Python tasks write to the shared store, committed by rename.

A path is a URI as Hadoop would take it (file, hdfs, s3, gs). A file is written
under a name of its attempt and renamed when whole, so a lost or repeated task
leaves either nothing or the same bytes under the final name.
"""

from __future__ import annotations

import hashlib
import uuid

from pyarrow import fs as pafs


def resolve(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


class AtomicFile:
    """Write-only file that appears under its name on commit(); counts and hashes its bytes."""

    def __init__(self, folder: str, name: str):
        self.fs, root = resolve(folder)
        self.name, self.final = name, f"{root}/{name}"
        self.temp = f"{root}/_tmp-{name}-{uuid.uuid4().hex}"
        self.fs.create_dir(root, recursive=True)
        self.out = self.fs.open_output_stream(self.temp, compression=None)
        self.size, self.sha = 0, hashlib.sha256()

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)
        self.sha.update(data)

    def commit(self) -> str:
        self.out.close()
        try:
            self.fs.move(self.temp, self.final)
        except OSError:
            # Another attempt of the same task was first; its bytes are the same.
            if self.fs.get_file_info(self.final).type != pafs.FileType.File:
                raise
            self.fs.delete_file(self.temp)
        return self.sha.hexdigest()

    def abort(self) -> None:
        self.out.close()
        if self.fs.get_file_info(self.temp).type == pafs.FileType.File:
            self.fs.delete_file(self.temp)


def put(folder: str, name: str, data: bytes) -> None:
    file = AtomicFile(folder, name)
    file.write(data)
    file.commit()


def get(folder: str, name: str) -> bytes:
    fs, root = resolve(folder)
    with fs.open_input_stream(f"{root}/{name}", compression=None) as f:
        return f.read()
