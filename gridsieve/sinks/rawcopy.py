"""Byte copies of source files, with length and digest of each."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BLOCK = 8 * 1024 * 1024


def _file_system(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def raw_copy(files: DataFrame, target: str, relative: str = "name") -> DataFrame:
    """Copy each file below ``target``; ``(path, target, length, sha256)`` per file.

    Files are spread over the tasks and streamed block by block, so their size
    does not matter.  A copy is written under a name of its own and then moved, so a
    repeated task leaves one whole file.  The result must be acted on once.  Files that would
    share a target are an error; ``relative`` then has to name a longer path.
    """

    def copy(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib
        import posixpath
        import uuid

        for batch in batches:
            rows = []
            for path, inner in zip(batch["path"], batch["inner"], strict=True):
                source, source_path = _file_system(path)
                sink, sink_path = _file_system(f"{target}/{inner}")
                sink.create_dir(posixpath.dirname(sink_path), recursive=True)
                staged = f"{sink_path}.{uuid.uuid4().hex}.part"
                digest, length = hashlib.sha256(), 0
                with source.open_input_stream(source_path) as read, sink.open_output_stream(staged) as write:
                    while block := read.read(_BLOCK):
                        digest.update(block)
                        length += len(block)
                        write.write(block)
                sink.move(staged, sink_path)
                rows.append((path, f"{target}/{inner}", length, digest.hexdigest()))
            yield pd.DataFrame(rows, columns=["path", "target", "length", "sha256"])

    spread = files.select("path", F.col(relative).alias("inner"))
    clash = spread.groupBy("inner").agg(F.countDistinct("path").alias("n")).where("n > 1").first()
    if clash is not None:
        raise ValueError(f"{clash['n']} files would be copied to {clash['inner']}")
    return spread.mapInPandas(copy, "path STRING, target STRING, length BIGINT, sha256 STRING")
