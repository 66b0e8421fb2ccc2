"""Files written by tasks: temporary names, a manifest, then renames.

A task writes under a name that no other attempt uses and returns one manifest row per file.  Spark's own commit
of the manifest table picks one attempt of each task; only those files are renamed.  A rename that finds its target
in place and its source gone was done by a lost attempt, so the step can be repeated.
"""

from __future__ import annotations

import uuid

from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from constella.llm.common import cut


def resolve(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith(("file:", "/")) else (pafs.LocalFileSystem(), uri)


class Draft:
    """A file being written under a temporary name below ``root``."""

    def __init__(self, root: str, name: str):
        self.name, self.temp = name, f"_tmp/{name}.{uuid.uuid4().hex}"
        fs, base = resolve(root)
        fs.create_dir(f"{base}/_tmp", recursive=True)
        self.out, self.size = fs.open_output_stream(f"{base}/{self.temp}", compression=None), 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def tell(self) -> int:
        return self.size

    def close(self) -> None:
        self.out.close()


def commit(drafts: DataFrame, root: str) -> DataFrame:
    """Settle the manifest ``drafts`` (columns name, temp, ...), rename its files; return the manifest with ``uri``."""
    settled = cut(drafts, f"{root}/_drafts")

    def rename(batches):
        fs, base = resolve(root)
        for rows in batches:
            for name, temp in zip(rows["name"], rows["temp"]):
                final = fs.get_file_info(f"{base}/{name}")
                source = fs.get_file_info(f"{base}/{temp}")
                if source.type == pafs.FileType.File:
                    fs.move(f"{base}/{temp}", f"{base}/{name}")
                elif final.type != pafs.FileType.File:
                    raise FileNotFoundError(f"{root}/{temp}")
            rows["uri"] = [f"{root}/{name}" for name in rows["name"]]
            yield rows

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in settled.schema.fields) + ", uri string"
    done = cut(settled.mapInPandas(rename, schema).orderBy("name"), f"{root}/_manifest")
    fs, base = resolve(root)
    if fs.get_file_info(f"{base}/_tmp").type == pafs.FileType.Directory:
        fs.delete_dir(f"{base}/_tmp")    # what lost or speculative attempts left
    return done


def spread(manifest: DataFrame) -> DataFrame:
    """One file a task, as far as there are tasks."""
    n = max(1, min(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4, manifest.count()))
    return manifest.repartition(n, F.xxhash64("name"))
