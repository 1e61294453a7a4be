"""Listing directory trees by tasks.

A frontier of directories is a table; tasks list each directory and the next frontier is what they found,
less what is ignored. The driver counts levels, it holds no names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cochange
from ..session import as_table, as_uri

#: Entries of one batch of a listing.
BATCH = 4_096
#: Directories of a level that one task lists, on average.
DIRECTORIES = 64

_ENTRY = "uri string, path string, is_dir boolean, size bigint, modified timestamp"


def _list(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Entries of each directory; links are files, so that no cycle is followed."""
    import os
    from urllib.parse import quote

    import pandas as pd
    from pyarrow import fs

    for batch in batches:
        for uri, path in zip(batch["uri"], batch["path"]):
            system, folder = fs.FileSystem.from_uri(uri)
            found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
            local = isinstance(system, fs.LocalFileSystem)
            for begin in range(0, len(found), BATCH):
                rows = []
                for info in found[begin:begin + BATCH]:
                    is_dir = info.type == fs.FileType.Directory and not (local and os.path.islink(info.path))
                    below = f"{path}/{info.base_name}" if path else info.base_name
                    rows.append((f"{uri.rstrip('/')}/{quote(info.base_name)}", below, is_dir, None if is_dir else info.size, info.mtime))
                out = pd.DataFrame(rows, columns=["uri", "path", "is_dir", "size", "modified"])
                out["size"] = out["size"].astype("Int64")
                out["modified"] = pd.to_datetime(out["modified"], utc=True)
                yield out


def tree(spark: SparkSession, folder: str, patterns: list[str] | None = None, **ignore) -> DataFrame:
    """(uri, path, is_dir, size, modified) of everything below a folder: hidden names and empty directories too.

    Ignored directories are pruned before anything below them is listed. A folder that does not exist is empty.
    """
    frontier = spark.createDataFrame([(as_uri(spark, folder), "")], "uri string, path string")
    levels: list[DataFrame] = []
    directories = 1
    while directories:
        found = frontier.repartition(-(-directories // DIRECTORIES), "uri").mapInPandas(_list, _ENTRY)
        if patterns is not None:
            found = cochange.drop_ignored(found, patterns, **ignore)
        levels.append(as_table(found))
        frontier = levels[-1].where("is_dir").select("uri", "path")
        directories = frontier.count()
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out
