"""K5: a commit protocol for result tables.

A run writes its tables to a staging folder of its own, moves each to ``<base>/kind=<kind>/run_id=<run_id>`` and
last of all writes its manifest, ``<base>.commits/manifests/<run_id>~<kinds>.json`` (staging and manifests stand beside
the results, so ``base`` holds tables only). A reader
takes the newest manifest that names the kind it wants, so a run that dies half-way is never read, and neither
is one that is still writing. Run ids hold the time to the microsecond and four random signs: two runs of one second stand
side by side in order of time.
"""

from __future__ import annotations

import json
import os
import re
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from .. import spec as S
from ..session import delete_path, list_paths, make_folder, path_exists, rename_path, write_small_file

MANIFESTS = ".commits/manifests"
STAGING = ".commits/staging"


def new_run_id() -> str:
    """K5: ``YYYYmmdd_HHMMSS_<microseconds>_<4 hex signs>`` (UTC); ids sort by time."""
    return f"{datetime.now(timezone.utc).strftime(S.RUN_STAMP_FORMAT + '_%f')}_{os.urandom(2).hex()}"


def committed(spark: SparkSession, base: str) -> list[tuple[str, list[str]]] | None:
    """(run id, kinds) of every manifest, newest first; None where ``base`` has no manifests at all."""
    base = base.rstrip("/")
    if not path_exists(spark, f"{base}{MANIFESTS}"):
        return None
    names = (re.search(r"/([^/]+)~([^/~]+)\.json$", p) for p in list_paths(spark, f"{base}{MANIFESTS}/*.json"))
    return sorted(((m.group(1), m.group(2).split("+")) for m in names if m), reverse=True)


class Publication:
    """The tables of one run. As a context manager it commits at the end of the block, and after an
    error discards what it staged.

        with Publication(spark, base, run_id) as out:
            out.write(table, "top")
    """

    def __init__(self, spark: SparkSession, base: str, run_id: str | None = None):
        self.spark, self.base, self.run_id = spark, base.rstrip("/"), run_id or new_run_id()
        if re.search(r"[/~\s]", self.run_id):
            raise ValueError(f"a run id has no slash, tilde or space: {self.run_id!r}")
        self.staging = f"{self.base}{STAGING}/{self.run_id}-{os.urandom(4).hex()}"
        self.kinds: list[str] = []
        # Made first, so that nothing of this base is ever read without a manifest.
        make_folder(spark, f"{self.base}{MANIFESTS}")

    def path(self, kind: str) -> str:
        return f"{self.base}/kind={kind}/run_id={self.run_id}"

    def write(self, df: DataFrame, kind: str, fmt: str = "csv") -> str:
        """Stage one small table as a single file; the path it will have."""
        if kind in self.kinds or re.search(r"[/~+.]", kind):
            raise ValueError(f"kind {kind!r} is taken or has a sign that manifests use")
        w = df.coalesce(1).write
        if fmt == "csv":
            w = w.options(**S.CSV_TEXT, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        w.format(fmt).save(f"{self.staging}/kind={kind}")
        self.kinds.append(kind)
        return self.path(kind)

    def commit(self) -> str:
        """Move the staged tables into place and write the manifest."""
        if not self.kinds:
            raise ValueError("nothing was written")
        taken = {k for run, kinds in committed(self.spark, self.base) or [] if run == self.run_id for k in kinds}
        again = taken & set(self.kinds)
        if again:
            raise FileExistsError(f"run {self.run_id} has already published {', '.join(sorted(again))}")
        for kind in self.kinds:
            make_folder(self.spark, f"{self.base}/kind={kind}")
            delete_path(self.spark, self.path(kind))  # left by a run of this id that died before its manifest
            rename_path(self.spark, f"{self.staging}/kind={kind}", self.path(kind))
        text = json.dumps({"run_id": self.run_id, "tables": {k: f"kind={k}/run_id={self.run_id}" for k in self.kinds}})
        write_small_file(self.spark, f"{self.base}{MANIFESTS}/{self.run_id}~{'+'.join(self.kinds)}.json", text)
        delete_path(self.spark, self.staging)
        return self.run_id

    def __enter__(self) -> "Publication":
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None:
            self.commit()
        else:
            delete_path(self.spark, self.staging)


def discard_unfinished(spark: SparkSession, base: str) -> list[str]:
    """Delete what runs left that never committed (call it while none is writing); the folders deleted."""
    base = base.rstrip("/")
    named = {(kind, run) for run, kinds in committed(spark, base) or [] for kind in kinds}
    gone = []
    if committed(spark, base) is not None:
        for path in list_paths(spark, f"{base}/kind=*/run_id=*"):
            kind, run = re.search(r"kind=([^/]+)/run_id=([^/]+)$", path).groups()
            if (kind, run) not in named:
                gone.append(path)
    gone += list_paths(spark, f"{base}{STAGING}/*")
    for path in gone:
        delete_path(spark, path)
    return gone
