"""C11: execute a copy plan inside executor tasks.

The plan rows are partitioned by Spark; each task copies or moves its
objects with ``pyarrow.fs`` (local, HDFS or any filesystem pyarrow can
open) and returns one result row per plan row.  A failed task is retried
by Spark; copies overwrite and a move that is done counts as done, so a
retried task is idempotent.  Streaming
from the data API has no counterpart here and is reported, not executed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from objsync.functions import routing as R

RESULT_SCHEMA = "line_no long, id string, action string, copy_success boolean, message string"


def _copier(source_root: str, target_root: str, dry_run: bool):
    def run(batches):
        import pandas as pd
        import pyarrow.fs as pafs

        src_fs, src_base = pafs.FileSystem.from_uri(source_root)
        dst_fs, dst_base = pafs.FileSystem.from_uri(target_root)

        def size_of(fs, p):
            info = fs.get_file_info(p)
            return info.size if info.type == pafs.FileType.File else None

        for pdf in batches:
            ok, msg = [], []
            for row in pdf.itertuples(index=False):
                action = row.action
                dst = f"{dst_base}/{row.target_bucket}/{row.object_key}"
                try:
                    if action == "ALREADY_COPIED":
                        ok.append(True), msg.append("already copied")
                        continue
                    if action == "COPY":
                        src = f"{src_base}/{row.source_key}"
                        if not dry_run:
                            dst_fs.create_dir(dst.rsplit("/", 1)[0], recursive=True)
                            with src_fs.open_input_stream(src) as i, dst_fs.open_output_stream(dst) as o:
                                while True:
                                    chunk = i.read(8 << 20)
                                    if not chunk:
                                        break
                                    o.write(chunk)
                    elif action == "MOVE":
                        src = f"{dst_base}/{row.reversed_bucket}/{row.object_key}"
                        if not dry_run:
                            if size_of(dst_fs, src) is None and size_of(dst_fs, dst) == row.size:
                                ok.append(True), msg.append("already moved")  # by an attempt that was lost
                                continue
                            dst_fs.create_dir(dst.rsplit("/", 1)[0], recursive=True)
                            dst_fs.move(src, dst)
                    else:
                        ok.append(False)
                        msg.append("not executed: " + (row.reject_reason or action.lower()))
                        continue
                    if dry_run:
                        ok.append(True), msg.append(f"dry run: {action.lower()}")
                        continue
                    got = size_of(dst_fs, dst)
                    if got != row.size:
                        ok.append(False), msg.append(f"size mismatch after {action.lower()}: {got} != {row.size}")
                    else:
                        ok.append(True), msg.append(f"object {row.object_key} successfully copied")
                except OSError as e:  # missing source, permissions: a result row, not a task failure
                    ok.append(False), msg.append(f"{action.lower()} failed: {e}")
            yield pd.DataFrame({"line_no": pdf["line_no"], "id": pdf["id"], "action": pdf["action"],
                                "copy_success": ok, "message": msg})

    return run


def execute_copies(plan: DataFrame, source_root: str, target_root: str, dry_run: bool = True) -> DataFrame:
    """Run the ``COPY``/``MOVE`` rows of an AWS copy plan (C1) against file
    system roots: ``source_root/<source_key>`` and
    ``target_root/<bucket>/<object_key>``.  Returns ``RESULT_SCHEMA`` rows."""
    rows = plan.select("line_no", "id", "size", "action", "target_bucket", "object_key", "source_key",
                       R.aws_reversed_bucket(F.col("target_bucket")).alias("reversed_bucket"), "reject_reason")
    return rows.mapInPandas(_copier(source_root, target_root, dry_run), RESULT_SCHEMA)
