"""Objects as files: every object under its storage path below a root URI."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame


def export_objects(objects: DataFrame, root: str, overwrite: bool = False) -> DataFrame:
    """Write ``storage_path, data`` rows as files; returns ``storage_path, written, reason`` (run by an action).

    An object that cannot be written does not stop the others: it is a row with a ``persist: ...`` reason. A file that
    exists and is kept is neither written nor a failure.

    Each task writes its own rows through the file system of ``root`` (local,
    HDFS, S3 and others). A file appears under its name only when complete, so
    retried tasks do no harm. Without ``overwrite`` existing files are kept, as
    in the landing zone; with it they are replaced, as in the curated zone.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(root)
        made: set[str] = set()  # folders

        def put(path: pa.Scalar, data: pa.Scalar) -> bool:
            if not path.is_valid or not data.is_valid:
                raise ValueError("no path" if not path.is_valid else "no data")
            target = f"{base}/{path.as_py()}"
            if not overwrite and system.get_file_info(target).type != fs.FileType.NotFound:
                return False
            folder = target.rsplit("/", 1)[0]
            if folder not in made:
                system.create_dir(folder, recursive=True)
                made.add(folder)
            partial = f"{target}.{uuid.uuid4().hex}.part"
            with system.open_output_stream(partial) as out:
                out.write(data.as_buffer())
            system.move(partial, target)
            return True

        for batch in batches:
            written, reasons = [], []
            for path, data in zip(batch.column(0), batch.column(1)):
                try:
                    done, reason = put(path, data), None
                except (OSError, ValueError) as error:
                    done, reason = False, f"persist: {error or type(error).__name__}"
                written.append(done)
                reasons.append(reason)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(written, pa.bool_()), pa.array(reasons, pa.string())],
                names=["storage_path", "written", "reason"])

    return objects.select("storage_path", "data").mapInArrow(write, "storage_path string, written boolean, reason string")
