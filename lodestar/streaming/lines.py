"""A line source with offsets (S10): text files that grow, read as an unbounded stream.

The reference reads lines from a socket, which keeps nothing: a restarted job
has lost what came before.  Here producers append lines to files of a folder,
and a Python streaming data source hands every whole line on exactly once.  An
offset is the number of bytes taken of each file, so Spark's checkpoint can
replay any batch and a restarted query goes on where the last commit ended.
No port is opened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SPLIT_BYTES = 64 << 20  # a file's new bytes are read by tasks of about this size


def line_source(split_bytes: int = SPLIT_BYTES) -> type:
    """The data source class ``lines`` (made here, so that it is shipped to executors by value).

    Option ``path``: a folder, as a URI that pyarrow opens.  Rows: file, at
    (byte offset of the line), value.  Lines end with a line feed; what follows
    the last line feed waits until its line is whole.  Files whose names begin
    with ``.`` or ``_`` are not read.  An empty or missing folder has no lines."""
    from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

    class Range(InputPartition):
        def __init__(self, file: str, begin: int, end: int, last: int):
            self.file, self.begin, self.end, self.last = file, begin, end, last

    def opened(uri: str):
        import re

        from pyarrow import fs

        uri = re.sub(r"^file:/+", "file:///", uri)
        return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")

    class Reader(DataSourceStreamReader):
        def __init__(self, path: str):
            self.path = path

        def initialOffset(self) -> dict:
            return {}

        def latestOffset(self) -> dict:
            from pyarrow import fs

            system, root = opened(self.path)
            found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
            sizes = {f.base_name: f.size for f in found if f.type == fs.FileType.File and f.base_name[0] not in "._"}
            return {name: end for name, size in sorted(sizes.items()) if (end := self._whole(system, f"{root}/{name}", size))}

        @staticmethod
        def _whole(system, file: str, size: int) -> int:
            """Bytes up to and including the last line feed."""
            with system.open_input_file(file) as f:
                while size:
                    begin = max(0, size - (1 << 16))
                    at = f.read_at(size - begin, begin).rfind(b"\n")
                    if at >= 0:
                        return begin + at + 1
                    size = begin
            return 0

        def partitions(self, start: dict, end: dict) -> list:
            parts = []
            for file, last in end.items():
                begin = start.get(file, 0)
                while begin < last:
                    stop = min(last, begin + split_bytes)
                    parts.append(Range(file, begin, stop, last))
                    begin = stop
            return parts

        def read(self, part: Range):
            """The lines that begin in the range: a line belongs to the range of its first byte."""
            import io

            system, root = opened(self.path)
            with io.BufferedReader(system.open_input_file(f"{root}/{part.file}"), 1 << 20) as f:
                at = part.begin
                if at:
                    f.seek(at - 1)  # the line that holds the byte before begins in the range before
                    at += len(f.readline()) - 1
                f.seek(at)
                while at < part.end and at < part.last:
                    line = f.readline()
                    yield part.file, at, line[:-1].decode("utf-8", "replace")
                    at += len(line)

        def commit(self, end: dict) -> None:
            pass

    class Lines(DataSource):
        @classmethod
        def name(cls) -> str:
            return "lines"

        def schema(self) -> str:
            return "file string, at long, value string"

        def streamReader(self, schema) -> Reader:
            return Reader(self.options["path"])

    return Lines


def line_stream(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Lines appended to the files of a folder as a stream: file, at, value."""
    spark.dataSource.register(line_source(split_bytes))
    return spark.readStream.format("lines").option("path", path).load()
