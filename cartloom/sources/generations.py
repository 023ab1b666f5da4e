"""Numbered folders that become visible by a commit marker.

A writer fills ``gen=N`` below a root and then commits N; readers use the newest committed
number. A writer that dies before the commit leaves a folder nobody reads, and the next one
overwrites it. One writer per root is assumed.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_COMMITS = "_commits"


class Generations:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def _fs(self, path: str):
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm_path

    def children(self, path: str) -> list[str]:
        fs, folder = self._fs(path)
        if not fs.exists(folder):
            return []
        return [entry.getPath().getName() for entry in fs.listStatus(folder)]

    def put(self, path: str, text: str) -> None:
        """Replace a small file."""
        fs, target = self._fs(path)
        stream = fs.create(target, True)
        stream.write(bytearray(text.encode()))
        stream.close()

    def last(self) -> tuple[int, int] | None:
        """``(generation, mark)`` of the newest commit."""
        names = [n for n in self.children(f"{self.root}/{_COMMITS}") if n[0].isdigit()]
        return max((tuple(map(int, n.split("-"))) for n in names), default=None)

    def path(self, generation: int) -> str:
        return f"{self.root}/gen={generation}"

    def commit(self, generation: int, mark: int) -> None:
        """Publish a generation; ``mark`` is a number its writer wants back from ``last``."""
        fs, marker = self._fs(f"{self.root}/{_COMMITS}/{generation:06d}-{mark}")
        fs.create(marker, False).close()

    def drop(self, path: str) -> None:
        fs, folder = self._fs(path)
        if fs.exists(folder):
            fs.delete(folder, True)

    def drop_before(self, generation: int, within: str = "") -> None:
        """Delete older generations, or only their part ``within``."""
        for name in self.children(self.root):
            if name.startswith("gen=") and int(name[4:]) < generation:
                self.drop(f"{self.root}/{name}/{within}".rstrip("/"))
