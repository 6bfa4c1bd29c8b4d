"""Pages of a Parquet file, so that the paged source can be tried without a service."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class ParquetPages:
    """The same interface over a Parquet file, for trials without a service."""

    def __init__(self, path: str, columns: list[str] | None = None,
                 names: list[str] | None = None):
        self.path, self.columns, self.names = path, columns, names
        self._at, self._table = None, None

    def _open(self) -> pq.ParquetFile:
        if "://" not in self.path:
            return pq.ParquetFile(self.path)
        system, path = FileSystem.from_uri(self.path)
        return pq.ParquetFile(path, filesystem=system)

    def total(self) -> int:
        return self._open().metadata.num_rows

    def page(self, start: int, size: int) -> Iterator[pa.RecordBatch]:
        file = self._open()
        first = 0
        for group in range(file.num_row_groups):
            rows = file.metadata.row_group(group).num_rows
            low, high = max(start, first), min(start + size, first + rows)
            if low < high:
                if self._at != group:
                    self._at, self._table = group, file.read_row_group(group, self.columns)
                    if self.names:
                        self._table = self._table.rename_columns(self.names)
                yield from self._table.slice(low - first, high - low).to_batches()
            first += rows

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_at": None, "_table": None}
