"""A stream over a table of blocks whose offsets are block positions.

``spark.readStream.format("blocks")`` reads a Parquet table that grows by its block column. A micro-batch is a range of blocks, cut into
slices that tasks read side by side, each a batch with ``_seq`` (its first block) and ``_metadata_json``. Where a new query begins, and how far a running
one may go, follow from block numbers alone: after the highest block of the ledger, ``blocksPerTrigger`` at once. Files may be merged or
split between two runs.

Options: path; block (column); network (name); schema (of the columns to read, as JSON); start (first block, 0); ledger (folder of a ContinuousTable's
ledger, to go on after what it has); blocksPerTrigger (all that is there); blocksPerTask (10000). The folder is read through Arrow's file systems.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType


def _dataset(uri: str):
    import pyarrow.dataset as ds
    from pyarrow import fs

    where, path = fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")
    return ds.dataset(path, filesystem=where, format="parquet", partitioning="hive")


def highest_block(uri: str, block: str) -> int | None:
    """The highest block of a table, from footers where they have it."""
    top = None
    for part in _dataset(uri).get_fragments():
        for group in part.row_groups:
            found = (group.statistics or {}).get(block, {}).get("max")
            if found is None:
                column = part.subset(row_group_ids=[group.id]).to_table(columns=[block]).column(0)
                found = max((x for x in column.to_pylist() if x is not None), default=None)
            if found is not None:
                top = found if top is None else max(top, found)
    return None if top is None else int(top)


def ledger_position(uri: str, network: str) -> int | None:
    """The block after the highest one that a ledger has of a network: positions grow, so the newest epoch that has any tells."""
    from pyarrow import fs

    where, path = fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")
    found = where.get_file_info(fs.FileSelector(path, allow_not_found=True))
    epochs = sorted((int(f.base_name.partition("=")[2]) for f in found if f.base_name.startswith("epoch=")), reverse=True)
    for epoch in epochs:
        rows = _dataset(f"{uri}/epoch={epoch}").to_table(columns=["_ranges"]).column(0).to_pylist()
        ends = [r["end"] for x in rows for r in x or () if r["network"] == network]
        if ends:
            return max(ends) + 1
    return None


@dataclass
class Slice(InputPartition):
    start: int
    end: int


class BlockReader(DataSourceStreamReader):
    """Offsets are ``{"block": n}``, the next block to read."""

    def __init__(self, options: dict, schema: StructType):
        self.path, self.block, self.network = options["path"], options["block"], options.get("network", "")
        self.ledger, self.start = options.get("ledger"), int(options.get("start", 0))
        self.limit, self.slice = int(options.get("blockspertrigger", 0)), int(options.get("blockspertask", 10_000))
        if self.slice <= 0 or self.limit < 0:
            raise ValueError("blocksPerTask must be positive and blocksPerTrigger must not be negative")
        self.schema, self.at = schema, None

    def _position(self) -> int:
        known = ledger_position(self.ledger, self.network) if self.ledger else None
        return max(self.start if known is None else known, self.start)

    def initialOffset(self) -> dict:  # noqa: N802
        return {"block": self._position()}

    def latestOffset(self) -> dict:  # noqa: N802
        """What may be read now: up to the highest block there is, so many blocks after what has been planned or, in a new process, after the ledger."""
        at = self._position() if self.at is None else self.at
        top = highest_block(self.path, self.block)
        end = at if top is None else max(at, top + 1)
        return {"block": min(end, at + self.limit) if self.limit else end}

    def partitions(self, start: dict, end: dict) -> Sequence[Slice]:
        self.at = end["block"]
        # slices begin at multiples of their size, so that a range that is planned again has the same ones
        cuts = [start["block"], *range((start["block"] // self.slice + 1) * self.slice, end["block"], self.slice), end["block"]]
        return [Slice(a, z) for a, z in zip(cuts, cuts[1:], strict=False) if a < z]

    def read(self, partition: Slice) -> Iterator:
        import pyarrow as pa
        import pyarrow.dataset as ds

        own = [f.name for f in self.schema.fields[:-3]]
        block = ds.field(self.block)
        form = to_arrow_schema(self.schema)
        meta = json.dumps({"ranges": [{"network": self.network, "numbers": {"start": partition.start, "end": partition.end - 1}}], "ranges_complete": True})
        for b in _dataset(self.path).to_batches(columns=own, filter=(block >= partition.start) & (block < partition.end)):
            if b.num_rows:
                n = b.num_rows
                yield pa.RecordBatch.from_arrays([*(c.cast(f.type) for c, f in zip(b.columns, form, strict=False)), pa.array([partition.start] * n, pa.int64()), pa.array([meta] * n), pa.array([False] * n)], schema=form)

    def commit(self, end: dict) -> None:
        self.at = end["block"] if self.at is None else max(self.at, end["block"])


class BlockSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "blocks"

    def schema(self) -> StructType:
        for need in ("path", "block", "schema"):
            if need not in self.options:
                raise ValueError(f"option {need} is needed")
        own = StructType.fromJson(json.loads(self.options["schema"]))
        return StructType([*own.fields, StructField("_seq", LongType()), StructField("_metadata_json", StringType()), StructField("_notice", BooleanType())])

    def streamReader(self, schema: StructType) -> BlockReader:  # noqa: N802
        return BlockReader(self.options, schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BlockSource)
