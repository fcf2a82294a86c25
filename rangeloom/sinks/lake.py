"""Parquet tables whose changes add files: rows are replaced and deleted by their place, and read without the deleted ones.

``<root>/versions/<n>`` is a version: the folders of data, of deleted places (file, row) and of indexes that it consists of. A version
is written aside and renamed to its number, which only one writer can: it is there whole or not at all, so a writer that dies leaves nothing
that others wait for. An append that finds its number taken goes on from the newer version; changes that depend on what they read are
refused then. An append with an id is done once, however often it is tried.

Tables with keys keep the rows of a hash bucket together, and a Bloom filter of each file's keys; an upsert looks for its keys in the files
that may have them, within the keys' bounds. Rows with ``_batch_id`` are indexed by batch, so a deletion by batch reads the files
it concerns. Small files are merged, and what no kept version needs is removed, by ``compact`` and ``remove_old``.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rangeloom.functions.ranges import ids_of
from rangeloom.operators.merge import check_schema, last_per_key

MODES = ("append", "overwrite", "upsert", "merge")
EMPTY = {"version": -1, "time": 0.0, "data": [], "gone": [], "deleted": [], "keys": [], "batches": [], "ids": {}, "schema": None}
#: Bits of a Bloom filter for each key of a file, and the hashes of a key.
BITS, HASHES = 10, 3
BUCKET, COMMIT = "_bucket", "__commit"


def _place(root: str, folder: str) -> str:
    return f"{root}/data/{COMMIT}={folder}"


def _file() -> Column:
    """A row's file below the table's folder; folders of a table have names of their own."""
    return F.regexp_extract(F.col("_metadata.file_path"), "(d-[0-9a-f]{32}/.*)$", 1)


class LakeTable:
    """A versioned Parquet table. ``mode``s follow MODES; upsert and merge need keys, and an order for the last row.

    keys and buckets: the table is upserted by these columns, in so many hash buckets.
    """

    def __init__(self, spark: SparkSession, root: str, partition_by: list[str] | None = None, max_rows_per_file: int = 0, evolve: bool = True, keys: list[str] | None = None, buckets: int = 0):
        self.spark, self.root, self.evolve = spark, root.rstrip("/"), evolve
        self.partition_by, self.max_rows, self.keys, self.buckets = partition_by or [], max_rows_per_file, keys or [], buckets if keys else 0

    # versions

    def _fs(self, name: str = ""):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def versions(self) -> list[int]:
        fs, p = self._fs("versions")
        return sorted(int(x.getPath().getName()) for x in fs.listStatus(p) if x.getPath().getName().isdigit()) if fs.exists(p) else []

    def state(self, version: int | None = None) -> dict:
        """A version, the last one if none is named."""
        found = self.versions()
        if not found:
            return dict(EMPTY)
        if version is not None and version not in found:
            raise ValueError(f"version {version} is not kept")
        return json.loads(self.spark.read.text(f"{self.root}/versions/{found[-1] if version is None else version}", wholetext=True).first()[0])

    def _publish(self, state: dict) -> bool:
        """Whether the state became its version: not if another writer was first."""
        jvm, conf, gateway = self.spark._jvm, self.spark._jsc.hadoopConfiguration(), self.spark.sparkContext._gateway
        fs, draft = self._fs(f"drafts/{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        _, target = self._fs(f"versions/{state['version']}")
        fs.mkdirs(target.getParent())
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        how = gateway.new_array(kind, 1)
        how[0] = kind.NONE
        source, target = fs.makeQualified(draft), fs.makeQualified(target)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(source, target, how)
        except Exception as e:
            fs.delete(draft, False)
            if "FileAlreadyExists" in str(e):
                return False
            raise
        return True

    def _commit(self, before: dict, change: Callable[[dict], dict], again: bool = False) -> dict:
        """Publishes the changed state as the next version; ``again``: on top of newer versions, too."""
        while True:
            state = {**before, **change(before), "version": before["version"] + 1, "time": time.time()}
            if self._publish(state):
                return state
            if not again:
                raise RuntimeError(f"another writer has replaced version {before['version']} of {self.root}; read it again")
            before = self.state()

    # data

    def exists(self) -> bool:
        return bool(self.versions())

    def _folder(self, kind: str) -> str:
        return f"{kind}-{uuid.uuid4().hex}"

    def _side(self, folders: list[str]) -> DataFrame:
        """The rows of folders beside the data."""
        return self.spark.read.parquet(*[f"{self.root}/{f}" for f in folders])

    def _data(self, folders: list[str], schema: str) -> DataFrame:
        """The rows of data folders, with COMMIT. Rows in partitions leave no file if there are none: then the schema tells the columns."""
        try:
            return self.spark.read.option("mergeSchema", True).option("basePath", f"{self.root}/data").parquet(*[_place(self.root, f) for f in folders])
        except AnalysisException as e:
            if "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            return self.spark.createDataFrame([], T.StructType.fromJson(json.loads(schema)))

    def _scan(self, state: dict, files: list[str] | None = None, placed: bool = False) -> DataFrame:
        """The rows of a version; of some files only if they are named. placed: with the columns ``__file`` and ``__row``."""
        if not state["data"]:
            raise FileNotFoundError(f"no table at {self.root}")
        rows = self._data(state["data"], state["schema"])
        if COMMIT not in rows.columns:  # no files
            return rows.withColumns({"__file": F.lit(""), "__row": F.lit(0).cast("long")}) if placed else rows
        columns = [F.col(f"`{c}`") for c in rows.columns if c not in (BUCKET, COMMIT)]
        if files is not None:
            rows = rows.where(_file().isin(files))
        elif state["gone"]:
            rows = rows.where(~_file().isin(state["gone"]))
        if not (placed or state["deleted"]):
            return rows.select(*columns)
        rows = rows.select(*columns, _file().alias("__file"), F.col("_metadata.row_index").alias("__row"))
        if state["deleted"]:
            rows = rows.join(self._side(state["deleted"]).select(F.col("file").alias("__file"), F.col("row").alias("__row")), ["__file", "__row"], "left_anti")
        return rows if placed else rows.drop("__file", "__row")

    def read(self, version: int | None = None) -> DataFrame:
        return self._scan(self.state(version))

    def _put(self, df: DataFrame, dealt: bool = False) -> dict:
        """Writes rows (dealt to tasks, or yet to be) as a new folder with its indexes; what a state gets from it."""
        folder, parts, schema = self._folder("d"), list(self.partition_by), df.schema.json()
        if self.buckets:
            df = df.withColumn(BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))
            parts.append(BUCKET)
            df = df if dealt else df.repartition(*parts)
        writer = df.write.partitionBy(*parts) if parts else df.write
        if self.max_rows:
            writer = writer.option("maxRecordsPerFile", self.max_rows)
        writer.parquet(_place(self.root, folder))
        out = {"data": [folder], "keys": [], "batches": [], "schema": schema}
        rows = self._data([folder], schema)
        if rows.isEmpty():
            return out
        if self.buckets:
            out["keys"] = [self._folder("k")]
            _filters(rows, self.keys).write.parquet(f"{self.root}/{out['keys'][0]}")
        if "_batch_id" in df.columns:
            out["batches"] = [self._folder("b")]
            lists = rows.select("_batch_id", _file().alias("file")).distinct()
            lists.select(F.explode(ids_of(F.col("_batch_id"))).alias("batch_id"), "file").distinct().repartitionByRange("batch_id").sortWithinPartitions("batch_id").write.parquet(f"{self.root}/{out['batches'][0]}")
        return out

    def _with(self, state: dict, put: dict, **more) -> dict:
        return {k: v if k == "schema" else [*state[k], *v] for k, v in put.items()} | more

    def write(self, df: DataFrame, mode: str = "append", keys: list[str] | None = None, order: list[str] | None = None, retry_id: str | None = None) -> None:
        """retry_id: an append under an id that a version already has does nothing."""
        if mode not in MODES:
            raise ValueError(f"mode {mode} is not one of {', '.join(MODES)}")
        if missing := [c for c in self.partition_by if c not in df.columns]:
            raise ValueError(f"partition columns {', '.join(missing)} are not in the rows")
        before = self.state()
        if mode == "overwrite":
            put = self._put(df)
            self._commit(before, lambda s: {**{k: [] for k in ("gone", "deleted")}, **put})
            return
        if before["data"] and not self.evolve:
            check_schema(self._scan(before), df)
        if mode == "append":
            if retry_id is not None and retry_id in before["ids"]:
                return
            put = self._put(df)

            def add(s: dict) -> dict:
                if retry_id is not None and retry_id in s["ids"]:
                    return {}  # another try of it was published meanwhile
                return self._with(s, put, ids={**s["ids"], **({retry_id: time.time()} if retry_id else {})})

            self._commit(before, add, again=True)
            return
        keys = keys or self.keys
        if not keys:
            raise ValueError("an upsert needs keys")
        # without an order the greatest row of a key counts, so equal input gives equal tables
        put = self._put(last_per_key(df, keys, order or [c for c in df.columns if c not in keys] or keys))
        deleted = self._places(before, self._holding(before, self._data(put["data"], put["schema"]).select(*keys), keys)) if before["data"] else []
        self._commit(before, lambda s: self._with(s, put, deleted=[*s["deleted"], *deleted]))

    def _holding(self, state: dict, new: DataFrame, keys: list[str]) -> DataFrame:
        """The places of rows whose key is among the new ones: files that may hold one, rows within the keys' bounds."""
        files = None
        if self.buckets and keys == self.keys and state["keys"]:
            files = self.candidates(new, state)
        rows = self._scan(state, files, placed=True)
        low, high = new.agg(F.min(keys[0]), F.max(keys[0])).first()
        if low is not None:  # a literal range that reaches the footers
            rows = rows.where(F.col(keys[0]).between(F.lit(low), F.lit(high)))
        return rows.join(new.distinct(), keys, "left_semi")

    def candidates(self, new: DataFrame, state: dict | None = None) -> list[str]:
        """The files whose filter does not rule out all of the new keys."""
        state = state or self.state()
        index = self._side(state["keys"])
        sizes = [r[0] for r in index.select("bits").distinct().collect()]  # powers of two
        h = new.select(*self.keys).distinct().select(F.xxhash64(*self.keys).alias("h"), F.xxhash64(F.lit(7), *self.keys).alias("g"), F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias("bucket"))
        asked = h.select("h", "g", "bucket", F.explode(F.array(*[F.lit(x) for x in sizes])).alias("bits")).select("h", "bucket", "bits", F.posexplode(_positions(F.col("h"), F.col("g"), F.col("bits"))).alias("i", "at"))
        asked = asked.select("h", "bucket", "bits", "i", F.shiftrightunsigned("at", 6).alias("word"), _bit(F.col("at")).alias("bit"))
        met = asked.join(index, ["bucket", "bits", "word"]).where(F.col("mask").bitwiseAND(F.col("bit")) != 0)
        held = met.groupBy("file", "h").agg(F.count_distinct("i").alias("n")).where(F.col("n") == HASHES)
        return sorted({r[0] for r in held.select("file").distinct().collect()} - set(state["gone"]))  # at most the table's files

    def _places(self, state: dict, rows: DataFrame) -> list[str]:
        """Writes the places of placed rows; nothing if there are none."""
        folder = self._folder("x")
        rows.select(F.col("__file").alias("file"), F.col("__row").alias("row")).write.parquet(f"{self.root}/{folder}")
        return [folder] if not self._side([folder]).isEmpty() else []

    def delete_batches(self, affected: DataFrame) -> list[str]:
        """Deletes the rows of the affected batches (batch_id); only files that the index names are read. Returns them."""
        before = self.state()
        if not before["batches"]:
            return []
        named = self._side(before["batches"]).join(affected.select("batch_id").distinct(), "batch_id", "left_semi").select("file").distinct().collect()
        files = sorted({r[0] for r in named} - set(before["gone"]))
        if files:
            rows = self._scan(before, files, placed=True)
            lists = rows.select("_batch_id").distinct().select("_batch_id", F.explode(ids_of(F.col("_batch_id"))).alias("batch_id"))
            hit = lists.join(affected.select("batch_id"), "batch_id", "left_semi").select("_batch_id").distinct()
            deleted = self._places(before, rows.join(hit, "_batch_id", "left_semi"))
            if deleted:
                self._commit(before, lambda s: {"deleted": [*s["deleted"], *deleted]})
        return files

    # maintenance

    def _listed(self, state: dict) -> list[tuple[str, int]]:
        """The live files of a version and their sizes, from the file system."""
        out, gone = [], set(state["gone"])
        for folder in state["data"]:
            fs, p = self._fs(f"data/{COMMIT}={folder}")
            at = fs.listFiles(p, True)
            while at.hasNext():
                f = at.next()
                name = f.getPath().toUri().toString()
                name = name[name.rindex(folder) :]
                if name.endswith(".parquet") and name not in gone:
                    out.append((name, f.getLen()))
        return out

    def compact(self, target_bytes: int = 512 << 20, small_bytes: int | None = None, deleted_share: float = 0.3) -> list[str]:
        """Merges the files below small_bytes (half the target) of a partition and bucket into files of about target_bytes, and rewrites files that lost
        ``deleted_share`` of their rows. Larger files stay as they are. Returns the files that went."""
        before = self.state()
        sizes, small = dict(self._listed(before)), target_bytes // 2 if small_bytes is None else small_bytes
        worn: set[str] = set()
        if before["deleted"]:
            lost = self._side(before["deleted"]).distinct().groupBy("file").agg(F.count("*").alias("lost"))
            names = [r[0] for r in lost.select("file").collect()]  # at most the table's files
            whole = self._scan({**before, "deleted": []}, names, placed=True).groupBy(F.col("__file").alias("file")).agg(F.count("*").alias("n"))
            worn = {r[0] for r in whole.join(lost, "file").where(F.col("lost") >= F.col("n") * deleted_share).select("file").collect()} & set(sizes)
        bins = merged_bins({f: n for f, n in sizes.items() if n < small or f in worn}, target_bytes, worn)
        if not bins:
            return []
        where = self.spark.createDataFrame([(f, i) for i, files in enumerate(bins) for f in files], "__file string, __bin int")
        gone = [f for files in bins for f in files]
        rows = self._scan(before, gone, placed=True).join(F.broadcast(where), "__file")  # a row for each merged file
        put = self._put(rows.repartitionByRange(len(bins), "__bin").drop("__file", "__row", "__bin"), dealt=True)
        left = before["deleted"]
        if left:
            rest = self._side(left).where(~F.col("file").isin(gone)).distinct()
            folder = self._folder("x")
            rest.write.parquet(f"{self.root}/{folder}")
            left = [] if self._side([folder]).isEmpty() else [folder]
        kept = self._without(before, gone, sizes)
        self._commit(before, lambda s: self._with({**s, **kept}, put, gone=kept["gone"], deleted=left))
        return gone

    def _without(self, state: dict, gone: list[str], sizes: dict) -> dict:
        """data and gone of a state without some files: folders that are left empty go."""
        now = {*state["gone"], *gone}
        live = {f.partition("/")[0] for f in sizes if f not in now}
        data = [d for d in state["data"] if d in live]
        return {"data": data, "gone": sorted(f for f in now if f.partition("/")[0] in live)}

    def remove_old(self, hours: float = 168) -> int:
        """Deletes versions that were replaced more than ``hours`` ago, and the folders and merged files that no kept version reads. Folders
        younger than that stay, as they may belong to a write that is under way. Returns how many folders and files went."""
        limit, found, went = time.time() - hours * 3600, self.versions(), 0
        states = {v: self.state(v) for v in found}
        drop = [v for v, after in zip(found, found[1:], strict=False) if states[after]["time"] <= limit]
        kept = [s for v, s in states.items() if v not in drop]
        used = {f for s in kept for k in ("data", "deleted", "keys", "batches") for f in s[k]}
        unread = {f for s in kept for f in s["gone"]}
        unread = {f for f in unread if all(f in s["gone"] or f.partition("/")[0] not in s["data"] for s in kept)}
        fs, root = self._fs()
        _, data = self._fs("data")
        for x in [x for p in (root, data) if fs.exists(p) for x in fs.listStatus(p)]:
            name = x.getPath().getName().removeprefix(f"{COMMIT}=")
            if name[:2] in ("d-", "x-", "k-", "b-") and name not in used and x.getModificationTime() / 1000 <= limit:
                went += fs.delete(x.getPath(), True)
        for f in unread:
            fs, p = self._fs(f"data/{COMMIT}={f}")
            went += fs.delete(p, False)
        for v in drop:
            fs, p = self._fs(f"versions/{v}")
            fs.delete(p, False)
        return went


def _positions(h: Column, g: Column, bits: Column) -> Column:
    """The bits of a key in a filter of so many (a power of two)."""
    mask = bits - 1
    return F.array(h.bitwiseAND(mask), g.bitwiseAND(mask), F.shiftrightunsigned(h.bitwiseXOR(g), 23).bitwiseAND(mask))


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(63).cast("int"))


def _filters(rows: DataFrame, keys: list[str]) -> DataFrame:
    """file, bucket, bits, word and mask: the words of a Bloom filter of each file, its size in powers of two by the file's rows."""
    own = rows.select(_file().alias("file"), F.col(BUCKET).alias("bucket"), F.xxhash64(*keys).alias("h"), F.xxhash64(F.lit(7), *keys).alias("g"))
    power = F.call_function("shiftleft", F.lit(1).cast("long"), F.ceil(F.log2(F.greatest(F.lit(64), F.count("*") * BITS))).cast("int"))
    sizes = own.groupBy("file").agg(power.alias("bits"))
    bits = own.join(sizes, "file").select("file", "bucket", "bits", F.explode(_positions(F.col("h"), F.col("g"), F.col("bits"))).alias("at"))
    return bits.groupBy("file", "bucket", "bits", F.shiftrightunsigned("at", 6).alias("word")).agg(F.bit_or(_bit(F.col("at"))).alias("mask"))


def merged_bins(sizes: dict[str, int], target: int, worn: set[str] = frozenset()) -> list[list[str]]:
    """Files of one folder of partitions (below the folder of their write) in bins of at most ``target`` bytes, first fit by falling size.
    A file alone stays where it is, unless it is worn."""
    groups: dict[str, list[str]] = {}
    for f in sizes:
        groups.setdefault("/".join(f.split("/")[1:-1]), []).append(f)
    out = []
    for files in groups.values():
        bins: list[tuple[int, list[str]]] = []
        for f in sorted(files, key=lambda f: (-sizes[f], f)):
            for i, (n, held) in enumerate(bins):
                if n + sizes[f] <= target:
                    bins[i] = (n + sizes[f], [*held, f])
                    break
            else:
                bins.append((sizes[f], [f]))
        out += [held for _, held in bins if len(held) > 1 or held[0] in worn]
    return out


def load(df: DataFrame, sink, mode: str = "append", table: str = "", **how) -> DataFrame:
    """Writes df in one job and returns its audit row: table, rows, seconds, rows_per_second, columns, success, error."""
    from pyspark.sql import Observation

    spark, seen, began, error = df.sparkSession, Observation(), time.time(), None
    try:
        sink.write(df.observe(seen, F.count(F.lit(1)).alias("rows")), mode, **how)
        rows = seen.get["rows"]
    except Exception as e:  # the audit row tells it
        rows, error = 0, str(e)[:1000]
    took = time.time() - began
    return spark.createDataFrame([(table, rows, took, rows / took if took else None, len(df.columns), error is None, error)], "table string, rows long, seconds double, rows_per_second double, columns int, success boolean, error string")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_indexer(df: DataFrame, path: str, date: str, ident: str, value: str) -> None:
    from rangeloom.functions.encoding import indexer_rows

    indexer_rows(df, date, ident, value).write.mode("overwrite").parquet(path)
