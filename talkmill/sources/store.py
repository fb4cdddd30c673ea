"""A collection of records in buckets, of which a write renews those that it touches.

Records lie in buckets by a hash of their id up to its last hyphen, so that the chunks of an episode share one. A write puts the buckets that it changes beside the old ones, as Parquet, then a manifest that names a folder for each bucket, and last CURRENT, which names the manifest that counts. Readers see the old records or the new ones; a crash before CURRENT moves leaves the old ones. Folders that no kept manifest names go when a grace period is over, so that readers that began before can end. The file system is Hadoop's, so that any store Spark can write will do.
"""

from __future__ import annotations

import contextlib
import hashlib
import json
import threading
import time
import uuid
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import all_finite
from ..operators.reconcile import prune_set
from ..plans.planning import Refused, require_expected
from ..session import drop_written, written


class Files:
    """The few file operations that need a driver."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.jvm, self.root = spark, spark._jvm, root.rstrip("/")
        self.fs = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def read(self, name: str) -> str | None:
        if not self.fs.exists(self.path(name)):
            return None
        try:
            stream = self.fs.open(self.path(name))
        except Exception:
            if not self.fs.exists(self.path(name)):  # it went meanwhile
                return None
            raise
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Beside the old file first, then in its place."""
        part = f"{name}.{uuid.uuid4().hex}"
        stream = self.fs.create(self.path(part), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        options = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        over = self.spark.sparkContext._gateway.new_array(options, 1)
        over[0] = options.OVERWRITE
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path(name).toUri(), self.spark._jsc.hadoopConfiguration()).rename(self.path(part), self.path(name), over)

    def claim(self, name: str, text: str) -> bool:
        """Writes a file unless there is one; of several that try, one does."""
        try:
            stream = self.fs.create(self.path(name), False)
        except Exception as e:
            if "AlreadyExists" in str(e) or self.fs.exists(self.path(name)):
                return False
            raise
        stream.write(bytearray(text.encode()))
        stream.close()
        return True

    def settle(self, name: str, text: str) -> bool:
        """Writes a whole file unless there is one, so that none is ever seen in part; of several that try, one does."""
        part = f"{name}.{uuid.uuid4().hex}"
        stream = self.fs.create(self.path(part), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        options = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        kept = self.spark.sparkContext._gateway.new_array(options, 1)
        kept[0] = options.NONE
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path(name).toUri(), self.spark._jsc.hadoopConfiguration()).rename(self.path(part), self.path(name), kept)
        except Exception as e:
            self.remove(part)
            if "AlreadyExists" in str(e) or self.fs.exists(self.path(name)):
                return False
            raise
        return True

    def names(self) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(""))) if self.fs.exists(self.path("")) else []

    def move(self, a: str, b: str) -> None:
        if not self.fs.rename(self.path(a), self.path(b)):
            raise OSError(f"can't move {a} to {b}")

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


#: Threads of one driver look at locks one at a time, since local file systems don't keep two from making one file.
_LOCKS = threading.Lock()


class Overtaken(Refused):
    """Another write has come in between; nothing was changed."""


class Collection:
    """Records by id. One writer at a time: another one that tries meanwhile waits for up to wait_s seconds and is refused then.

    The lock, which a writer renews, saves work; that no write is lost doesn't rest on it. Manifests are numbered, and each number is taken once: a writer whose manifest would follow one that another has followed meanwhile is refused, with nothing changed. A merge that is overtaken so starts again from what the other has written, for as long as it may wait.

    buckets: how many; a collection that is there keeps its number until it is replaced. A write costs the buckets that it touches; Spark splits large ones into several files.
    """

    #: Seconds after which a writer's lock counts as left behind; it is renewed four times as often.
    LOCK_S = 600

    def __init__(self, spark: SparkSession, root: str, name: str, allowed: tuple[str, ...] | None = None, buckets: int = 64, wait_s: float = 0):
        if allowed is not None and name not in allowed:
            raise ValueError(f"writes go to {', '.join(allowed)}, not {name}")
        self.spark, self.name, self.at, self.buckets = spark, name, f"{root.rstrip('/')}/{name}", buckets
        self.files, self.wait_s = Files(spark, self.at), wait_s

    def _manifest(self) -> dict | None:
        """The manifest that counts: that which CURRENT names, or one that has followed it where a writer broke off before it moved CURRENT."""
        name, found = self.files.read("CURRENT") or self.files.read(f"commits/{1:012d}"), None
        while name:
            found = json.loads(self.files.read(f"manifests/{name}") or "{}")
            name = self.files.read(f"commits/{found.get('version', 0) + 1:012d}")
        return found

    def exists(self) -> bool:
        return self._manifest() is not None

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The current records, or those of some buckets; a collection that isn't there raises."""
        return self._read(self._manifest(), buckets)

    def _read(self, manifest: dict | None, buckets: list[int] | None) -> DataFrame:
        if manifest is None:
            raise LookupError(f"no collection {self.name}")
        schema = T.StructType.fromJson(manifest["schema"])
        paths = [f"{self.at}/{at}/bucket_={b}" for b, at in manifest["buckets"].items() if buckets is None or int(b) in buckets]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def lookup(self, ids: list[str]) -> DataFrame:
        """The records of a few ids: of the buckets that they fall in, the row groups whose filters and bounds don't rule them out."""
        manifest = self._manifest()
        if manifest is None:
            raise LookupError(f"no collection {self.name}")
        wanted = self.spark.createDataFrame([(i,) for i in ids], "id string").select(_bucket("id", manifest["of"]).alias("b")).distinct()
        return self._read(manifest, [r["b"] for r in wanted.collect()]).where(F.col("id").isin(list(ids)))

    def metadata(self) -> dict:
        return (self._manifest() or {}).get("metadata", {})

    def bucket(self, id_col: str = "id") -> Column:
        """The bucket that a record lies in."""
        return _bucket(id_col, (self._manifest() or {}).get("of", self.buckets))

    def replace(self, records: DataFrame, metadata: dict | None = None, **keep) -> None:
        """All records anew, in as many buckets as this Collection says."""
        with self._writer() as base:
            self._put(records, base, None, metadata, **keep)

    def merge(self, new: DataFrame | None = None, drop: DataFrame | None = None, **keep) -> int:
        """Merges records in (merged()), and takes those of the ids in drop out, but for the new ones. Only buckets with such ids are read and written; their number is returned."""
        until = time.time() + self.wait_s
        while True:
            try:
                return self._merge(new, drop, **keep)
            except Overtaken:  # some file systems let two claim one lock
                if time.time() >= until:
                    raise

    def _merge(self, new: DataFrame | None, drop: DataFrame | None, **keep) -> int:
        with self._writer() as base:
            if base is None:
                self._put(new, None, None, None, **keep)
                return self.buckets
            ids = [df.select("id") for df in (new, drop) if df is not None]
            touched = sorted(r[0] for r in reduce(DataFrame.unionByName, ids).select(_bucket("id", base["of"]).alias("b")).distinct().collect())  # as many as there are buckets, at most
            if touched:
                rows = self._read(base, touched)
                if drop is not None:
                    rows = rows.join(drop.select("id"), "id", "left_anti")
                self._put(rows if new is None else merged(rows, new), base, touched, None, **keep)
            return len(touched)

    @contextlib.contextmanager
    def _writer(self) -> Iterator[dict | None]:
        """Holds the lock; gives the manifest that a write starts from."""
        mine, until, over = uuid.uuid4().hex, time.time() + self.wait_s, threading.Event()
        stamp = lambda: f"{mine} {time.time():.0f}"

        def claimed() -> bool:
            with _LOCKS:
                if self.files.claim("LOCK", stamp()):
                    return True
                held = (self.files.read("LOCK") or "").split()
                if len(held) == 2 and time.time() - float(held[1]) >= self.LOCK_S:
                    self.files.remove("LOCK")
                    return self.files.claim("LOCK", stamp())
                return False

        while not claimed():
            if time.time() >= until:
                raise Refused(f"{self.name} is being written")
            time.sleep(min(1.0, self.wait_s / 10))

        def renew() -> None:
            while not over.wait(self.LOCK_S / 4):
                with _LOCKS:
                    self.files.write("LOCK", stamp())

        keeper = threading.Thread(target=renew, daemon=True)
        keeper.start()
        try:
            yield self._manifest()
        finally:
            over.set()
            keeper.join()
            with _LOCKS:
                if (self.files.read("LOCK") or "").startswith(mine):
                    self.files.remove("LOCK")

    def _put(self, records: DataFrame, base: dict | None, touched: list[int] | None, metadata: dict | None, keep: int = 2, grace_s: float = 24 * 3600) -> None:
        """Writes records, which are all of the buckets touched (all there are, if None), and makes them count after base, if nothing else has come after it."""
        old = base or {"buckets": {}, "metadata": {}}
        snapshot, of = f"v-{time.time_ns():020d}", self.buckets if touched is None else old["of"]
        laid = records.withColumn("bucket_", _bucket("id", of)).hint("rebalance", "bucket_").sortWithinPartitions("bucket_", "id")  # so that lookup() skips pages and row groups
        laid.write.option("parquet.bloom.filter.enabled#id", "true").partitionBy("bucket_").parquet(f"{self.at}/{snapshot}")
        there = {n.split("=")[1]: snapshot for n in Files(self.spark, f"{self.at}/{snapshot}").names() if n.startswith("bucket_=")}
        stay = {} if touched is None else {b: at for b, at in old["buckets"].items() if int(b) not in touched}
        version = old.get("version", 0) + 1
        manifest = {"version": version, "buckets": stay | there, "of": of, "schema": json.loads(records.schema.json()), "metadata": metadata if metadata is not None else old["metadata"]}
        self.files.write(f"manifests/{snapshot}", json.dumps(manifest))
        if not self.files.settle(f"commits/{version:012d}", snapshot):
            self.files.remove(f"manifests/{snapshot}")
            self.files.remove(snapshot)
            raise Overtaken(f"{self.name} was written meanwhile")
        self.files.write("CURRENT", snapshot)
        self._clean(keep, grace_s)

    def _clean(self, keep: int, grace_s: float) -> None:
        """Deletes manifests beyond the last `keep` that were replaced over grace_s seconds ago, and bucket folders that no manifest left names."""
        names = Files(self.spark, f"{self.at}/manifests").names()
        names = [n for n in names if n.startswith("v-") and n.count(".") == 0]
        ended = {n: int(after[2:]) / 1e9 for n, after in zip(names, names[1:])}
        gone = [n for n in names[: max(0, len(names) - keep)] if time.time() - ended[n] >= grace_s]
        if not gone:
            return
        named = {(at, b) for n in names if n not in gone for b, at in json.loads(self.files.read(f"manifests/{n}"))["buckets"].items()}
        for n in gone:
            lost = json.loads(self.files.read(f"manifests/{n}"))["buckets"].items()
            for b, at in lost:
                if (at, b) not in named:
                    self.files.remove(f"{at}/bucket_={b}")
            for at in {at for _, at in lost} - {at for at, _ in named}:
                self.files.remove(at)
            self.files.remove(f"manifests/{n}")
        first = min(json.loads(self.files.read(f"manifests/{n}")).get("version", 1) for n in names if n not in gone)
        for n in Files(self.spark, f"{self.at}/commits").names():
            if n.isdigit() and int(n) < first:
                self.files.remove(f"commits/{n}")

    def count(self) -> int:
        return self.read().count() if self.exists() else 0


def _bucket(id_col: str, of: int) -> Column:
    return F.pmod(F.xxhash64(F.regexp_replace(F.col(id_col).cast("string"), "-[^-]*$", "")), F.lit(of)).cast("int")


def merged(current: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """Upsert: a new record's values win, its missing ones leave what was there. A value can thus be added and changed, not removed."""
    b = new.select(F.col(key).alias("k_"), *(F.col(c).alias(f"{c}_n") for c in new.columns if c != key))
    j = current.join(b, current[key] == b["k_"], "full_outer")
    columns = [*current.columns, *(c for c in new.columns if c not in current.columns)]
    value = lambda c: F.coalesce(f"{c}_n", current[c]) if c in new.columns and c in current.columns else F.col(f"{c}_n") if c in new.columns else current[c]
    return j.select(*(F.coalesce("k_", current[key]).alias(c) if c == key else value(c).alias(c) for c in columns))


def updated(current: DataFrame, updates: DataFrame, key: str = "id") -> DataFrame:
    """Metadata of records that are there; ids that aren't are passed over."""
    return merged(current, updates.join(current.select(key), key, "left_semi"), key)


def upsert_then_prune(collection: Collection, chunks: DataFrame) -> dict:
    """Replaces episodes: chunks (id, show, episode_number, date, episode_guid ...) are merged in, and what their triple or guid matches beside them goes. Stale ids are looked for by key columns alone; one write, of the buckets with new or stale ids, holds both steps."""
    chunks = written(chunks, "chunks")  # read for ids, keys and records
    stale = written(prune_set(collection.read(), chunks).distinct() if collection.exists() else chunks.select("id").limit(0), "stale")
    out = {"written": chunks.count(), "pruned": stale.count()}
    if out["written"] or not collection.exists():
        collection.merge(chunks, stale)
    drop_written(chunks)
    drop_written(stale)
    return out


def apply_updates(collection: Collection, updates: DataFrame, expect: int) -> int:
    """Merges updates (id ...) of records that are there, if there are just as many as foretold."""
    n = updates.count()
    require_expected(n, expect)
    there = written(updates.join(collection.read().select("id"), "id", "left_semi"), "updates")
    collection.merge(there)
    drop_written(there)
    return n


def create_destination(src: Collection, dst: Collection) -> dict:
    """The metadata of dst: as it is, if dst is there; else dst is begun, empty, with the schema and metadata of src. A source without a distance space is refused."""
    if not dst.exists():
        distance_space({"collection_metadata": src.metadata()})
        dst.replace(src.read().limit(0), src.metadata())
    return dst.metadata()


def copy_collection(src: Collection, dst: Collection, *, allow_nonempty: bool = False) -> int:
    """All records, with the metadata; refuses a destination that holds some, and a source that changed meanwhile."""
    if dst.count() and not allow_nonempty:
        raise Refused(f"{dst.name} isn't empty")
    before = src.count()
    dst.replace(src.read(), src.metadata())
    if not src.count() == before == dst.count():
        raise Refused(f"{src.name} changed while it was copied")
    return before


SPACES = ("cosine", "l2", "ip")


def distance_space(manifest: dict) -> str:
    """The space that a manifest, its schema or its collection's metadata names; never a default."""
    space = manifest.get("space") or (manifest.get("schema") or {}).get("space") or (manifest.get("collection_metadata") or {}).get("space")
    if space not in SPACES:
        raise ValueError("no distance space is named")
    return space


def _digest(df: DataFrame) -> str:
    """A digest of all records, whatever their order: sums of two hashes and the count."""
    row = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(20,0)")).cast("string").alias("a"), F.sum(F.xxhash64(F.lit("second"), *df.columns).cast("decimal(20,0)")).cast("string").alias("b")).first()
    return hashlib.sha256(f"{row['n']}|{row['a']}|{row['b']}".encode()).hexdigest()


def export_collection(collection: Collection, out: str, vector: str = "embedding") -> dict:
    """Records and vectors as files with a manifest, in a folder that gets its name when all is verified. Refuses if ids repeat, vectors differ in size or the count moves."""
    spark, files = collection.spark, Files(collection.spark, out)
    df = collection.read()
    g = df.agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"), F.min(F.size(vector)).alias("lo"), F.max(F.size(vector)).alias("hi")).first()
    if g["n"] != g["ids"] or g["lo"] != g["hi"]:
        raise Refused("ids repeat, or vectors differ in size")
    manifest = {"format_version": 1, "created_at": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()), "collection": collection.name, "collection_metadata": collection.metadata(), "space": collection.metadata().get("space"), "count": g["n"], "dimension": g["hi"]}
    distance_space(manifest)
    df.select("id", vector).write.parquet(f"{out}/vectors")
    df.drop(vector).write.option("compression", "gzip").json(f"{out}/records")
    df.drop(vector).limit(0).write.parquet(f"{out}/schema")
    manifest["digest"] = {"vectors": _digest(spark.read.parquet(f"{out}/vectors")), "records": _digest(_records(spark, out))}
    if collection.count() != g["n"]:
        raise Refused("the collection changed while it was exported")
    files.write("manifest.json", json.dumps(manifest))
    return verify_export(spark, out, vector)


def _records(spark: SparkSession, at: str) -> DataFrame:
    return spark.read.schema(spark.read.parquet(f"{at}/schema").schema).json(f"{at}/records")


def load_export(spark: SparkSession, at: str) -> DataFrame:
    """Records with their vectors."""
    return _records(spark, at).join(spark.read.parquet(f"{at}/vectors"), "id")


def verify_export(spark: SparkSession, at: str, vector: str = "embedding") -> dict:
    """The manifest, if digests, counts, sizes and the vectors' values hold."""
    manifest = json.loads(Files(spark, at).read("manifest.json") or "{}")
    vectors, records = spark.read.parquet(f"{at}/vectors"), _records(spark, at)
    if manifest.get("digest") != {"vectors": _digest(vectors), "records": _digest(records)}:
        raise Refused("files aren't those that the manifest names")
    g = vectors.agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"), F.count_if(F.size(vector) != manifest["dimension"]).alias("odd"), F.count_if(~all_finite(F.col(vector))).alias("wild")).first()
    if not g["n"] == g["ids"] == manifest["count"] == records.count() or g["odd"] or g["wild"]:
        raise Refused("counts, sizes or values don't hold")
    return manifest


def restore_into(collection: Collection, at: str) -> int:
    """An export into an empty collection."""
    if collection.count():
        raise Refused(f"{collection.name} isn't empty")
    manifest = verify_export(collection.spark, at)
    collection.replace(load_export(collection.spark, at), manifest["collection_metadata"] | {"space": distance_space(manifest)})
    if collection.count() != manifest["count"]:
        raise Refused("the restored count differs")
    return manifest["count"]


def backup(collection: Collection, root: str, keep: int = 4, name: str | None = None) -> list[str]:
    """An export under a partial name, verified, then named; the newest `keep` complete ones stay. Returns their names."""
    files = Files(collection.spark, root)
    name = name or time.strftime("%Y%m%dT%H%M%SZ", time.gmtime())
    export_collection(collection, f"{root.rstrip('/')}/.partial-{name}")
    files.move(f".partial-{name}", name)
    done = [n for n in files.names() if not n.startswith(".")]
    for old in done[: max(0, len(done) - keep)]:
        files.remove(old)
    return done[-keep:]


def summary(spark: SparkSession, root: str) -> DataFrame:
    """(name, records) of each collection under root."""
    names = [n for n in Files(spark, root).names() if Files(spark, f"{root.rstrip('/')}/{n}").read("CURRENT")]
    return spark.createDataFrame([(n, Collection(spark, root, n).count()) for n in names], "name string, records long")
