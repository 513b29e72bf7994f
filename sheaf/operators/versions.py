"""Tables in versions: one writer at a time, an intent before each change, an end or an undo after a crash.

Below a root, in any file system that Spark reaches:

    lease/<number>          a writer; the largest number writes, and its number fences the others off
    journal/<n>.intent      what version n shall be: the digests of its base and of its rows
    v/<n>/                  the rows of version n, in Parquet
    journal/<n>.end         "done" or "undone": the one file that decides

A change goes intent, rows, check of the rows, end. Readers take the last version whose end says done,
so half a change is never seen, and of two writers who end the same version one loses. Whoever writes
next first recovers: an intent without an end is done if its rows are there and are what it
announced, and undone otherwise. Rows travel only between executors and the file system; the
driver handles names and digests.

Small files are written under a name of their own and renamed to one that must not exist, which is atomic
on HDFS. A local file system asks and renames in two steps: enough for one driver, as in tests. An object
store without an atomic rename needs a lock from elsewhere.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.operators import ledger
from sheaf.operators.guarded import Digest, Refused, digest_of


class Fenced(RuntimeError):
    """Another writer has taken over, or holds a lease that is not over."""


class Files:
    """Small files and folders of a root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.fs = self.at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        at = self.at(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.at(name))

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Writes a file that must not be there; False, and nothing changed, if it is."""
        if self.exists(name):
            return False
        folder, _, short = name.rpartition("/")
        own = f"{folder}/.{short}.{uuid.uuid4().hex}"
        stream = self.fs.create(self.at(own), True)
        stream.write(text.encode())
        stream.close()
        if not self.exists(name) and self.fs.rename(self.at(own), self.at(name)):
            return True
        self.fs.delete(self.at(own), False)
        return False

    def delete(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


@dataclass(frozen=True)
class Lease:
    number: int
    owner: str


def _number(n: int) -> str:
    return f"{n:012d}"


class Versions:
    """The versions at ``root``. ``now`` is the clock of leases, in seconds."""

    def __init__(self, spark: SparkSession, root: str, now: Callable[[], float] = time.time):
        self.spark, self.now = spark, now
        self.files = Files(spark, root)

    # --- writers -----------------------------------------------------------------------------

    def _last_lease(self) -> tuple[int, dict] | None:
        names = [n for n in self.files.names("lease") if n.isdigit()]
        return (int(names[-1]), json.loads(self.files.read(f"lease/{names[-1]}"))) if names else None

    def acquire(self, owner: str, seconds: float = 600) -> Lease:
        """The lease with the next number. Fenced while another's is neither over nor given back."""
        last = self._last_lease()
        if last and last[1]["until"] > self.now() and not self.files.exists(f"lease/{_number(last[0])}.over"):
            raise Fenced(f"{last[1]['owner']} writes until {last[1]['until']}")
        lease = Lease(last[0] + 1 if last else 1, owner)
        if not self.files.create(f"lease/{_number(lease.number)}", json.dumps({"owner": owner, "until": self.now() + seconds})):
            raise Fenced(f"another writer took lease {lease.number}")
        self.recover(lease)
        return lease

    def release(self, lease: Lease) -> None:
        self.files.create(f"lease/{_number(lease.number)}.over", lease.owner)

    def _fence(self, lease: Lease) -> None:
        last = self._last_lease()
        if last is None or last[0] != lease.number:
            raise Fenced(f"lease {lease.number} of {lease.owner} is not the last one")

    # --- versions ----------------------------------------------------------------------------

    def ends(self) -> dict[int, str]:
        """What became of each version that has an end."""
        names = [n for n in self.files.names("journal") if n.endswith(".end") and not n.startswith(".")]
        return {int(n.partition(".")[0]): self.files.read(f"journal/{n}") for n in names}

    def current(self) -> int | None:
        return max((n for n, end in self.ends().items() if end == "done"), default=None)

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version, by default the current one; None before the first."""
        n = self.current() if version is None else version
        return None if n is None else self.spark.read.parquet(f"{self.files.root}/v/{_number(n)}")

    def intend(self, lease: Lease, rows: DataFrame) -> int:
        """Announces the next version: its number. Its digest is taken before anything is written."""
        self._fence(lease)
        n = max((int(x.partition(".")[0]) for x in self.files.names("journal") if not x.startswith(".")), default=0) + 1
        told = {"base": self.current(), "lease": lease.number, "digest": digest_of(rows).text()}
        if not self.files.create(f"journal/{_number(n)}.intent", json.dumps(told)):
            raise Fenced(f"another writer announced version {n}")
        return n

    def stage(self, n: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.files.root}/v/{_number(n)}")

    def whole(self, n: int) -> bool:
        """Whether the rows of version n are there and are those announced."""
        if not self.files.exists(f"v/{_number(n)}/_SUCCESS"):
            return False
        told = json.loads(self.files.read(f"journal/{_number(n)}.intent"))
        return digest_of(self.read(n)).text() == told["digest"]

    def end(self, lease: Lease, n: int) -> None:
        """Makes version n the current one, if it is whole and the lease is still the last."""
        whole = self.whole(n)
        self._fence(lease)
        if not self.files.create(f"journal/{_number(n)}.end", "done" if whole else "undone"):
            raise Fenced(f"version {n} has an end already")
        if not whole:
            self.files.delete(f"v/{_number(n)}")
            raise Refused(f"version {n} is not what was announced")

    def put(self, lease: Lease, rows: DataFrame) -> int:
        """All steps of a change; what they read must not change between them."""
        n = self.intend(lease, rows)
        self.stage(n, rows)
        self.end(lease, n)
        return n

    def recover(self, lease: Lease) -> dict[int, str]:
        """Ends what others left open: version -> done or undone. Running it again changes nothing."""
        self._fence(lease)
        ends = self.ends()
        out = {}
        for n in sorted(int(x.partition(".")[0]) for x in self.files.names("journal") if x.endswith(".intent") and not x.startswith(".")):
            if ends.get(n) == "undone" and self.files.exists(f"v/{_number(n)}"):
                self.files.delete(f"v/{_number(n)}")  # a crash between the undo and its cleaning
            if n not in ends:
                told = json.loads(self.files.read(f"journal/{_number(n)}.intent"))
                good = told["base"] == self.current() and self.whole(n)
                if self.files.create(f"journal/{_number(n)}.end", "done" if good else "undone"):
                    out[n] = "done" if good else "undone"
                    if not good:
                        self.files.delete(f"v/{_number(n)}")
        return out

    def roll_back(self, lease: Lease, version: int) -> int:
        """An earlier version's rows as a new one; history stays."""
        if self.ends().get(version) != "done":
            raise Refused(f"there is no version {version}")
        return self.put(lease, self.read(version))


# --- moves and migrations ------------------------------------------------------------------------


def refused_moves(moves: DataFrame, tree: DataFrame) -> DataFrame:
    """``moves`` (from_rel, to_rel, sha256) that must not be, with gate and detail: those of
    ledger.move_violations(), and BATCH where two moves of the batch take one source or one target,
    or a source more than one row of the tree."""
    one = ledger.move_violations(moves.select("from_rel", "to_rel", "sha256").distinct(), tree.select("path", "sha256").distinct())
    twice = lambda c, rows, name: rows.groupBy(F.col(c).alias(f"_{name}")).agg(F.count("*").alias(f"_n_{name}"))
    out = one
    for c, rows, name in (("from_rel", moves, "source"), ("to_rel", moves, "target"), ("path", tree, "path")):
        key = "to_rel" if name == "target" else "from_rel"
        out = out.join(twice(c, rows, name), F.col(key) == F.col(f"_{name}"), "left")
    why = F.when(F.col("_n_source") > 1, "source_twice").when(F.col("_n_target") > 1, "target_twice").when(F.col("_n_path") > 1, "path_twice")
    out = out.withColumns({"gate": F.when(F.col("gate").isNull() & why.isNotNull(), "BATCH").otherwise(F.col("gate")), "detail": F.coalesce("detail", why)})
    return out.where("gate IS NOT NULL").select("from_rel", "to_rel", "gate", "detail")


def moved(tree: DataFrame, moves: DataFrame) -> DataFrame:
    """The tree after the moves: the paths of its files change, nothing else does. Folders stay."""
    to = moves.select(F.col("from_rel").alias("_from"), F.col("to_rel").alias("_to")).distinct()
    out = tree.join(to, (F.col("path") == F.col("_from")) & F.col("sha256").isNotNull(), "left")
    return out.withColumn("path", F.coalesce("_to", "path")).select(*tree.columns)


def apply_moves(store: Versions, lease: Lease, moves: DataFrame, plan: Digest) -> int:
    """The whole batch as one new version of the tree in the store, or none of it: the plan must have the
    digest that was approved, no move may be refused, and afterwards the tree must hold as many files as
    before with the same contents, and the targets for the sources."""
    if digest_of(moves) != plan:
        raise Refused("the plan is not what was approved")
    tree = store.read()
    if tree is None:
        raise Refused("there is no tree")
    bad = refused_moves(moves, tree)
    if not bad.isEmpty():
        raise Refused(f"{bad.count()} moves are refused, nothing moves")
    rows = moved(tree, moves)
    n = store.intend(lease, rows)
    store.stage(n, rows)
    after = store.read(n)
    same = digest_of(after.drop("path")) == digest_of(tree.drop("path"))
    there = moves.join(after.select(F.col("path").alias("to_rel"), "sha256"), ["to_rel", "sha256"], "left_anti").isEmpty()
    left = moves.join(after.select(F.col("path").alias("from_rel")), "from_rel", "left_semi").isEmpty()
    if not (same and there and left):
        store.files.delete(f"v/{_number(n)}")  # what is not whole ends as undone
    store.end(lease, n)
    return n


def migrated(rows: DataFrame, upgrade: Callable[[DataFrame], DataFrame], facts: list[str], rules: dict[str, Callable[[DataFrame], Column]]) -> DataFrame:
    """Each row upgraded, or as it was where its upgrade breaks a rule: with violations (array<string>)
    and upgraded. ``facts`` are columns that an upgrade must leave alone; a rule tells of the
    upgraded rows whether one is good, null is not. ``upgrade`` is a projection that keeps all columns,
    so is all of this: a row is rolled back by itself, no other one waits for it."""
    columns = rows.columns
    out = upgrade(rows.withColumn("_old", F.struct(*[F.col(f"`{c}`") for c in columns])))
    told = {f"FACT:{c}": F.col(f"`{c}`").eqNullSafe(F.col(f"_old.`{c}`")) for c in facts} | {name: rule(out) for name, rule in rules.items()}
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(good, F.lit(False)), F.lit(name)) for name, good in told.items()]))
    out = out.withColumn("violations", broken)
    good = F.size("violations") == 0
    return out.select(*[F.when(good, F.col(f"`{c}`")).otherwise(F.col(f"_old.`{c}`")).alias(c) for c in columns], "violations", good.alias("upgraded"))
